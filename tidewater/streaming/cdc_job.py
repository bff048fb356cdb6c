"""Streaming change-event apply to a Spark-native target.

Per micro-batch (epoch ``e``), inside ``foreachBatch``:

1. leave out redelivered records; route, validate and render the others (``changelog.prepare``);
2. look up only the keys this batch touches in the key log of earlier
   epochs (semi join against the batch's keys);
3. decide applied / zero_rows / error per event (``apply.outcomes``);
4. give the zero-row updates of epoch ``e-1`` their one retry against the
   keys present after this batch; a miss goes to the dead letters;
5. write one ``events`` row per event attempt (status, reason, statement;
   the cells of zero-row updates, which are the pending retries), the keys
   inserted (the key log, compacted every ``COMPACT_EVERY`` epochs), the offsets
   consumed - each as the folder ``epoch=e`` (replay-safe) -, the target's next
   version, and the per-partition progress **last**.

What steps 1 and 3 make is read several times; it is written to a working folder, which
the next batch overwrites, and not cached: rows of a cached partition are unrolled,
serialized and sent between executors thousands at a time, outside the memory that Spark counts.

Records that an earlier epoch has consumed, or that come twice in a batch, are left out
first (``sinks.consumed``). The target is a table in versions (``sinks.versioned``).
``flush()`` gives the last epoch's pending retries their chance when no
further batch will come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import apply, changelog
from tidewater.operators.joins import join_small
from tidewater.operators.offsets import batch_ranges
from tidewater.sinks.consumed import ConsumedOffsets
from tidewater.sinks.progress import write_progress
from tidewater.sinks.tables import (exists, list_dirs, overwritten, read_epoch, read_table,
                                    write_epoch)
from tidewater.sinks.versioned import VersionedTarget
from tidewater.streaming.runner import output_generation, run_available, start

ROW = apply.ROW
EVENT_ID = apply.EVENT_ID
_ORD = "struct<batch_id:bigint,topic:string,partition:int,offset:bigint>"
_CELLS = "array<struct<name:string,column:string,type:string,value:string,literal:string>>"

SCHEMAS = {
    # one row per event attempt: status, dead letters, pending retries and the
    # key log are all read from this table (column pruning keeps reads narrow)
    "events": (f"batch_id long, topic string, partition int, offset long, attempt int, "
               f"status string, reason string, statement string, table_name string, "
               f"key string, route string, ord {_ORD}, cells {_CELLS}, epoch long"),
    "keys": "table_name string, key string, epoch long",
    "progress": ("topic string, partition int, from_offset long, until_offset long, "
                 "records long, epoch long"),
    "flushed": "done boolean, epoch long",
}
TARGET = (f"table_name string, key string, column string, type string, value string, "
          f"w struct<is_update:boolean,ord:{_ORD}>")
#: What a batch needs of its prepared events.
PREPARED = [*EVENT_ID, "tableName", "route", "cells", "key", "reason", "statement"]
EVENT_COLUMNS = [f.split()[0] for f in SCHEMAS["events"].split(", ") if f.split()[0] != "epoch"]


def _typed(df: DataFrame, **values) -> DataFrame:
    """Project ``df`` onto the event-table columns; missing ones are null."""
    types = dict(f.split(" ", 1) for f in SCHEMAS["events"].split(", "))
    cols = []
    for c in EVENT_COLUMNS:
        v = values.get(c, F.col(c) if c in df.columns else F.lit(None))
        cols.append(v.cast(types[c]).alias(c))
    return df.select(*cols)


# The key log is compacted into one snapshot every this many epochs, so a
# batch reads one snapshot plus fewer than this many small epoch folders.
COMPACT_EVERY = 64


class CdcApplyJob:
    def __init__(self, spark: SparkSession, job_dir: str,
                 key_column: changelog.KeyColumns = changelog.DEFAULT_KEY,
                 compact_every: int = COMPACT_EVERY, mode: str = "full", buckets: int = 16,
                 on_progress_error: str = "raise"):
        self.mode, self.on_progress_error = mode, on_progress_error
        self.spark = spark
        self.compact_every = compact_every
        self.checkpoint = f"{job_dir}/checkpoint"
        self.out = output_generation(spark, self.checkpoint, f"{job_dir}/out")
        self.key_column = key_column
        self.consumed = ConsumedOffsets(spark, f"{self.out}/consumed", compact_every)
        #: Version 2e is the target after epoch e, 2e + 1 that after its flush.
        self.target = VersionedTarget(spark, f"{self.out}/target", TARGET, buckets)

    def _path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def table(self, name: str) -> DataFrame:
        schema = SCHEMAS[name.replace("_flush", "")]
        return read_table(self.spark, self._path(name), schema)

    def _keys_before(self, epoch: int) -> DataFrame:
        """Key log: keys inserted by the epochs before ``epoch``.

        Narrow (table_name, key) rows, O(number of keys) - never the event
        history: the newest compacted snapshot below ``epoch`` plus the
        per-epoch folders written after it.
        """
        snaps = [int(d.split("=", 1)[1]) for d in list_dirs(self.spark, self._path("keys_compact"))
                 if d.startswith("upto=")]
        upto = max((x for x in snaps if x < epoch), default=-1)
        # Only the folders since the snapshot are listed and read.
        folders = [self._path(f"keys/epoch={e}") for e in range(upto + 1, epoch)]
        folders = [f for f in folders if exists(self.spark, f)]
        if upto >= 0:
            folders.append(self._path(f"keys_compact/upto={upto}"))
        if not folders:
            return self.spark.createDataFrame([], "table_name string, key string")
        return self.spark.read.schema("table_name string, key string").parquet(*folders)

    def _maybe_compact(self, epoch: int) -> None:
        """Every ``compact_every`` epochs: one snapshot of all keys so far,
        hash-partitioned by key (idempotent: rewritten identically on replay)."""
        if (epoch + 1) % self.compact_every:
            return
        keys = self._keys_before(epoch + 1)
        n = max(1, self.spark.sparkContext.defaultParallelism)
        keys.repartition(n, *ROW).write.mode("overwrite").parquet(
            self._path(f"keys_compact/upto={epoch}"))

    def _pending(self, epoch: int) -> DataFrame:
        """Zero-row updates of ``epoch`` still waiting (not flushed)."""
        e = read_epoch(self.spark, self._path("events"), epoch, SCHEMAS["events"])
        pending = e.where((F.col("attempt") == 0) & (F.col("status") == "zero_rows")).drop("epoch")
        if exists(self.spark, self._path(f"flushed/epoch={epoch}")):
            return pending.where(F.lit(False))   # already retried by flush()
        return pending

    @staticmethod
    def _retry(pending: DataFrame, keys_after: DataFrame):
        # One join: whether the key is there now.
        there = keys_after.groupBy(*ROW).agg(F.lit(True).alias("there"))
        tried = join_small(pending, there, ROW, "left") \
            .withColumn("there", F.coalesce("there", F.lit(False)))
        there = F.col("there")
        rows = _typed(tried, attempt=F.lit(1),
                      status=F.when(there, F.lit("applied")).otherwise(F.lit("dead_letter")),
                      reason=F.when(~there, F.lit("zero_rows_after_retry")), cells=F.lit(None))
        return tried.where(there), rows

    # -- one micro-batch ----------------------------------------------------
    def process_batch(self, df: DataFrame, epoch: int) -> None:
        events = self.consumed.unseen(df, epoch).withColumn("batch_id", F.lit(int(epoch)).cast("long"))
        p = changelog.prepare(events, self.key_column, self.mode, compat=False).select(*PREPARED)
        self._apply(overwritten(p, self._path("work/prepared")), epoch)

    def _apply(self, p: DataFrame, epoch: int) -> None:
        pending = self._pending(epoch - 1)
        valid = apply.keyed(p)
        touched = valid.select(*ROW).unionByName(pending.select(*ROW)).distinct()
        existing = join_small(self._keys_before(epoch), touched, ROW, "left_semi")
        out = overwritten(apply.first_status(p, existing), self._path("work/outcomes"))
        fs = F.col("first_status")
        inserted = out.where((F.col("route") == changelog.INSERT) & (fs == "applied")).select(*ROW)
        retry_ok, retry_rows = self._retry(pending, existing.unionByName(inserted))
        reason0 = (F.when(fs == "error", F.lit("duplicate_key"))
                    .when(fs == "zero_rows", F.lit("no_matching_row")))
        first = _typed(out, attempt=F.lit(0), status=fs, reason=reason0,
                       cells=F.when(fs == "zero_rows", F.col("cells")))
        other = _typed(p.where(F.col("reason").isNotNull()
                               | (F.col("route") == changelog.IGNORED)),
                       attempt=F.lit(0), table_name=F.col("tableName"),
                       status=F.when(F.col("route") == changelog.IGNORED, F.lit("ignored"))
                               .otherwise(F.lit("rejected")),
                       statement=F.lit(None), ord=F.lit(None), cells=F.lit(None))
        write_epoch(first.unionByName(other).unionByName(retry_rows),
                    self._path("events"), epoch)
        write_epoch(inserted, self._path("keys"), epoch)
        applied = out.where(fs == "applied").select(*ROW, "route", "ord", "cells") \
            .unionByName(retry_ok.select(*ROW, "route", "ord", "cells"))
        self.target.apply(apply.fold(apply.event_cells(applied)), 2 * epoch)
        self.consumed.write(p, epoch)
        self._maybe_compact(epoch)
        # Last: marks the epoch done.
        write_progress(batch_ranges(p), self._path("progress"), epoch, self.on_progress_error)

    # -- after the last batch -------------------------------------------------
    def last_epoch(self) -> int | None:
        r = self.table("progress").agg(F.max("epoch")).first()
        return None if r is None or r[0] is None else int(r[0])

    def flush(self) -> None:
        """Retry the last epoch's zero-row updates now (R3 without a next batch)."""
        last = self.last_epoch()
        if last is None:
            return
        pending = self._pending(last)
        keys = self._keys_before(last + 1)
        ok, rows = self._retry(pending, keys)
        write_epoch(rows, self._path("events_flush"), last)
        cells = apply.fold(apply.event_cells(ok.select(*ROW, "route", "ord", "cells")))
        self.target.apply(cells, 2 * last + 1)
        write_epoch(self.spark.range(1).select(F.lit(True).alias("done")),
                    self._path("flushed"), last)

    # -- driving ------------------------------------------------------------
    def start(self, stream: DataFrame, trigger: dict | None = None):
        return start(stream, self.process_batch, self.checkpoint, trigger)

    def run_available(self, stream: DataFrame) -> None:
        run_available(stream, self.process_batch, self.checkpoint)

    # -- results ------------------------------------------------------------
    def _with_flush(self, name: str) -> DataFrame:
        return self.table(name).unionByName(self.table(f"{name}_flush"))

    def final_state(self) -> DataFrame:
        """Target: ``table_name, key, column, type, value``."""
        return self.target.read().drop("w")

    def status(self) -> DataFrame:
        e = self._with_flush("events")
        return e.select(*EVENT_ID, "attempt", "status", "reason")

    def dead_letters(self) -> DataFrame:
        e = self._with_flush("events")
        dead = e.where(((F.col("attempt") == 0) & (F.col("status") == "error"))
                       | (F.col("status") == "dead_letter"))
        reason = F.when(F.col("attempt") == 0, F.lit("error")).otherwise(F.col("reason"))
        return dead.select(*EVENT_ID, "attempt", reason.alias("reason"), "statement")

    def progress(self) -> DataFrame:
        return self.table("progress")
