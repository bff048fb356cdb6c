"""Change-event apply with a retry on its own clock (R3, R6, J2): keyed state and timers.

``CdcApplyJob`` ties the second chance of a zero-row update to the next batch. Here it comes
``interval`` seconds after the miss, whether batches come or not, as timers
in Spark's state store:

* the state holds the place of each key's first insert, and the zero-row updates that wait;
* an update of a key that is there is applied, an insert of one is an error; an update of
  a key that is not there is ``zero_rows`` and waits;
* when its timer fires, a waiting update is applied if the key is there by then (a late
  parent row), else it goes to the dead letters.

Keys are dealt over ``BUCKETS`` buckets, and a bucket is what Spark groups by: a call into
the worker, its record batches and its timers then serve the keys of a bucket together,
where one call per key would cost more than its events. A batch still costs what its
keys cost: each is looked up by itself in the bucket's map in the state store. Rows of a
bucket are streamed through its state; updates that may have to wait go to the store in
chunks of ``CHUNK``, so that a hot key needs no room for its rows. Chunks are kept by
their time, and a timer reads only its own. State and timers are in the checkpoint and
survive a restart.

Events of a key are ordered by (topic, partition, offset), which a log gives to one key's
events in one partition. Each status row and folded cell is written per epoch, as
``CdcApplyJob`` does it, progress last. The session needs the RocksDB state store
(``STATE_STORE``), which is set for the query if the session names no store.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater.operators import apply, changelog
from tidewater.sinks.tables import exists, list_dirs, read_table, write_epoch
from tidewater.streaming.runner import output_generation

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Seconds until a zero-row update is tried again (the original's timer).
INTERVAL = 10.0
#: Buckets that the keys are dealt over (fixed for a checkpoint's life), and rows of a chunk.
BUCKETS, CHUNK = 4096, 10_000

PLACE = ["topic", "partition", "offset"]
_PLACE = "topic string, partition int, offset long"
_CELLS = "array<struct<name:string,column:string,type:string,value:string,literal:string>>"
#: What leaves the state: one row per attempt of an event.
_OUT = f"{_PLACE}, attempt int, status string, reason string, statement string, table_name string, key string, " \
       "route string, cells string"
_DELTA = f"table_name string, key string, column string, type string, value string, " \
         f"w struct<is_update:boolean,ord:struct<topic:string,partition:int,offset:bigint>>, epoch long"
_EVENTS = f"{_OUT}, epoch long"
_PROGRESS = f"topic string, partition int, from_offset long, until_offset long, records long, epoch long"
COLUMNS = [f.split()[0] for f in _OUT.split(", ")]
_IN = [c for c in COLUMNS if c != "attempt"]


class SecondChance(StatefulProcessor):
    """The state of one bucket of row keys: ``first``, the place of each key's first insert;
    ``waiting``, the zero-row updates in chunks by the time they are due; ``chunks``, the number of these."""

    def __init__(self, interval: float, chunk: int = CHUNK):
        self.wait_ms, self.chunk = int(interval * 1000), chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getMapState("first", "table_name string, key string", _PLACE)
        self.waiting = handle.getMapState("waiting", "due long, chunk int", "rows string")
        self.chunks = handle.getMapState("chunks", "due long", "n int")

    def _frames(self, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        """Rows of ``COLUMNS`` in frames of ``chunk``."""
        some = []
        for r in rows:
            some.append(r)
            if len(some) == self.chunk:
                yield pd.DataFrame(some, columns=COLUMNS)
                some = []
        if some:
            yield pd.DataFrame(some, columns=COLUMNS)

    def _number(self, due: int) -> int:
        return self.chunks.getValue((due,))[0] if self.chunks.containsKey((due,)) else 0

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._frames(self._tried(rows, timerValues.getCurrentProcessingTimeInMs() + self.wait_ms))

    def _tried(self, rows: Iterator[pd.DataFrame], due: int) -> Iterator[tuple]:
        """First attempts of a batch's events."""
        before: dict[tuple, bool] = {}      # whether a key was there before this batch
        inserts: dict[tuple, tuple] = {}    # the earliest insert of a key in this batch so far
        held: list[tuple] = []              # updates of keys that were not there: not yet in a chunk
        old = end = None                    # chunks that this batch has added
        for b in rows:
            for topic, partition, offset, status, reason, statement, table, row, route, cells in zip(
                    *(b[c].tolist() for c in _IN)):
                place = (topic, partition, offset)
                if status is not None:      # nothing to apply: rejected or ignored
                    yield (*place, 0, status, reason, statement, table, row, route, cells)
                    continue
                k = (table, row)
                if k not in before:
                    before[k] = self.first.containsKey(k)
                if route == changelog.UPDATE:
                    if before[k]:
                        yield (*place, 0, "applied", None, statement, *k, route, cells)
                        continue
                    held.append((*place, *k, statement, cells))
                    if len(held) == self.chunk:
                        if old is None:
                            old = end = self._number(due)
                        self.waiting.updateValue((due, end), (json.dumps(held),))
                        held, end = [], end + 1
                    continue
                duplicate = (*place, 0, "error", "duplicate_key", statement, *k, route, None)
                known = inserts.get(k)
                if before[k] or (known and known[:3] < place):
                    yield duplicate
                    continue
                if known:                   # an earlier one: the one before is the duplicate
                    yield (*known[:3], 0, "error", "duplicate_key", known[3], *k, known[4], None)
                inserts[k] = (*place, statement, route, cells)
        for k, r in inserts.items():
            self.first.updateValue(k, r[:3])
            yield (*r[:3], 0, "applied", None, r[3], *k, *r[4:])
        # The held updates, now that the inserts are known: those behind their key's first insert
        # are applied, the others wait.
        late = False
        for i in range(old or 0, end or 0):
            every = [tuple(r) for r in json.loads(self.waiting.getValue((due, i))[0])]
            stay = [r for r in every if not self._behind(r, inserts)]
            yield from self._first_try(every, inserts)
            if len(stay) < len(every):
                self.waiting.updateValue((due, i), (json.dumps(stay),))
            late |= bool(stay)
        stay = [r for r in held if not self._behind(r, inserts)]
        yield from self._first_try(held, inserts)
        if stay:
            end = self._number(due) if end is None else end
            self.waiting.updateValue((due, end), (json.dumps(stay),))
            end, late = end + 1, True
        if end is not None:
            self.chunks.updateValue((due,), (end,))
        if late or old is not None:
            self.handle.registerTimer(due)

    @staticmethod
    def _behind(r: tuple, inserts: dict[tuple, tuple]) -> bool:
        first = inserts.get(r[3:5])
        return first is not None and r[:3] > first[:3]

    def _first_try(self, held: list[tuple], inserts: dict[tuple, tuple]) -> Iterator[tuple]:
        for r in held:
            if self._behind(r, inserts):
                yield (*r[:3], 0, "applied", None, r[5], *r[3:5], changelog.UPDATE, r[6])
            else:
                yield (*r[:3], 0, "zero_rows", "no_matching_row", r[5], *r[3:5], changelog.UPDATE, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._frames(self._retried(expiredTimerInfo.getExpiryTimeInMs()))

    def _retried(self, due: int) -> Iterator[tuple]:
        """Second attempts of the updates that are due."""
        there: dict[tuple, bool] = {}
        n = self._number(due)
        for i in range(n):
            for r in json.loads(self.waiting.getValue((due, i))[0]):
                k = tuple(r[3:5])
                if k not in there:
                    there[k] = self.first.containsKey(k)
                ok = there[k]
                yield (*r[:3], 1, "applied" if ok else "dead_letter", None if ok else "zero_rows_after_retry",
                       r[5], *k, changelog.UPDATE, r[6] if ok else None)
            self.waiting.removeKey((due, i))
        if n:
            self.chunks.removeKey((due,))

    def close(self) -> None:
        pass


class TimedApplyJob:
    """Applies a change-event stream to a Spark table; misses are retried ``interval`` seconds later."""

    def __init__(self, spark: SparkSession, job_dir: str, key_column: changelog.KeyColumns = changelog.DEFAULT_KEY,
                 interval: float = INTERVAL, mode: str = "full"):
        self.spark, self.key_column, self.interval, self.mode = spark, key_column, interval, mode
        self.checkpoint = f"{job_dir}/checkpoint"
        self.out = output_generation(spark, self.checkpoint, f"{job_dir}/out")

    def attempts(self, events: DataFrame) -> DataFrame:
        """The stream of attempts (``_OUT``) of a stream of change events."""
        p = changelog.prepare(events, self.key_column, self.mode, compat=False)
        ignored = F.col("route") == changelog.IGNORED
        other = F.col("reason").isNotNull() | ignored
        rows = p.select(
            *PLACE, F.when(ignored, F.lit("ignored")).when(other, F.lit("rejected")).alias("status"), "reason",
            F.when(~other, F.col("statement")).alias("statement"),
            F.when(other, F.concat(F.lit("#"), F.pmod(F.xxhash64("offset"), F.lit(1024)).cast("string")))
             .otherwise(F.col("tableName")).alias("table_name"),
            F.when(~other, F.col("key")).alias("key"), "route",
            F.when(~other, F.to_json("cells", {"ignoreNullFields": "false"})).alias("cells"))
        # Rows without a key are dealt by their offset.
        place = F.when(F.col("key").isNull(), F.xxhash64("offset")).otherwise(F.xxhash64("table_name", "key"))
        rows = rows.withColumn("bucket", F.pmod(place, F.lit(BUCKETS)).cast("int"))
        return rows.groupBy("bucket").transformWithStateInPandas(
            SecondChance(self.interval), _OUT, "append", "processingTime")

    def _write(self, df: DataFrame, epoch: int) -> None:
        df.persist()
        try:
            write_epoch(df, f"{self.out}/events", epoch)
            cells = F.from_json("cells", _CELLS).alias("cells")
            applied = df.where(F.col("status") == "applied").select(
                "table_name", "key", "route", F.struct(*PLACE).alias("ord"), cells)
            write_epoch(apply.fold(apply.event_cells(applied)), f"{self.out}/delta", epoch)
            # Retries belong to ranges that are done.
            ranges = df.where("attempt = 0").groupBy("topic", "partition").agg(
                F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"),
                F.count(F.lit(1)).alias("records"))
            write_epoch(ranges, f"{self.out}/progress", epoch)      # last: marks the epoch done
        finally:
            df.unpersist()

    def start(self, events: DataFrame, trigger: dict | None = None):
        if "RocksDB" not in self.spark.conf.get(STATE_STORE[0], ""):
            self.spark.conf.set(*STATE_STORE)
        w = self.attempts(events).writeStream.outputMode("append").foreachBatch(self._write) \
            .option("checkpointLocation", self.checkpoint)
        return w.trigger(**(trigger or {"processingTime": "1 second"})).start()

    def _done(self) -> DataFrame | None:
        """The events of the epochs that are done, whose progress is written (None: no epoch yet)."""
        path = f"{self.out}/progress"
        done = max((int(d.split("=", 1)[1]) for d in list_dirs(self.spark, path)
                    if exists(self.spark, f"{path}/{d}/_SUCCESS")), default=None)
        e = read_table(self.spark, f"{self.out}/events", _EVENTS)
        return None if done is None else e.where(F.col("epoch") <= done)

    def _events(self) -> DataFrame:
        done = self._done()
        return self.spark.createDataFrame([], _EVENTS) if done is None else done

    def status(self) -> DataFrame:
        return self._events().select(*PLACE, "attempt", "status", "reason", "epoch")

    def waiting(self) -> bool:
        """Whether an update still waits for its retry, by the epochs that are done."""
        e = self._done()
        if e is None:
            return True
        n = F.sum(F.when(F.col("status") == "zero_rows", 1).otherwise(-F.col("attempt")))
        return (e.agg(n).first()[0] or 0) > 0

    def dead_letters(self) -> DataFrame:
        return self._events().where(F.col("status").isin("error", "dead_letter")).select(
            *PLACE, "attempt", F.coalesce("reason", "status").alias("reason"), "statement")

    def final_state(self) -> DataFrame:
        """Target: ``table_name, key, column, type, value``."""
        d = read_table(self.spark, f"{self.out}/delta", _DELTA)
        g = d.groupBy("table_name", "key", "column").agg(
            F.max_by(F.struct("type", "value"), F.col("w")).alias("v"))
        return g.select("table_name", "key", "column", "v.type", "v.value")

    def progress(self) -> DataFrame:
        return read_table(self.spark, f"{self.out}/progress", _PROGRESS)
