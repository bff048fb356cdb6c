"""Streaming change apply to an external database through DB-API.

Per micro-batch (epoch ``e``):

1. leave out records that an earlier epoch has consumed (``sinks.consumed``); route,
   validate, render the others (``changelog.prepare``) and plan the folded
   per-key work (``dbapi.plan``); the zero-row updates of epoch ``e-1`` join it
   as ``pending`` work, which runs after this batch's inserts and before its
   newer updates (their second chance);
2. execute it once - the outcome rows are written to ``outcomes/epoch=e``
   by that same action, so no statement runs twice (a retried task is
   answered by the database's ledger, which knows the job by an id kept in its
   folder); folded updates that failed run again event by event;
3. write per-event status and dead letters (pending work without a row), then
   the progress **last**; ledger rows of older epochs are deleted.

``flush()`` gives the last epoch's zero-row work its chance at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import apply, changelog
from tidewater.operators.joins import join_small
from tidewater.operators.offsets import batch_ranges
from tidewater.sinks import dbapi
from tidewater.sinks.consumed import ConsumedOffsets
from tidewater.sinks.progress import write_progress
from tidewater.sinks.tables import exists, read_epoch, read_table, write_epoch
from tidewater.streaming.runner import output_generation, run_available, start

FLUSH_BASE = 1 << 60
ROW = apply.ROW
EVENT_ID = apply.EVENT_ID
_CELLS = "array<struct<column:string,type:string,value:string>>"
SCHEMAS = {
    "work": f"table_name string, key string, segment string, cells {_CELLS}, epoch long",
    "outcomes": f"{dbapi.OUTCOME_SCHEMA}, epoch long",
    "event_outcomes": f"{dbapi.OUTCOME_SCHEMA}, epoch long",
    "flush_outcomes": f"{dbapi.OUTCOME_SCHEMA}, epoch long",
    "pending": ("batch_id long, topic string, partition int, offset long, table_name string, "
                "key string, segment string, statement string, epoch long"),
    "status": ("batch_id long, topic string, partition int, offset long, attempt int, "
               "status string, reason string, epoch long"),
    "dead_letter": ("batch_id long, topic string, partition int, offset long, attempt int, "
                    "reason string, statement string, epoch long"),
    "progress": ("topic string, partition int, from_offset long, until_offset long, "
                 "records long, epoch long"),
}


class DbApplyJob:
    def __init__(self, spark: SparkSession, job_dir: str, connect: Callable[[], object],
                 key_column: changelog.KeyColumns = changelog.DEFAULT_KEY,
                 paramstyle: str = "qmark", tasks: int | None = None, mode: str = "full",
                 on_progress_error: str = "raise"):
        self.spark = spark
        self.checkpoint = f"{job_dir}/checkpoint"
        self.out = output_generation(spark, self.checkpoint, f"{job_dir}/out")
        self.connect, self.key_column = connect, key_column
        self.paramstyle, self.tasks, self.mode = paramstyle, tasks, mode
        self.on_progress_error = on_progress_error
        self.consumed = ConsumedOffsets(spark, f"{self.out}/consumed")

    def _path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self._path(name), SCHEMAS[name])

    def epoch_of(self, name: str, epoch: int) -> DataFrame:
        """One epoch's rows, read from its own folder."""
        return read_epoch(self.spark, self._path(name), epoch, SCHEMAS[name]).drop("epoch")

    @property
    def job_id(self) -> str:
        """Written once per output generation: what the ledger knows this job by."""
        path = self._path("job_id")
        if not exists(self.spark, path):
            self.spark.createDataFrame([(uuid.uuid4().hex,)], "value string").write.text(path)
        return self.spark.read.text(path).first()[0]

    def _execute(self, work: DataFrame, name: str, epoch: int, order: tuple[str, ...] = ()) -> DataFrame:
        outcomes = dbapi.execute(work, self.connect, self.key_column, epoch, self.paramstyle,
                                 self.tasks, self.job_id, order)
        write_epoch(outcomes, self._path(name), epoch)     # the one action that runs them
        return self.epoch_of(name, epoch)

    # -- one micro-batch ----------------------------------------------------
    def process_batch(self, df: DataFrame, epoch: int) -> None:
        events = self.consumed.unseen(df, epoch).withColumn("batch_id", F.lit(int(epoch)).cast("long"))
        p = changelog.prepare(events, self.key_column, self.mode, compat=False).persist()
        try:
            planned, work = dbapi.plan(p)
            write_epoch(work, self._path("work"), epoch)
            work = self.epoch_of("work", epoch)
            outcomes = self._execute(work.unionByName(self._pending_work(epoch - 1)),
                                     "outcomes", epoch)
            alone = self._execute(dbapi.single_events(planned, outcomes), "event_outcomes", epoch,
                                  ("ord",))
            ev_status = dbapi.event_status(planned, outcomes.unionByName(alone),
                                           keep=("statement", *ROW, "segment"))
            other = p.where(F.col("reason").isNotNull() | (F.col("route") == changelog.IGNORED)) \
                .select(*EVENT_ID, F.lit(0).alias("attempt"),
                        F.when(F.col("route") == changelog.IGNORED, F.lit("ignored"))
                         .otherwise(F.lit("rejected")).alias("status"), "reason")
            status_rows = ev_status.select(*EVENT_ID, "attempt", "status", "reason").unionByName(other)
            retry_status, retry_dead = self._second_chance(
                epoch - 1, outcomes.where(F.col("segment") == "pending"))
            write_epoch(status_rows.unionByName(retry_status), self._path("status"), epoch)
            dead = ev_status.where(F.col("status") == "error").select(
                *EVENT_ID, "attempt", F.lit("error").alias("reason"), "statement")
            write_epoch(dead.unionByName(retry_dead), self._path("dead_letter"), epoch)
            # pending texts of this epoch's zero-row events, for its retry next epoch
            write_epoch(ev_status.where(F.col("status") == "zero_rows")
                        .select(*EVENT_ID, *ROW, "segment", "statement"),
                        self._path("pending"), epoch)
            self.consumed.write(p, epoch)
            # Last: marks the epoch done.
            write_progress(batch_ranges(p), self._path("progress"), epoch, self.on_progress_error)
            dbapi.prune(self.connect, self.job_id, epoch - 1, self.paramstyle)
        finally:
            p.unpersist()

    def _pending_work(self, prev: int) -> DataFrame:
        """Epoch ``prev``'s zero-row work, to run once more; none if it was flushed."""
        work, done = self.epoch_of("work", prev), self.epoch_of("outcomes", prev)
        if exists(self.spark, self._path(f"flushed/epoch={prev}")):
            work = work.where(F.lit(False))
        at = lambda o: join_small(work, done.where(F.col("outcome") == o)
                                  .select(*ROW, "segment"), [*ROW, "segment"], "left_semi")
        zero = at("zero_rows").where(F.col("segment") != "insert")
        newer = at("applied").where(F.col("segment") == "after")
        return dbapi.without_written(zero, newer)

    def _second_chance(self, prev: int, res: DataFrame):
        """Status (attempt 1) and dead letters of epoch ``prev``'s pending events."""
        pend = self.epoch_of("pending", prev)
        if exists(self.spark, self._path(f"flushed/epoch={prev}")):
            pend = pend.where(F.lit(False))
        j = join_small(pend.drop("segment"), res.drop("segment"), ROW, "left")
        ok = F.coalesce(F.col("outcome") == "applied", F.lit(False))
        status = j.select(*EVENT_ID, F.lit(1).alias("attempt"),
                          F.when(ok, F.lit("applied")).otherwise(F.lit("dead_letter")).alias("status"),
                          F.when(ok, F.lit(None)).otherwise(F.lit("zero_rows_after_retry"))
                           .cast("string").alias("reason"))
        dead = j.where(~ok).select(
            *EVENT_ID, F.lit(1).alias("attempt"), F.lit("zero_rows_after_retry").alias("reason"),
            "statement")
        return status, dead

    # -- after the last batch -------------------------------------------------
    def flush(self) -> None:
        r = self.table("progress").agg(F.max("epoch")).first()
        if r is None or r[0] is None:
            return
        last = int(r[0])
        if exists(self.spark, self._path(f"flushed/epoch={last}")):
            return
        # Ledger rows of the flush are told apart from the batch's by their batch id.
        outcomes = dbapi.execute(self._pending_work(last), self.connect, self.key_column,
                                 FLUSH_BASE + last, self.paramstyle, self.tasks, self.job_id)
        write_epoch(outcomes, self._path("flush_outcomes"), last)
        status, dead = self._second_chance(last, self.epoch_of("flush_outcomes", last))
        write_epoch(status, self._path("status_flush"), last)
        write_epoch(dead, self._path("dead_letter_flush"), last)
        # a later batch must not retry this epoch's work again
        write_epoch(self.spark.range(1).select(F.lit(True).alias("done")),
                    self._path("flushed"), last)

    # -- driving ------------------------------------------------------------
    def start(self, stream: DataFrame, trigger: dict | None = None):
        return start(stream, self.process_batch, self.checkpoint, trigger)

    def run_available(self, stream: DataFrame) -> None:
        run_available(stream, self.process_batch, self.checkpoint)

    def status(self) -> DataFrame:
        s = SCHEMAS["status"]
        return self.table("status").unionByName(
            read_table(self.spark, self._path("status_flush"), s)).drop("epoch")

    def dead_letters(self) -> DataFrame:
        s = SCHEMAS["dead_letter"]
        return self.table("dead_letter").unionByName(
            read_table(self.spark, self._path("dead_letter_flush"), s)).drop("epoch")
