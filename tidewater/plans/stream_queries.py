"""Registered streaming queries (20, 21): stream runs whose output equals the
batch queries' oracles.

Each call lands input derived from the tables in a fresh folder under the
session's checkpoint root, runs the job with ``availableNow`` triggers and
reads the job's output back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import wordcount as wc
from tidewater.session import fresh_dir
from tidewater.sources.fixtures import CDC_KEYS, read_cdc_events
from tidewater.sources.tables import read_table
from tidewater.streaming.cdc_job import CdcApplyJob
from tidewater.streaming.wordcount_job import WordCountJob

# Rate cap of the file source (S9): files per micro-batch.
FILES_PER_TRIGGER = 2


def _wordcount_job(spark: SparkSession, sf_dir: str) -> WordCountJob:
    job_dir = fresh_dir(spark, "stream-wordcount")
    landing = f"{job_dir}/landing"
    conv = read_table(spark, sf_dir, "conversations", ["turn", "text"])
    # The producer: conversation turns are the data batches; rows stay in the tasks that read
    # them, so a batch may come in several files and epochs.
    conv.select(F.col("turn").alias("batch_id"), "text").write.parquet(landing)
    stream = (spark.readStream.schema("batch_id long, text string")
              .option("maxFilesPerTrigger", str(FILES_PER_TRIGGER)).parquet(landing))
    job = WordCountJob(spark, job_dir, batch_column="batch_id")
    job.run_available(stream)
    return job


def stream_wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 20: ``(batch_id, word, cnt)`` from the recoverable stream."""
    return _wordcount_job(spark, sf_dir).counts()


def stream_dropped_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running dropped-word total per batch from the stream."""
    d = _wordcount_job(spark, sf_dir).dropped_totals()
    return d.withColumn("report", wc.dropped_report("dropped_total"))


def _cdc_job(spark: SparkSession, sf_dir: str, redeliver: bool = False) -> CdcApplyJob:
    job_dir = fresh_dir(spark, "stream-cdc")
    landing = f"{job_dir}/landing"
    events = read_cdc_events(spark, sf_dir)
    payload = events.drop("batch_id")
    job = CdcApplyJob(spark, job_dir, CDC_KEYS)
    # The batch ids are a handful of values: one arrival (and one restart of
    # the query from its checkpoint) per batch.
    batches = [r[0] for r in events.select("batch_id").distinct().orderBy("batch_id").collect()]
    # With ``redeliver`` a batch also brings a part of the records before it again, and twice its own.
    again = (F.col("offset") % 3 == 0) if redeliver else F.lit(False)
    for b in batches:
        own = events.where(F.col("batch_id") == b)
        old = events.where((F.col("batch_id") <= b) & again)
        own.unionByName(old).drop("batch_id").write.mode("append").parquet(landing)
        job.run_available(spark.readStream.schema(payload.schema).parquet(landing))
    job.flush()
    return job


def stream_cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 21: the target after streaming every batch (equals query 18)."""
    return _cdc_job(spark, sf_dir).final_state()


def stream_cdc_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows written by the stream (equals query 17)."""
    return _cdc_job(spark, sf_dir).status()


def stream_cdc_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of a stream that redelivers records, late and twice; equals query 17."""
    return _cdc_job(spark, sf_dir, redeliver=True).status()


def stream_cdc_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that each version of the target has changed: a version per batch and flush, each read back."""
    target = _cdc_job(spark, sf_dir).target
    known = target.versions()
    out, before = None, None
    for v in known:         # a handful: one per batch, and the flush
        cells = target.read(v).select("table_name", "key", "column", "type", "value")
        new = cells if before is None else cells.exceptAll(before)
        new = new.groupBy("table_name").agg(F.count(F.lit(1)).alias("cells")) \
            .select(F.lit(v).cast("bigint").alias("version"), "table_name", "cells")
        out, before = new if out is None else out.unionByName(new), cells
    return out


QUERIES = {
    "stream_cdc_redelivered": stream_cdc_redelivered,
    "stream_cdc_versions": stream_cdc_versions,
    "stream_wordcount": stream_wordcount,
    "stream_dropped_total": stream_dropped_total,
    "stream_cdc_apply": stream_cdc_apply,
    "stream_cdc_status": stream_cdc_status,
}

# The streams must equal the batch queries' oracles.
ORACLE_OF = {
    "stream_wordcount": "wordcount_per_batch",
    "stream_dropped_total": "dropped_running_total",
    "stream_cdc_apply": "cdc_final_state",
    "stream_cdc_status": "cdc_apply_status",
    "stream_cdc_redelivered": "cdc_apply_status",
    "stream_batch_progress": "batch_progress",
    "stream_timed_apply": "cdc_final_state",
    "stream_timed_status": "cdc_apply_status",
}
