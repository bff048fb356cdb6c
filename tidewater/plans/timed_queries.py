"""Registered streams of the apply job whose retries run on a clock."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.cli import cdc_from_kafka
from tidewater.session import fresh_dir
from tidewater.sources import avro_fixtures, fixtures, log
from tidewater.streaming.timed_job import TimedApplyJob

#: Seconds until a zero-row update is tried again, and until a run is given up.
INTERVAL, PATIENCE = 2.0, 900.0


def _applied(spark: SparkSession, sf_dir: str) -> TimedApplyJob:
    """All change events through a log; the query runs on, without new events, until no update waits."""
    job_dir = fresh_dir(spark, "stream-timed")
    events = fixtures.read_cdc_events(spark, sf_dir)
    value = F.to_json(F.struct("tableName", "actionType", "columns", "where"))
    log.append(avro_fixtures.as_log(events.withColumn("value", F.encode(value, "UTF-8")), F.col("batch_id")),
               f"{job_dir}/log")
    job = TimedApplyJob(spark, job_dir, fixtures.CDC_KEYS, INTERVAL)
    stream = log.log_stream(spark, f"{job_dir}/log", job.checkpoint)
    query = job.start(cdc_from_kafka(stream, "json"), {"processingTime": "1 second"})
    try:
        end = time.monotonic() + PATIENCE
        # With timers a query always has a next batch: it is done when a batch without events has
        # run and no update waits.
        while not query.lastProgress or query.lastProgress.numInputRows or job.waiting():
            if time.monotonic() > end or not query.isActive:
                raise RuntimeError(f"updates still wait: {query.exception()}")
            time.sleep(1)
    finally:
        query.stop()
    return job


def _event(df: DataFrame) -> DataFrame:
    """The log's partition as the event's batch and partition."""
    n = fixtures.CDC_PARTITIONS
    return df.withColumn("batch_id", F.floor(F.col("partition") / n).cast("bigint")) \
             .withColumn("partition", F.col("partition") % n)


def stream_timed_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target; equals ``cdc_final_state``."""
    return _applied(spark, sf_dir).final_state()


def stream_timed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every attempt; equals ``cdc_apply_status``."""
    rows = _event(_applied(spark, sf_dir).status())
    return rows.select("batch_id", "topic", "partition", "offset", "attempt", "status", "reason")


QUERIES = {"stream_timed_apply": stream_timed_apply, "stream_timed_status": stream_timed_status}
