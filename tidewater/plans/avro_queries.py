"""Registered queries on registry-framed Avro, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.cli import cdc_from_kafka
from tidewater.plans.cdc_oracle import ORACLE as CDC_ORACLE
from tidewater.session import fresh_dir
from tidewater.sinks.tables import materialize
from tidewater.sources import avro, avro_fixtures, fixtures, log
from tidewater.streaming.cdc_job import CdcApplyJob


def decode_avro_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two writer schemas read onto one reader schema; what cannot be decoded has its reason."""
    out = avro.decode_registry(avro_fixtures.avro_events(spark, sf_dir), avro_fixtures.EVENT_READER,
                               avro_fixtures.EVENT_WRITERS)
    return out.select("topic", "partition", "offset", "schema_id", "status", "decoded.event_id", "decoded.user_id",
                      "decoded.event_type", F.unix_micros("decoded.ts").alias("ts_micros"), "decoded.value",
                      "decoded.props")


def _applied(spark: SparkSession, sf_dir: str) -> CdcApplyJob:
    """The change events as Avro through a log: one segment and one restart of the job per batch."""
    job_dir = fresh_dir(spark, "stream-cdc-avro")
    records = materialize(avro_fixtures.avro_changes(spark, sf_dir), "avro-changes")
    job = CdcApplyJob(spark, job_dir, fixtures.CDC_KEYS)
    # The batch ids are a handful of values.
    for b in [r[0] for r in records.select("batch_id").distinct().orderBy("batch_id").collect()]:
        log.append(avro_fixtures.as_log(records.where(F.col("batch_id") == b), F.lit(b)), f"{job_dir}/log")
        stream = log.log_stream(spark, f"{job_dir}/log", job.checkpoint)
        events = cdc_from_kafka(stream, "avro", avro_fixtures.CDC_READER, avro_fixtures.CDC_WRITERS)
        events = events.withColumn("partition", F.col("partition") % fixtures.CDC_PARTITIONS)
        log.drain(job.start(events, {"processingTime": "0 seconds"}))
    job.flush()
    return job


def stream_avro_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after the Avro stream; equals ``cdc_final_state``."""
    return _applied(spark, sf_dir).final_state()


def stream_avro_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every event of the Avro stream, undecodable records among them."""
    return _applied(spark, sf_dir).status()


QUERIES = {"decode_avro_events": decode_avro_events, "stream_avro_apply": stream_avro_apply,
           "stream_avro_status": stream_avro_status}

_KIND, _KINDS = avro_fixtures.UNDECODABLE_KIND, fixtures.KINDS
ORACLE = {
    "decode_avro_events": """
WITH rec AS (
  SELECT *, CASE WHEN event_id % 97 = 0 THEN 'bad_magic' WHEN event_id % 101 = 0 THEN 'bad_body'
                 WHEN event_id % 103 = 0 THEN 'unknown_schema' ELSE 'ok' END AS status FROM events)
SELECT 'events' AS topic, CAST(event_id % 8 AS INTEGER) AS "partition", CAST(event_id // 8 AS BIGINT) AS "offset",
       CAST(CASE WHEN event_id % 2 = 1 THEN 101 ELSE 102 END
            + CASE WHEN status = 'unknown_schema' THEN 1000 ELSE 0 END AS BIGINT) AS schema_id, status,
       CASE WHEN status = 'ok' THEN event_id END AS event_id, CASE WHEN status = 'ok' THEN user_id END AS user_id,
       CASE WHEN status = 'ok' THEN event_type END AS event_type,
       CASE WHEN status = 'ok' THEN epoch_us(ts) END AS ts_micros,
       CASE WHEN status = 'ok' THEN CASE WHEN event_id % 2 = 1 THEN value
            ELSE CAST(CAST(value AS FLOAT) AS DOUBLE) END END AS value,
       CASE WHEN status = 'ok' THEN CASE WHEN event_id % 2 = 1 THEN props ELSE 'none' END END AS props
FROM rec""",
    "stream_avro_apply": CDC_ORACLE["cdc_final_state"],
    "stream_avro_status": f"""{CDC_ORACLE["cdc_apply_status"]}
UNION ALL
SELECT 1, 'cdc', CAST(c_custkey % 4 AS INTEGER), CAST((c_custkey * 32 + {_KIND}) * {_KINDS} + 3 AS BIGINT), 0,
       'rejected', 'undecodable'
FROM customer WHERE c_custkey % 50 = 7""",
}
