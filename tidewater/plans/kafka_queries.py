"""Registered Kafka-side queries: start offsets, progress, decoding (10-16)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import offsets
from tidewater.sources import fixtures, kafka

# Per-partition records per batch: a rate cap times the batch interval.
RECORDS_PER_PARTITION_PER_BATCH = 250


def start_offsets(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    """Queries 10-13: start offset of every partition under ``policy``."""
    records = fixtures.read_kafka_records(spark, sf_dir)
    bounds = fixtures.log_bounds(records)
    committed = fixtures.committed_offsets(bounds)
    return offsets.resolve_start_offsets(committed, bounds, policy)


def batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 14: consumed range per rate-capped batch and partition."""
    records = fixtures.read_kafka_records(spark, sf_dir).select("topic", "partition", "offset")
    return offsets.batch_progress(
        offsets.rate_batches(records, RECORDS_PER_PARTITION_PER_BATCH))


def decode_text_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 15: key and value as text, value parsed as JSON (``k``)."""
    r = fixtures.read_kafka_records(spark, sf_dir, "text")
    return r.select("topic", "partition", "offset",
                    kafka.key_string().alias("key"), kafka.value_string().alias("value"),
                    kafka.value_json("k BIGINT")["k"].alias("k"))


def decode_bytes_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 16: registry frame split; bad magic rejected, body kept as bytes
    and shown as text."""
    r = fixtures.read_kafka_records(spark, sf_dir, "registry")
    h = kafka.registry_header()
    return (r.select("topic", "partition", "offset", h.alias("h"))
             .select("topic", "partition", "offset", "h.magic", "h.schema_id", "h.status",
                     F.length("h.body").cast("long").alias("body_bytes"),
                     F.col("h.body").cast("string").alias("body_text")))


def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that cannot be decoded, with the reason: JSON values (null or cut short) and
    registry frames (bad magic)."""
    text = fixtures.read_kafka_records(spark, sf_dir, "faulty")
    frames = fixtures.read_kafka_records(spark, sf_dir, "registry")
    both = text.select(F.lit("json").alias("format"), "topic", "partition", "offset",
                       kafka.json_status("k BIGINT").alias("reason")).unionByName(
        frames.select(F.lit("registry").alias("format"), "topic", "partition", "offset",
                      kafka.registry_header()["status"].alias("reason")))
    return both.where(F.col("reason") != "ok")


QUERIES = {
    **{f"start_offsets_{p}": partial(start_offsets, policy=p) for p in offsets.POLICIES},
    "batch_progress": batch_progress,
    "decode_text_json": decode_text_json,
    "decode_bytes_header": decode_bytes_header,
    "decode_rejects": decode_rejects,
}
