"""Kafka sources and record decoders (S1-S9, D1-D4; Avro bodies: ``sources.avro``).

Reading uses Spark's Kafka source (``format("kafka")``); it needs the
``spark-sql-kafka`` package on the classpath, which this environment lacks, so
those two readers are written but unverified here. Tests feed the same
operators from Kafka-shaped parquet files (``read_kafka_files``) with the
source's schema. Decoders are Column functions, identical for both.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset long, "
                "timestamp timestamp, timestampType int")

# Registry framing (fixed values): magic byte 0, 4-byte big-endian schema id.
REGISTRY_MAGIC = 0
REGISTRY_HEADER_BYTES = 5


def kafka_options(brokers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str | None = None,
                  max_offsets_per_trigger: int | None = None,
                  extra: dict[str, str] | None = None) -> dict[str, str]:
    """Source options (S7): brokers, subscription, consumer group, start, rate."""
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic,
            # progress lives in the checkpoint; a lost offset range must fail
            # loudly rather than silently skip data
            "failOnDataLoss": "true"}
    if group_id:
        opts["kafka.group.id"] = group_id
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def max_offsets_per_trigger(rate_per_partition: int, partitions: int,
                            interval_seconds: float) -> int:
    """A per-partition rate cap as the source's total cap per trigger."""
    return int(rate_per_partition * partitions * interval_seconds)


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming Kafka records (S1-S5 before decoding). Needs spark-sql-kafka."""
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_batch(spark: SparkSession, options: dict[str, str],
                     ending_offsets: str = "latest") -> DataFrame:
    """Batch read of an offset range. Needs spark-sql-kafka."""
    return (spark.read.format("kafka").options(**options)
            .option("endingOffsets", ending_offsets).load())


def read_kafka_files(spark: SparkSession, path: str, stream: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped parquet files (same schema as the Kafka source)."""
    if not stream:
        return spark.read.schema(KAFKA_SCHEMA).parquet(path)
    r = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


# ---- decoders (D1-D4) -------------------------------------------------------

def key_string(key: str = "key") -> Column:
    """Record key as UTF-8 text."""
    return F.col(key).cast("string")


def value_string(value: str = "value") -> Column:
    """Record value as UTF-8 text, not parsed."""
    return F.col(value).cast("string")


def value_bytes(value: str = "value") -> Column:
    """Record value untouched."""
    return F.col(value)


def value_json(schema: str, value: str = "value", corrupt: str | None = None) -> Column:
    """S5 with parsing: ``from_json`` onto a supplied schema. ``corrupt`` names a field that
    holds the text of a value that is no JSON (else null)."""
    if corrupt is None:
        return F.from_json(F.col(value).cast("string"), schema)
    return F.from_json(F.col(value).cast("string"), f"{schema}, `{corrupt}` STRING",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})


def json_status(schema: str, value: str = "value") -> Column:
    """``ok``, ``null_value`` or ``bad_json`` of a record's value."""
    parsed = value_json(schema, value, corrupt="_bad")
    return (F.when(F.col(value).isNull(), F.lit("null_value"))
             .when(parsed.isNull() | parsed["_bad"].isNotNull(), F.lit("bad_json"))
             .otherwise(F.lit("ok")))


def registry_header(value: str = "value") -> Column:
    """D1 header split: struct(magic, schema_id, body, status).

    ``status`` is ``ok``, ``short`` (under 5 bytes) or ``bad_magic``; ``body``
    is null unless ``ok``.
    """
    v = F.col(value)
    magic = F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int")
    schema_id = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long")
    short = F.length(v) < REGISTRY_HEADER_BYTES
    status = (F.when(v.isNull() | short, F.lit("short"))
               .when(magic != REGISTRY_MAGIC, F.lit("bad_magic")).otherwise(F.lit("ok")))
    body = F.when(status == "ok", F.substr(v, F.lit(REGISTRY_HEADER_BYTES + 1)))
    return F.struct(F.when(~short, magic).alias("magic"),
                    F.when(~short, schema_id).alias("schema_id"),
                    body.alias("body"), status.alias("status"))


def decode_with(df: DataFrame, decoder: Callable[[Column], Column],
                value: str = "value", name: str = "decoded") -> DataFrame:
    """S3 / S4 re-aimed: any Column decoder applied to the value bytes."""
    return df.withColumn(name, decoder(F.col(value)))


def decode_in_pandas(df: DataFrame, decode: Callable[[bytes], dict | None], schema: str | StructType,
                     keep: tuple[str, ...] = ("topic", "partition", "offset"),
                     reject: str | None = None) -> DataFrame:
    """S3 / S4 for formats no Column expression can parse: ``decode`` turns one value's bytes into a
    dict of ``schema`` fields (None -> all null); fields may be decimals, structs, arrays, maps.

    A value that ``decode`` raises on, or whose dict does not fit the types, fails the task;
    with ``reject`` it keeps its row with null fields, and the column of that name says why.
    Runs per record batch (``mapInArrow``), assembled as Arrow columns of the schema's types;
    the decoder is a small per-value helper, the batching and parallelism are Spark's.
    """
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kept = [df.schema[c] for c in keep]
    out = StructType([*kept, *fields.fields] + ([StructField(reject, StringType())] if reject else []))

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        types = {f.name: arrow.field(len(kept) + i).type for i, f in enumerate(fields)}

        def tried(value):
            """The dict of a value, and what is wrong with it."""
            try:
                row = (decode(value) if value is not None else None) or {}
                for name, kind in types.items() if reject else ():
                    pa.array([row.get(name)], kind)
                return row, None
            except Exception as e:      # the decoder is the user's: any error is the record's
                if not reject:
                    raise
                return {}, f"{type(e).__name__}: {e}"

        for b in batches:
            got = [tried(v) for v in b.column("value").to_pylist()]
            columns = [b.column(c) for c in keep]
            columns += [pa.array([r.get(name) for r, _ in got], kind) for name, kind in types.items()]
            columns += [pa.array([why for _, why in got], pa.string())] if reject else []
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.select(*keep, "value").mapInArrow(run, out)


def starting_offsets_json(start: DataFrame, offset_col: str = "start_offset") -> str:
    """``startingOffsets`` JSON from a ``(topic, partition, start_offset)`` table.

    The table has one row per topic partition (bounded by the topic's
    partition count), so bringing it to the driver is safe.
    """
    out: dict[str, dict[str, int]] = {}
    for r in start.select("topic", "partition", offset_col).collect():
        out.setdefault(r[0], {})[str(r[1])] = int(r[2])
    return json.dumps(out, sort_keys=True)
