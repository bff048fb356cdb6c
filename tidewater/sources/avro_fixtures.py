"""Registry-framed Avro records that Spark derives from the driver's tables.

Two writer schemas each for the ``events`` table and for the change events, as a registry
holds them after a schema has been changed: other field order, fields more, fields
less, another field name, another number type.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources import fixtures
from tidewater.sources.avro import Schema, encoder, framed
from tidewater.sources.tables import read_table


def _record(name: str, fields: list[tuple]) -> str:
    keys = ("name", "type", "default", "aliases")
    return json.dumps({"type": "record", "name": name, "namespace": "fixture", "fields": [
        {k: v for k, v in zip(keys, f) if v is not ...} for f in fields]})


MICROS = {"type": "long", "logicalType": "timestamp-micros"}
NULL_OR = lambda kind: ["null", kind]

#: The events' schemas by registry id, and the one they are read with.
EVENT_WRITERS = {
    101: _record("Event", [("event_id", "long"), ("ts", MICROS), ("user_id", "long"), ("kind", "string"),
                           ("value", "double"), ("props", "string")]),
    102: _record("Event", [("trace", {"type": "map", "values": "string"}), ("kind", "string"),
                           ("value", NULL_OR("float")), ("event_id", "long"), ("user_id", "int"), ("ts", MICROS)])}
EVENT_READER = _record("Event", [("event_id", "long"), ("user_id", "long"), ("event_type", "string", ..., ["kind"]),
                                 ("ts", MICROS), ("value", NULL_OR("double"), None), ("props", "string", "none")])
#: Every so many events: a magic byte of 1, a body without its last byte, an unknown id.
BAD_MAGIC_EVERY, CUT_EVERY, UNKNOWN_EVERY = 97, 101, 103

_CELLS = {"type": "map", "values": "string"}
#: The change events' schemas.
CDC_WRITERS = {
    1: _record("ChangeEvent", [("tableName", "string"), ("actionType", "string"), ("columns", _CELLS)]),
    2: _record("ChangeEvent", [("seq", "long"), ("where", NULL_OR("string")), ("columns", _CELLS),
                               ("host", NULL_OR("string")), ("actionType", "string"), ("tableName", "string")])}
CDC_READER = _record("ChangeEvent", [("tableName", "string"), ("actionType", "string"), ("columns", _CELLS),
                                     ("where", NULL_OR("string"), None)])


def encoded(rows: DataFrame, writers: dict[int, str], physical: Callable[[dict], dict]) -> DataFrame:
    """Rows (schema_id, fault, body struct, ...) with ``value``, the framed body, in place of the three.
    ``fault``: null, ``magic``, ``cut`` or ``id``."""
    keep = [f for f in rows.schema.fields if f.name not in ("schema_id", "fault", "body")]
    out = type(rows.schema)([*keep]).add("value", "binary")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        write = {i: encoder(Schema(text).root) for i, text in writers.items()}
        for b in batches:
            values = []
            for i, fault, body in zip(*(b.column(c).to_pylist() for c in ("schema_id", "fault", "body"))):
                data = framed(i + 1000 if fault == "id" else i, write[i](physical(body)))
                values.append(b"\1" + data[1:] if fault == "magic" else data[:-1] if fault == "cut" else data)
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), pa.array(values, pa.binary())],
                                             [*(f.name for f in keep), "value"])

    return rows.mapInArrow(run, out)


def _event(body: dict) -> dict:
    """The event's values as both writers take them (a union's as branch and value)."""
    return body | {"trace": {"host": "h", "event": str(body["event_id"])},
                   "value": body["value"] if body["odd"] else (0, None) if body["value"] is None else (1, body["value"])}


def avro_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka records of the ``events`` table: odd ids by schema 101, even ones by 102."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    eid, odd = F.col("event_id"), F.col("event_id") % 2 == 1
    body = F.struct("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "user_id",
                    F.col("event_type").alias("kind"), "value", "props", odd.alias("odd"))
    fault = (F.when(eid % BAD_MAGIC_EVERY == 0, F.lit("magic")).when(eid % CUT_EVERY == 0, F.lit("cut"))
              .when(eid % UNKNOWN_EVERY == 0, F.lit("id")))
    rows = ev.select(F.when(odd, F.lit(101)).otherwise(F.lit(102)).alias("schema_id"), fault.alias("fault"),
                     body.alias("body"), F.lit(fixtures.EVENTS_TOPIC).alias("topic"),
                     (eid % fixtures.EVENTS_PARTITIONS).cast("int").alias("partition"),
                     F.floor(eid / fixtures.EVENTS_PARTITIONS).cast("long").alias("offset"))
    return encoded(rows, EVENT_WRITERS, _event)


#: Undecodable change events: one per customer of the malformed events, of a kind of its own.
UNDECODABLE_KIND = 15


def _undecodable(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    cell = F.create_map(F.lit("note"), F.lit("String:lost"))
    offset = (k * 32 + UNDECODABLE_KIND) * fixtures.KINDS + fixtures.BAD_KIND
    return customer.where(k % 50 == 7).select(
        F.lit(fixtures.CDC_TOPIC).alias("topic"), (k % fixtures.CDC_PARTITIONS).cast("int").alias("partition"),
        offset.cast("long").alias("offset"), F.lit(1).cast("long").alias("batch_id"),
        offset.cast("long").alias("seq"), F.lit("customer").alias("tableName"), F.lit("update").alias("actionType"),
        cell.alias("columns"), F.concat(F.lit("cust_key="), k.cast("string")).alias("where"),
        F.lit(True).alias("lost"))


def _change(body: dict) -> dict:
    where = body["where"]
    return body | {"where": (0, None) if where is None else (1, where), "host": (0, None)}


def avro_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka records of the change events and their batch: those without a predicate by schema 1,
    the others by schema 2; and records that cannot be decoded (half their frames, half their bodies)."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey"])
    events = fixtures.read_cdc_events(spark, sf_dir).withColumn("lost", F.lit(False)) \
        .unionByName(_undecodable(customer))
    body = F.struct("tableName", "actionType", "columns", "where", "seq")
    bare = F.coalesce(F.col("where") == "", F.lit(False))
    fault = F.when(F.col("lost"), F.when(F.col("partition") % 2 == 0, F.lit("cut")).otherwise(F.lit("magic")))
    rows = events.select(F.when(bare, F.lit(1)).otherwise(F.lit(2)).alias("schema_id"), fault.alias("fault"),
                         body.alias("body"), "topic", "partition", "offset", "batch_id")
    return encoded(rows, CDC_WRITERS, _change)


def as_log(records: DataFrame, batch: Column) -> DataFrame:
    """Kafka-shaped rows in log partitions of their own for each batch, as offsets of the change
    events do not grow from batch to batch. ``partition % CDC_PARTITIONS`` is the event's."""
    return records.select(F.lit(None).cast("binary").alias("key"), "value", "topic",
                          (F.col("partition") + batch * fixtures.CDC_PARTITIONS).cast("int").alias("partition"),
                          "offset", F.lit(0).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
