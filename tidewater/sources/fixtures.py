"""Kafka-shaped inputs derived by Spark from the driver's tables.

Nothing here is made up: every row comes from a row of ``customer``,
``orders``, ``events``, ``documents`` or ``conversations`` by a fixed rule
(FIXTURES.md), so the work grows with the tables. All rules are per row
(no window, no shuffle) so they scale like a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.tables import read_table

CDC_TOPIC = "cdc"
CDC_PARTITIONS = 4
EVENTS_TOPIC = "events"
EVENTS_PARTITIONS = 8

# The Kafka offset of an event is its sequence number: KINDS times a key, plus
# the kind. The kinds interleave, so no two events of a topic and partition
# meet however large the keys are. Offsets of a real topic may have gaps as
# well (compaction, transaction markers).
KINDS = 4
INSERT_KIND, UPDATE_KIND, LATE_KIND, BAD_KIND = range(KINDS)
# A second topic repeats the insert of some customers at the same partition
# and offset: only the topic orders the two.
SECOND_TOPIC = "cdc2"
SECOND_EVERY = 40

CDC_COLUMNS = ["topic", "partition", "offset", "batch_id", "seq", "tableName",
               "actionType", "columns", "where"]


def _s(c: Column) -> Column:
    return c.cast("string")


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _event(topic, partition, seq, batch, table, action, columns, where) -> list[Column]:
    return [F.lit(topic).alias("topic"), partition.cast("int").alias("partition"),
            seq.cast("long").alias("offset"), batch.cast("long").alias("batch_id"),
            seq.cast("long").alias("seq"), table.alias("tableName"),
            action.alias("actionType"), columns.alias("columns"),
            where.cast("string").alias("where")]


def _inserts(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    late = (k % 20) == 0
    cols = F.create_map(
        F.lit("id"), F.concat(F.lit("Long:"), _s(k)),
        F.lit("custKey"), F.concat(F.lit("Long:"), _s(k)),
        F.lit("custName"), F.concat(F.lit("String:"), F.col("c_name")),
        F.lit("acctBal"), F.concat(F.lit("BigDecimal:"), _money(F.col("c_acctbal"))),
        F.lit("mktSegment"), F.concat(F.lit("String:"), F.col("c_mktsegment")),
        F.lit("remark"), F.lit("String: "))
    return customer.where((k % 20) != 10).select(*_event(
        CDC_TOPIC, k % CDC_PARTITIONS,
        k * KINDS + F.when(late, F.lit(LATE_KIND)).otherwise(F.lit(INSERT_KIND)),
        F.when(late, F.lit(2)).otherwise(F.lit(0)),
        F.lit("customer"), F.lit("insert"), cols, F.lit("")))


def _updates(orders: DataFrame) -> DataFrame:
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    cols = F.create_map(
        F.lit("acctBal"), F.concat(F.lit("BigDecimal:"), _money(F.col("o_totalprice"))),
        F.lit("lastOrderDate"), F.concat(
            F.lit("Date:"), F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss")),
        F.lit("remark"), F.lit("String:"))
    action = F.when((ok % 50) == 0, F.lit("delete")).otherwise(F.lit("update"))
    return orders.select(*_event(
        CDC_TOPIC, ck % CDC_PARTITIONS, ok * KINDS + UPDATE_KIND, F.lit(1),
        F.lit("customer"), action, cols, F.concat(F.lit("cust_key="), _s(ck))))


# Malformed and tricky events, one of each kind per customer with key % 50 = 7:
# (kind, table, action, where, cell name, cell text). "{k}" is the key.
BAD_KINDS = [
    (0, "customer", "update", "  ", "acctBal", "BigDecimal:1.00"),
    (1, "customer", "update", "cust_key={k}", "remark", "String: "),
    (2, "customer", "insert", "", "id", "Long:{k}"),
    (3, "customer", "update", "cust_key={k}", "note", ":"),
    (4, "customer", "update", "cust_key={k}", "note", "::"),
    (5, "customer", "update", "cust_key={k}", "note", "abc"),
    (6, "customer", "update", None, "acctBal", "BigDecimal:2.00"),
    (7, "t; drop table x", "update", "cust_key={k}", "acctBal", "BigDecimal:3.00"),
    (8, "customer", "update", "1=1 or k=2", "acctBal", "BigDecimal:4.00"),
    (9, "customer", "update", "cust_key={k}", "custName", "String:o'brien"),
    (10, "customer", "update", "cust_key={k}", "note", "String:a:b:c"),
    (11, "customer", "update", "cust_key={k}", "bad name;--", "String:x"),
    (12, "customer", "update", "cust_key=00{k}.0", "note", "String:padded"),
    (13, "customer", "update", "cust_key={k} and cust_key={k}", "note", "String:twice"),
    (14, "account", "update", "id={k}", "note", "String:half a key"),
]

# Key columns by table; ``account`` has a key of two, one of them ``id``.
CDC_KEYS = {"account": ("id", "tenant"), None: "cust_key"}
ACCOUNT_EVERY = 50


def _fmt(template: str | None, k: Column) -> Column:
    if template is None:
        return F.lit(None).cast("string")
    if "{k}" not in template:
        return F.lit(template)
    head, tail = template.split("{k}", 1)
    return F.concat(F.lit(head), _s(k), F.lit(tail))


def _bad(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    kinds = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(table).alias("table"),
                 F.lit(action).alias("action"), _fmt(where, k).alias("where"),
                 F.create_map(F.lit(name), _fmt(cell, k)).alias("columns"))
        for kind, table, action, where, name, cell in BAD_KINDS])
    rows = customer.where((k % 50) == 7).select(k, F.explode(kinds).alias("b"))
    return rows.select(*_event(
        CDC_TOPIC, k % CDC_PARTITIONS, (k * 32 + F.col("b.kind")) * KINDS + BAD_KIND, F.lit(1),
        F.col("b.table"), F.col("b.action"), F.col("b.columns"), F.col("b.where")))


def _second(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    cols = F.create_map(F.lit("custKey"), F.concat(F.lit("Long:"), _s(k)),
                        F.lit("custName"), F.lit("String:second"))
    return customer.where((k % SECOND_EVERY) == 3).select(*_event(
        SECOND_TOPIC, k % CDC_PARTITIONS, k * KINDS + INSERT_KIND, F.lit(0),
        F.lit("customer"), F.lit("insert"), cols, F.lit("")))


def _accounts(customer: DataFrame) -> DataFrame:
    """Inserts (batch 0) and updates (batch 1) of the two-column key, for key % 50 = 11."""
    k = F.col("c_custkey")
    tenant = _s(k % 3)
    insert = F.create_map(F.lit("id"), F.concat(F.lit("Long:"), _s(k)),
                          F.lit("tenant"), F.concat(F.lit("Integer:0"), tenant),
                          F.lit("note"), F.lit("String:opened"))
    update = F.create_map(F.lit("note"), F.lit("String:changed"))
    where = F.concat(F.lit("tenant="), tenant, F.lit(" AND id="), _s(k))
    both = F.explode(F.array(
        F.struct(F.lit("insert").alias("a"), F.lit(0).alias("b"), F.lit(0).alias("n"),
                 insert.alias("c"), F.lit("").alias("w")),
        F.struct(F.lit("update").alias("a"), F.lit(1).alias("b"), F.lit(1).alias("n"),
                 update.alias("c"), where.alias("w"))))
    rows = customer.where((k % ACCOUNT_EVERY) == 11).select(k, both.alias("e"))
    return rows.select(*_event(
        "accounts", k % CDC_PARTITIONS, k * 2 + F.col("e.n"), F.col("e.b"), F.lit("account"),
        F.col("e.a"), F.col("e.c"), F.col("e.w")))


def cdc_events(customer: DataFrame, orders: DataFrame, malformed: bool = True) -> DataFrame:
    """Change events (FIXTURES.md section 3).

    Inserts from customers (batch 0; key % 20 = 10 never inserted, key % 20 = 0
    inserted late in batch 2), updates from orders (batch 1, ``delete`` for
    order key % 50 = 0), repeated inserts in a second topic (batch 0), and
    malformed events in batch 1.
    """
    parts = [_inserts(customer), _updates(orders), _second(customer), _accounts(customer)]
    if malformed:
        parts.append(_bad(customer))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_cdc_events(spark: SparkSession, sf_dir: str, malformed: bool = True) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer",
                          ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    return cdc_events(customer, orders, malformed)


# Registry framing: magic byte 0, then a 4-byte big-endian schema id.
SCHEMA_ID_BASE = 0x01020304
BAD_MAGIC_EVERY = 97
# Faulty JSON values: null on every 89th event, without the last character on
# every 83rd (from the second).
NULL_VALUE_EVERY, CUT_VALUE_EVERY = 89, 83


def kafka_records(events: DataFrame, value_format: str = "text") -> DataFrame:
    """Kafka records (key, value BINARY, topic, partition, offset, timestamp,
    timestampType) from the ``events`` table (FIXTURES.md section 4).

    ``value_format``: ``text`` / ``bytes`` carry ``props`` as UTF-8 bytes;
    ``registry`` frames them as magic byte + 4-byte schema id + body, with
    magic 1 (to be rejected) on every 97th event; ``faulty`` is ``text`` with
    null and cut values.
    """
    eid = F.col("event_id")
    body = F.encode(F.col("props"), "UTF-8")
    if value_format in ("text", "bytes"):
        value = body
    elif value_format == "faulty":
        short = F.encode(F.expr("left(props, length(props) - 1)"), "UTF-8")
        value = F.when((eid % NULL_VALUE_EVERY) == 0, F.lit(None)) \
            .when((eid % CUT_VALUE_EVERY) == 1, short).otherwise(body)
    elif value_format == "registry":
        magic = F.when((eid % BAD_MAGIC_EVERY) == 0, F.lit("01")).otherwise(F.lit("00"))
        number = F.lit(SCHEMA_ID_BASE) + F.col("user_id")
        schema_id = F.when(number < (1 << 32), F.lpad(F.hex(number), 8, "0")).otherwise(
            F.raise_error(F.lit("schema id above 32 bits")))
        value = F.concat(F.unhex(F.concat(magic, schema_id)), body)
    else:
        raise ValueError(f"unknown value_format {value_format!r}")
    return events.select(
        F.encode(_s(F.col("user_id")), "UTF-8").alias("key"),
        value.alias("value"),
        F.lit(EVENTS_TOPIC).alias("topic"),
        (eid % EVENTS_PARTITIONS).cast("int").alias("partition"),
        F.floor(eid / EVENTS_PARTITIONS).cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def read_kafka_records(spark: SparkSession, sf_dir: str, value_format: str = "text") -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "props"])
    return kafka_records(ev, value_format)


# Consumer-group fixture over the ``events`` topic. Retention has removed the
# first records of even partitions (earliest > 0 there); the committed offset
# of partition p follows case p % 8 (fixed values):
#   0, 6: no commit          1: (earliest + latest) / 2     2: earliest - 1
#   3: latest + 5            4: earliest                    5: latest
#   7: earliest + 1
RETENTION_CUT = 10


def retained(records: DataFrame) -> DataFrame:
    """The records that retention has left."""
    return records.where((F.col("partition") % 2 == 1) | (F.col("offset") >= RETENTION_CUT))


def log_bounds(records: DataFrame) -> DataFrame:
    """(topic, partition, earliest, latest) with the retention rule above."""
    from tidewater.operators.offsets import log_bounds as bounds

    cut = F.when(F.col("partition") % 2 == 0, F.lit(RETENTION_CUT)).otherwise(F.lit(0))
    return bounds(records, retained_from=cut)


def committed_offsets(bounds: DataFrame) -> DataFrame:
    """(topic, partition, committed) by the case rule above; partitions
    without a commit have no row."""
    e, l, case = F.col("earliest"), F.col("latest"), F.col("partition") % 8
    c = (F.when(case == 1, F.floor((e + l) / 2)).when(case == 2, e - 1)
          .when(case == 3, l + 5).when(case == 4, e).when(case == 5, l)
          .when(case == 7, e + 1))
    return bounds.select("topic", "partition", c.cast("long").alias("committed")) \
                 .where(F.col("committed").isNotNull())
