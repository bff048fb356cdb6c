"""Start-offset policies and record decoders on literal edge cases."""

import json

import pytest

from tidewater.operators.offsets import POLICIES, resolve_start_offsets
from tidewater.sources import kafka
from tidewater.sources.kafka import registry_header, starting_offsets_json

# partition: (committed, earliest, latest)
CASES = {0: (None, 0, 100), 1: (50, 0, 100), 2: (5, 10, 100), 3: (120, 0, 100),
         4: (10, 10, 100), 5: (100, 10, 100), 6: (None, 7, 9)}
EXPECTED = {
    "zero":            {0: 0, 1: 50, 2: 5, 3: 120, 4: 10, 5: 100, 6: 0},
    "latest":          {0: 0, 1: 100, 2: 100, 3: 100, 4: 100, 5: 100, 6: 0},
    "resume_latest":   {0: 0, 1: 50, 2: 100, 3: 100, 4: 10, 5: 100, 6: 7},
    "resume_earliest": {0: 0, 1: 50, 2: 10, 3: 120, 4: 10, 5: 100, 6: 7},
    "group":           {0: 0, 1: 50, 2: 100, 3: 100, 4: 10, 5: 100, 6: 7},
    "group_latest":    {0: 0, 1: 100, 2: 100, 3: 100, 4: 100, 5: 100, 6: 7},
}


@pytest.mark.parametrize("policy", POLICIES)
def test_policies(spark, policy):
    bounds = spark.createDataFrame([("t", p, e, l) for p, (c, e, l) in CASES.items()],
                                   "topic string, partition int, earliest long, latest long")
    committed = spark.createDataFrame([("t", p, c) for p, (c, e, l) in CASES.items() if c is not None],
                                      "topic string, partition int, committed long")
    got = {r.partition: r.start_offset
           for r in resolve_start_offsets(committed, bounds, policy).collect()}
    assert got == EXPECTED[policy]
    if policy == "resume_latest":   # property: always inside the log
        assert all(CASES[p][1] <= o <= CASES[p][2] for p, o in got.items())


@pytest.mark.parametrize("policy", POLICIES)
def test_partitions_without_bounds_are_kept(spark, policy):
    bounds = spark.createDataFrame([("t", 0, 0, 9), ("t", 2, None, None)],
                                   "topic string, partition int, earliest long, latest long")
    committed = spark.createDataFrame([("t", 0, 4), ("t", 1, 6)],
                                      "topic string, partition int, committed long")
    got = {r.partition: r.start_offset
           for r in resolve_start_offsets(committed, bounds, policy).collect()}
    assert got.keys() == {0, 1, 2} and got[1] == 6 and got[2] == 0


def test_starting_offsets_json(spark):
    df = spark.createDataFrame([("t", 0, 5), ("t", 1, -2), ("u", 0, 7)],
                               "topic string, partition int, start_offset long")
    assert json.loads(starting_offsets_json(df)) == {"t": {"0": 5, "1": -2}, "u": {"0": 7}}


def test_registry_header(spark):
    rows = [(b"",), (b"\x00\x00\x00\x01",), (b"\x01\x00\x00\x00\x07abc",),
            (b"\x00\x00\x00\x01\x00{}",), (b"\x00\xff\xff\xff\xff",), (None,)]
    df = spark.createDataFrame(rows, "value binary").select(registry_header().alias("h"))
    got = [(r.h.magic, r.h.schema_id, r.h.status, None if r.h.body is None else bytes(r.h.body))
           for r in df.collect()]
    assert got == [(None, None, "short", None), (None, None, "short", None),
                   (1, 7, "bad_magic", None), (0, 256, "ok", b"{}"),
                   (0, 4294967295, "ok", b""), (None, None, "short", None)]


def test_kafka_options_and_rate():
    from tidewater.sources.kafka import kafka_options, max_offsets_per_trigger

    opts = kafka_options("b1:9092", "cdc", "g1", "earliest", max_offsets_per_trigger(2000, 4, 10))
    assert opts["kafka.bootstrap.servers"] == "b1:9092" and opts["subscribe"] == "cdc"
    assert opts["kafka.group.id"] == "g1" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "80000"


def test_decode_with_column_and_pandas(spark):
    from tidewater.sources.kafka import decode_in_pandas, decode_with, value_json

    df = spark.createDataFrame([("t", 0, 1, b'{"k": 5}'), ("t", 0, 2, b"k=7;v=x"), ("t", 1, 3, None)],
                               "topic string, partition int, offset long, value binary")
    got = [r.decoded for r in decode_with(df, lambda v: value_json("k INT", "value")).orderBy("offset").collect()]
    assert got[0].k == 5 and got[1] is None or got[1].k is None

    def kv(b):   # a format no Column expression parses directly
        d = dict(p.split("=", 1) for p in b.decode().split(";") if "=" in p)
        return {"k": int(d["k"]), "v": d.get("v")} if "k" in d else None

    rows = decode_in_pandas(df, kv, "k int, v string").orderBy("offset").collect()
    assert [(r.offset, r.k, r.v) for r in rows] == [(1, None, None), (2, 7, "x"), (3, None, None)]


def test_starting_offsets_from_previous_progress(spark):
    from tests.conftest import SF_SMALL
    from tidewater.operators.offsets import starting_offsets
    from tidewater.sources.fixtures import read_kafka_records

    records = read_kafka_records(spark, SF_SMALL)      # 8 partitions, offsets 0..n-1
    bounds = {r.partition: r.latest for r in records.groupBy("partition").agg(
        (spark_max("offset") + 1).alias("latest")).collect()}
    progress = spark.createDataFrame(
        [("events", 0, 0, 10, 10, 0), ("events", 0, 10, 20, 10, 1), ("events", 1, 0, 10**9, 1, 0)],
        "topic string, partition int, from_offset long, until_offset long, records long, epoch long")
    got = json.loads(starting_offsets(records, progress, "resume_latest"))["events"]
    assert got["0"] == 20                 # resume at the highest commit
    assert got["1"] == bounds[1]          # commit past the log end -> latest
    assert got["2"] == 0                  # no commit -> earliest


def spark_max(c):
    from pyspark.sql import functions as F

    return F.max(c)


@pytest.mark.parametrize("policy", ["group", "group_latest"])
def test_first_use_of_a_group_starts_at_zero(spark, policy):
    bounds = spark.createDataFrame([("t", 0, 5, 9), ("t", 1, 7, 8)],
                                   "topic string, partition int, earliest long, latest long")
    none = spark.createDataFrame([], "topic string, partition int, committed long")
    got = [r.start_offset for r in resolve_start_offsets(none, bounds, policy).collect()]
    assert got == [0, 0]


def test_undecodable_json_is_kept(spark):
    from tidewater.cli import cdc_from_kafka

    rows = [(b'{"tableName": "c", "actionType": "insert", "columns": {"custKey": "Long:1"}, "where": ""}',),
            (b"no json",), (None,)]
    df = spark.createDataFrame([("t", 0, i, *r) for i, r in enumerate(rows)],
                               "topic string, partition int, offset long, value binary")
    got = {r.offset: (r.undecodable, r.tableName) for r in cdc_from_kafka(df, "json").collect()}
    assert got == {0: (False, "c"), 1: (True, None), 2: (True, None)}


def test_key_option():
    from tidewater.cli import key_option

    assert key_option("a") == ("a",) and key_option("a,b") == ("a", "b")
    assert key_option('{"t": ["a", "b"], "": "k"}') == {"t": ("a", "b"), None: ("k",)}


def test_key_values_of_a_key_text():
    from tidewater.sinks.dbapi import key_values

    assert key_values("a,b", 1) == ["a,b"]
    assert key_values(r"a\\b and c=1,\,", 2) == [r"a\b and c=1", ","]
    assert key_values(",x", 2) == ["", "x"]


def test_supplied_decoder_of_nested_types(spark):
    """Types with commas, nested fields, and values that cannot be decoded."""
    import json
    from decimal import Decimal

    def decode(value):
        got = json.loads(value)
        return got | {"price": Decimal(got["price"]) if "price" in got else None}

    schema = "price decimal(18,2), who struct<name:string,ids:array<int>>, tags map<string,bigint>"
    rows = [(0, b'{"price": "12.50", "who": {"name": "a", "ids": [1, 2]}, "tags": {"x": 5}}'), (1, b"{}"), (2, None),
            (3, b"no json"), (4, b'{"who": "not a struct"}'), (5, b'{"who": {"name": "b", "ids": null}}')]
    df = spark.createDataFrame([("t", 0, o, v) for o, v in rows], "topic string, partition int, offset long, value binary")
    out = kafka.decode_in_pandas(df, decode, schema, reject="why")
    assert out.dtypes[3:] == [("price", "decimal(18,2)"), ("who", "struct<name:string,ids:array<int>>"),
                              ("tags", "map<string,bigint>"), ("why", "string")]
    got = {r.offset: r for r in out.collect()}
    assert (got[0].price, got[0].who.ids, got[0].tags, got[0].why) == (Decimal("12.50"), [1, 2], {"x": 5}, None)
    assert all(got[o].price is None and got[o].who is None and got[o].why is None for o in (1, 2))
    assert got[3].why.startswith("JSONDecodeError") and got[4].why and got[4].who is None
    assert got[5].who.name == "b"
