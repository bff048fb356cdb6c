"""Avro bodies: the specification's examples, schema resolution, and the JVM's Avro library as the judge."""

import datetime as dt
import decimal
import json
import random

import pytest

from tidewater.sources import avro
from tidewater.sources.avro import Decoder, Resolver, Schema, SchemaError, encoder, write_long


def rec(*fields, name="R", **more):
    return json.dumps({"type": "record", "name": name, "fields": list(fields), **more})


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


def read(writer, reader, body):
    value, at = Resolver(Schema(writer), Schema(reader)).read(body, 0)
    assert at == len(body)
    return value


def test_numbers_of_the_specification():
    """Examples of the public specification."""
    for n, text in ((0, "00"), (-1, "01"), (1, "02"), (-2, "03"), (2, "04"), (-64, "7f"), (64, "8001")):
        assert write_long(n).hex() == text and avro.read_long(bytes.fromhex(text), 0) == (n, len(text) // 2)
    test = rec(field("a", "long"), field("b", "string"), name="test")
    assert read(test, test, bytes.fromhex("3606666f6f")) == {"a": 27, "b": "foo"}
    longs = '{"type": "array", "items": "long"}'
    assert read(longs, longs, bytes.fromhex("04063600")) == [3, 27]
    assert read('["null", "string"]', '["null", "string"]', bytes.fromhex("020261")) == "a"


def test_resolution_rules():
    w = rec(field("x", "int"), field("old", "string"), field("gone", {"type": "map", "values": "bytes"}),
            field("f", "float"), field("e", {"type": "enum", "name": "E", "symbols": ["A", "B", "C"]}),
            field("u", ["null", "int", "string"]), field("s", "string"))
    r = rec(field("u", ["null", "long", "string"]), field("new", "string", aliases=["old"]), field("x", "double"),
            field("f", "double"), field("s", "bytes"), field("d", ["int", "null"], default=7),
            field("e", {"type": "enum", "name": "E", "symbols": ["A", "Z"], "default": "Z"}),
            field("l", {"type": "array", "items": "string"}, default=["p"]))
    body = encoder(Schema(w).root)({"x": 5, "old": "was", "gone": {"k": b"v"}, "f": 0.5, "e": "B", "u": (1, 9), "s": "é"})
    assert read(w, r, body) == {"u": {"member0": 9}, "new": "was", "x": 5.0, "f": 0.5, "s": "é".encode(), "d": 7,
                                "e": "Z", "l": ["p"]}
    for bad in (rec(field("x", "string")), rec(field("y", "int")), rec(field("x", "int"), name="Other"), '"int"'):
        with pytest.raises(SchemaError):
            Resolver(Schema(rec(field("x", "int"))), Schema(bad))
    # A branch that the reader cannot take fails only where it is written.
    one = rec(field("v", ["int", "string"]))
    assert read(one, rec(field("v", "long")), b"\0\x06") == {"v": 3}
    with pytest.raises(ValueError):
        read(one, rec(field("v", "long")), b"\2\2a")


def test_recursive_writer_is_skipped_and_logical_types_read():
    tree = {"type": "record", "name": "Tree", "fields": [
        field("v", "int"), field("next", {"type": "array", "items": "Tree"})]}
    w = rec(field("tree", tree), field("day", {"type": "int", "logicalType": "date"}),
            field("at", {"type": "long", "logicalType": "timestamp-millis"}),
            field("sum", {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}))
    full = json.loads(w)["fields"][1:]
    node = {"v": 1, "next": [{"v": 2, "next": [{"v": 3, "next": []}]}, {"v": 4, "next": []}]}

    def tree_bytes(n):
        return write_long(n["v"]) + (write_long(len(n["next"])) + b"".join(map(tree_bytes, n["next"]))
                                     if n["next"] else b"") + b"\0"
    body = tree_bytes(node) + write_long(3) + write_long(1500) + write_long(2) + (-12345).to_bytes(2, "big", signed=True)
    assert read(w, rec(*full), body) == {
        "day": dt.date(1970, 1, 4), "at": dt.datetime(1970, 1, 1, 0, 0, 1, 500000, dt.timezone.utc),
        "sum": decimal.Decimal("-123.45")}
    with pytest.raises(SchemaError):
        avro.spark_type(Schema(json.dumps(tree)).root)
    # Blocks with their size, as other writers may write them, are read and skipped.
    longs = rec(field("a", {"type": "array", "items": "long"}), field("b", "int"))
    sized = bytes([3, 4, 2, 4, 2, 6, 0, 10])        # -2 items of 2 bytes, then 1 item, end; b
    assert read(longs, longs, sized) == {"a": [1, 2, 3], "b": 5}
    assert read(longs, rec(field("b", "int")), sized) == {"b": 5}




def test_bodies_of_the_jvm_library(spark):
    """What the JVM's library writes from JSON, this reader reads."""
    jvm = spark.sparkContext._jvm
    schema = rec(field("i", "int"), field("l", "long"), field("d", "double"), field("s", "string"),
                 field("m", {"type": "map", "values": "string"}), field("o", ["null", "string"]),
                 field("a", {"type": "array", "items": rec_in()}), field("b", "boolean"),
                 field("x", {"type": "fixed", "name": "Four", "size": 4}),
                 field("e", {"type": "enum", "name": "Suit", "symbols": ["X", "Y"]}))
    parsed = jvm.org.apache.avro.Schema.Parser().parse(schema)
    rng = random.Random(9)
    decoder = Decoder(schema, {1: schema})
    for _ in range(200):
        row = {"i": rng.randrange(-2**31, 2**31), "l": rng.randrange(-2**63, 2**63), "d": rng.random(),
               "s": "é𝔘" * rng.randrange(90), "m": {f"k{i}": "v" * i for i in range(rng.randrange(70))},
               "o": rng.choice([None, {"string": "there"}]), "a": [{"q": i} for i in range(rng.randrange(4))],
               "b": rng.random() < .5, "x": "\x00\xff~a", "e": rng.choice("XY")}
        data = jvm.org.apache.avro.io.DecoderFactory.get().jsonDecoder(parsed, json.dumps(row))
        value = jvm.org.apache.avro.generic.GenericDatumReader(parsed).read(None, data)
        out = jvm.java.io.ByteArrayOutputStream()
        binary = jvm.org.apache.avro.io.EncoderFactory.get().binaryEncoder(out, None)
        jvm.org.apache.avro.generic.GenericDatumWriter(parsed).write(value, binary)
        binary.flush()
        got = decoder.body(1, bytes(out.toByteArray()))
        want = row | {"o": row["o"] and row["o"]["string"], "x": b"\x00\xff~a", "m": sorted(row["m"].items())}
        assert got | {"m": sorted(got["m"])} == want


def rec_in():
    return {"type": "record", "name": "Inner", "fields": [field("q", "int")]}


def test_damaged_bodies_are_reported_not_raised():
    schema = rec(field("s", "string"), field("n", ["null", "long"]), field("e", {"type": "enum", "name": "E", "symbols": ["A"]}))
    decoder = Decoder(schema, {3: schema})
    good = avro.framed(3, encoder(Schema(schema).root)({"s": "text", "n": (1, 2 ** 62), "e": "A"}))
    assert decoder.framed(good) == ({"s": "text", "n": 2 ** 62, "e": "A"}, "ok", 3)
    rng = random.Random(10)
    for cut in range(len(good)):
        assert decoder.framed(good[:cut])[1] == ("short" if cut < 5 else "bad_body")
    assert decoder.framed(good + b"\0")[1] == "bad_body" and decoder.framed(None)[1] == "short"
    assert decoder.framed(b"\1" + good[1:])[1] == "bad_magic"
    assert decoder.framed(avro.framed(4, good[5:]))[1:] == ("unknown_schema", 4)
    for _ in range(3000):       # no noise may raise
        noise = avro.framed(3, bytes(rng.randrange(256) for _ in range(rng.randrange(12))))
        assert decoder.framed(noise)[1] in ("ok", "bad_body")


def test_decode_registry_keeps_rows_and_types(spark):
    w1 = rec(field("id", "int"), field("tags", {"type": "map", "values": "int"}))
    w2 = rec(field("more", "string"), field("id", "long"))
    r = rec(field("id", "long"), field("tags", {"type": "map", "values": "long"}, default={"none": 1}),
            field("price", ["null", {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2}], default=None))
    e1, e2 = encoder(Schema(w1).root), encoder(Schema(w2).root)
    rows = [(0, avro.framed(1, e1({"id": 1, "tags": {"a": 2}}))), (1, avro.framed(2, e2({"more": "x", "id": 2 ** 40}))),
            (2, b"\1\0\0\0\1"), (3, None), (4, avro.framed(9, b"")), (5, avro.framed(1, b"\xff"))]
    df = spark.createDataFrame([(n, v, "keep") for n, v in rows], "n int, value binary, decoded_by string")
    out = avro.decode_registry(df, r, {1: w1, 2: w2})
    assert out.select("decoded.*").dtypes == [("id", "bigint"), ("tags", "map<string,bigint>"), ("price", "decimal(18,2)")]
    got = [(x.n, x.decoded and x.decoded.asDict(), x.status, x.schema_id, x.decoded_by) for x in out.orderBy("n").collect()]
    assert got == [(0, {"id": 1, "tags": {"a": 2}, "price": None}, "ok", 1, "keep"),
                   (1, {"id": 2 ** 40, "tags": {"none": 1}, "price": None}, "ok", 2, "keep"),
                   (2, None, "bad_magic", 1, "keep"), (3, None, "short", None, "keep"),
                   (4, None, "unknown_schema", 9, "keep"), (5, None, "bad_body", 1, "keep")]
    with pytest.raises(SchemaError):
        avro.decode_registry(df, r, {1: rec(field("x", "int"))})
    assert avro.decode_registry(df.limit(0), r, {1: w1}).count() == 0


def test_many_values_are_decoded_a_slice_at_a_time(spark):
    w = rec(field("id", "int"))
    write, n = encoder(Schema(w).root), 2 * avro.DECODED + 3
    df = spark.createDataFrame([(i, avro.framed(1, write({"id": i})) if i % 7 else None) for i in range(n)],
                               "n int, value binary").coalesce(1)
    got = [tuple(r) for r in avro.decode_registry(df, w, {1: w}).select("n", "decoded.id", "status").collect()]
    assert got == [(i, i, "ok") if i % 7 else (i, None, "short") for i in range(n)]
