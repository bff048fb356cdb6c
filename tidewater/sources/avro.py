"""Avro bodies, read with the schema that wrote them onto the reader's.

``decode_registry`` takes registry-framed values (magic byte, schema id, body). Each writer
schema is compiled once per task against the reader schema into nested functions that
follow Avro's rules of schema resolution: fields by name or alias, whatever their
order; fields that only the writer has are skipped, those that only the reader has take
their default; numbers are promoted, strings and bytes exchanged; unions, enums, arrays, maps
and fixed resolve part by part. A record batch is decoded as a whole and assembled as the
Arrow struct of the reader's Spark type. What cannot be decoded keeps its row, with the reason.

Spark types follow the Avro source's: a union with null is nullable; int and long make a
long, float and double a double; other unions are structs ``member0``, ``member1``, ...;
decimal, date and timestamps are read from their logical types; enums are strings.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import struct
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.sources.kafka import REGISTRY_HEADER_BYTES, REGISTRY_MAGIC

# Fixed values of the format.
PRIMITIVES = ("null", "boolean", "int", "long", "float", "double", "bytes", "string")
PROMOTIONS = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
              "string": ("bytes",), "bytes": ("string",)}
STATUSES = ("ok", "short", "bad_magic", "unknown_schema", "bad_body")

Read = Callable[[bytes, int], tuple[Any, int]]


class SchemaError(ValueError):
    """A schema that is wrong, or a writer's that cannot be resolved to the reader's."""


class Schema:
    """A parsed schema: named types are found by their full name."""

    def __init__(self, text: str):
        self.names: dict[str, dict] = {}
        self.root = self._parse(json.loads(text), "")

    def _parse(self, s: Any, space: str) -> Any:
        if isinstance(s, str):
            if s in PRIMITIVES:
                return {"type": s}
            for name in (s, f"{space}.{s}"):
                if name in self.names:
                    return self.names[name]
            raise SchemaError(f"unknown type {s!r}")
        if isinstance(s, list):
            return {"type": "union", "branches": [self._parse(b, space) for b in s]}
        kind = s["type"]
        if not isinstance(kind, str):
            return self._parse(kind, space)
        if kind in ("record", "error", "enum", "fixed"):
            name = s["name"]
            space = s.get("namespace", name.rpartition(".")[0] or space)
            full = name if "." in name or not space else f"{space}.{name}"
            out = {**s, "type": "record" if kind == "error" else kind, "full": full}
            self.names[full] = out
            if out["type"] == "record":
                out["fields"] = [{**f, "type": self._parse(f["type"], space)} for f in s["fields"]]
            return out
        if kind == "array":
            return {**s, "items": self._parse(s["items"], space)}
        if kind == "map":
            return {**s, "values": self._parse(s["values"], space)}
        return s if kind in PRIMITIVES else self._parse(kind, space)


# ---- Spark types ------------------------------------------------------------

def _members(s: dict) -> list[dict]:
    return [b for b in s["branches"] if b["type"] != "null"]


def _widened(s: dict) -> str | None:
    kinds = {b["type"] for b in _members(s)}
    return {frozenset({"int", "long"}): "long", frozenset({"float", "double"}): "double"}.get(frozenset(kinds))


def spark_type(s: dict, inside: tuple[str, ...] = ()) -> T.DataType:
    """The Spark type of a parsed schema."""
    kind, logical = s["type"], s.get("logicalType")
    if kind == "union":
        own = _members(s)
        if len(own) == 1:
            return spark_type(own[0], inside)
        if not own:
            return T.NullType()
        if _widened(s):
            return T.LongType() if _widened(s) == "long" else T.DoubleType()
        return T.StructType([T.StructField(f"member{i}", spark_type(b, inside)) for i, b in enumerate(own)])
    if kind == "record":
        if s["full"] in inside:
            raise SchemaError(f"{s['full']} holds itself: Spark has no such type")
        return T.StructType([T.StructField(f["name"], spark_type(f["type"], (*inside, s["full"])))
                             for f in s["fields"]])
    if kind == "array":
        return T.ArrayType(spark_type(s["items"], inside))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(s["values"], inside))
    if kind in ("bytes", "fixed") and logical == "decimal":
        return T.DecimalType(s["precision"], s.get("scale", 0))
    if kind == "int" and logical == "date":
        return T.DateType()
    if kind == "long" and logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    return {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(),
            "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(),
            "fixed": T.BinaryType(), "string": T.StringType(), "enum": T.StringType()}[kind]


# ---- reading ----------------------------------------------------------------

def read_long(b: bytes, at: int) -> tuple[int, int]:
    """A zigzag number of up to ten bytes."""
    value = shift = 0
    while True:
        c = b[at]
        at += 1
        value |= (c & 127) << shift
        if c < 128:
            break
        shift += 7
        if shift > 63:
            raise ValueError("number of more than ten bytes")
    if value >> 64:
        raise ValueError("number of more than 64 bits")
    return (value >> 1) ^ -(value & 1), at


def read_int(b: bytes, at: int) -> tuple[int, int]:
    value, at = read_long(b, at)
    if not -(1 << 31) <= value < 1 << 31:
        raise ValueError("number of more than 32 bits")
    return value, at


def _run(b: bytes, at: int, n: int) -> tuple[bytes, int]:
    if n < 0 or at + n > len(b):
        raise ValueError("a length beyond the body")
    return b[at:at + n], at + n


def _read_bytes(b: bytes, at: int) -> tuple[bytes, int]:
    n, at = read_long(b, at)
    return _run(b, at, n)


def _read_boolean(b: bytes, at: int) -> tuple[bool, int]:
    if b[at] > 1:
        raise ValueError("no boolean")
    return b[at] == 1, at + 1


def _read_float(code: str, size: int) -> Read:
    def read(b: bytes, at: int) -> tuple[float, int]:
        data, at = _run(b, at, size)
        return struct.unpack(code, data)[0], at
    return read


RAW: dict[str, Read] = {
    "null": lambda b, at: (None, at), "boolean": _read_boolean, "int": read_int, "long": read_long,
    "float": _read_float("<f", 4), "double": _read_float("<d", 8), "bytes": _read_bytes,
    "string": _read_bytes}


def _then(read: Read, change: Callable[[Any], Any]) -> Read:
    def both(b: bytes, at: int) -> tuple[Any, int]:
        value, at = read(b, at)
        return change(value), at
    return both


EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
DAY = dt.date(1970, 1, 1)


def _finish(reader: dict) -> Callable[[Any], Any] | None:
    """What the reader's type makes of a raw value of its own physical type (None: nothing)."""
    kind, logical = reader["type"], reader.get("logicalType")
    if kind in ("bytes", "fixed") and logical == "decimal":
        scale = reader.get("scale", 0)
        context = decimal.Context(prec=max(reader["precision"], 1))

        def number(v: bytes) -> decimal.Decimal:
            n = int.from_bytes(v, "big", signed=True)
            if abs(n) >= 10 ** reader["precision"]:
                raise ValueError("more digits than the decimal's precision")
            return decimal.Decimal(n).scaleb(-scale, context)
        return number
    if kind == "int" and logical == "date":
        return lambda v: DAY + dt.timedelta(days=v)
    if kind == "long" and logical in ("timestamp-millis", "timestamp-micros"):
        unit = 1000 if logical.endswith("millis") else 1
        return lambda v: EPOCH + dt.timedelta(microseconds=v * unit)
    if kind == "string":
        return lambda v: v.decode() if isinstance(v, bytes) else v
    return None


def _default(reader: dict, value: Any) -> Any:
    """A default of the schema's JSON as a value of the reader's type."""
    kind = reader["type"]
    if kind == "union":
        first = reader["branches"][0]
        if first["type"] == "null":
            return None
        return _member(reader, first, _default(first, value))
    if kind == "record":
        return {f["name"]: _default(f["type"], value[f["name"]] if f["name"] in value else f["default"])
                for f in reader["fields"]}
    if kind == "array":
        return [_default(reader["items"], v) for v in value]
    if kind == "map":
        return [(k, _default(reader["values"], v)) for k, v in value.items()]
    if kind in ("bytes", "fixed"):
        value = value.encode("latin-1")
    done = _finish(reader)
    return done(value) if done else value


def _member(union: dict, branch: dict, value: Any) -> Any:
    """A branch's value as a value of the union's Spark type."""
    own = _members(union)
    if len(own) <= 1 or branch["type"] == "null":
        return value
    if _widened(union):
        return float(value) if _widened(union) == "double" else value
    return {f"member{next(i for i, b in enumerate(own) if b is branch)}": value}


class Resolver:
    """Compiles one writer schema against one reader schema."""

    def __init__(self, writer: Schema, reader: Schema):
        self.skips: dict[str, list] = {}
        self.read = self.resolve(writer.root, reader.root)

    def matches(self, w: dict, r: dict, promote: bool) -> bool:
        if r["type"] == w["type"] and w["type"] in ("record", "enum", "fixed"):
            short = lambda n: n.rpartition(".")[2]
            same = short(w["full"]) in {short(r["full"]), *map(short, r.get("aliases", ()))}
            return same and (w["type"] != "fixed" or w["size"] == r["size"])
        return r["type"] == w["type"] or (promote and r["type"] in PROMOTIONS.get(w["type"], ()))

    def resolve(self, w: dict, r: dict) -> Read:
        if w["type"] == "union":
            branches = []
            for b in w["branches"]:
                try:
                    branches.append(self.resolve(b, r))
                except SchemaError as e:        # an error only where a record has this branch
                    branches.append(_raising(str(e)))
            return _branch(branches)
        if r["type"] == "union":
            for promote in (False, True):
                for b in r["branches"]:
                    if self.matches(w, b, promote):
                        return _then(self.resolve(w, b), lambda v, b=b: _member(r, b, v))
            raise SchemaError(f"no branch for {w['type']}")
        if not self.matches(w, r, True):
            raise SchemaError(f"{w['type']} cannot be read as {r['type']}")
        kind = w["type"]
        if kind == "record":
            return self.record(w, r)
        if kind == "enum":
            known, default = set(r["symbols"]), r.get("default")
            names = [s if s in known else default for s in w["symbols"]]

            def symbol(i: int) -> str:
                if not 0 <= i < len(names) or names[i] is None:
                    raise ValueError("a symbol that the reader does not know")
                return names[i]
            return _then(read_int, symbol)
        if kind == "array":
            return _blocks(self.resolve(w["items"], r["items"]))
        if kind == "map":
            value, key = self.resolve(w["values"], r["values"]), _then(_read_bytes, bytes.decode)

            def pair(b: bytes, at: int) -> tuple[Any, int]:
                k, at = key(b, at)
                v, at = value(b, at)
                return (k, v), at
            return _then(_blocks(pair), lambda pairs: list(dict(pairs).items()))
        raw = RAW[kind] if kind != "fixed" else lambda b, at, n=w["size"]: _run(b, at, n)
        if r["type"] in ("float", "double") and kind in ("int", "long"):
            return _then(raw, float)
        done = _finish(r)
        return _then(raw, done) if done else raw

    def record(self, w: dict, r: dict) -> Read:
        by_name = {f["name"]: f for f in w["fields"]}
        source: dict[str, dict] = {}
        defaults: dict[str, Any] = {}
        for f in r["fields"]:
            own = next((n for n in (f["name"], *f.get("aliases", ())) if n in by_name), None)
            if own is not None:
                source[own] = f
            elif "default" in f:
                defaults[f["name"]] = _default(f["type"], f["default"])
            else:
                raise SchemaError(f"field {f['name']!r} is not written and has no default")
        steps = [(source[f["name"]]["name"], self.resolve(f["type"], source[f["name"]]["type"]))
                 if f["name"] in source else (None, self.skip(f["type"])) for f in w["fields"]]

        def read(b: bytes, at: int) -> tuple[dict, int]:
            out = dict(defaults)
            for name, part in steps:
                value, at = part(b, at)
                if name is not None:
                    out[name] = value
            return out, at
        return read

    def skip(self, w: dict) -> Read:
        """Reads past a value that the reader does not have."""
        kind = w["type"]
        if kind == "record":
            parts = self.skips.get(w["full"])
            if parts is None:       # a record may hold itself
                parts = self.skips[w["full"]] = []
                parts += [self.skip(f["type"]) for f in w["fields"]]

            def fields(b: bytes, at: int) -> tuple[None, int]:
                for part in parts:
                    _, at = part(b, at)
                return None, at
            return fields
        if kind == "union":
            return _branch([self.skip(b) for b in w["branches"]])
        if kind == "enum":
            return read_int
        if kind == "fixed":
            return lambda b, at, n=w["size"]: _run(b, at, n)
        if kind in ("array", "map"):
            part = self.skip(w["items"] if kind == "array" else w["values"])
            item = part if kind == "array" else lambda b, at: part(b, _read_bytes(b, at)[1])
            return _blocks(item, skip=True)
        return RAW[kind]


def _raising(message: str) -> Read:
    def read(b: bytes, at: int) -> tuple[Any, int]:
        raise ValueError(message)
    return read


def _branch(branches: list[Read]) -> Read:
    def read(b: bytes, at: int) -> tuple[Any, int]:
        i, at = read_long(b, at)
        if not 0 <= i < len(branches):
            raise ValueError("no such branch")
        return branches[i](b, at)
    return read


def _blocks(item: Read, skip: bool = False) -> Read:
    """Items in blocks; a negative count is followed by the block's size in bytes."""
    def read(b: bytes, at: int) -> tuple[list, int]:
        out: list = []
        while True:
            n, at = read_long(b, at)
            if n == 0:
                return out, at
            if n < 0:
                n, (size, at) = -n, read_long(b, at)
                if skip:
                    _, at = _run(b, at, size)
                    continue
            for _ in range(n):
                value, at = item(b, at)
                if not skip:
                    out.append(value)
    return read


class Decoder:
    """Framed values of many writer schemas onto one reader schema."""

    def __init__(self, reader: str, writers: dict[int, str]):
        self.reader, self.writers = Schema(reader), writers
        self.compiled: dict[int, Read] = {}

    def body(self, schema_id: int, data: bytes) -> Any:
        read = self.compiled.get(schema_id)
        if read is None:
            read = self.compiled[schema_id] = Resolver(Schema(self.writers[schema_id]), self.reader).read
        value, at = read(data, 0)
        if at != len(data):
            raise ValueError("bytes behind the record")
        return value

    def framed(self, value: bytes | None) -> tuple[Any, str, int | None]:
        """(record, status, schema id) of one framed value."""
        if value is None or len(value) < REGISTRY_HEADER_BYTES:
            return None, "short", None
        schema_id = int.from_bytes(value[1:REGISTRY_HEADER_BYTES], "big")
        if value[0] != REGISTRY_MAGIC:
            return None, "bad_magic", schema_id
        if schema_id not in self.writers:
            return None, "unknown_schema", schema_id
        try:
            return self.body(schema_id, value[REGISTRY_HEADER_BYTES:]), "ok", schema_id
        except SchemaError:
            raise       # of the settings, not of a record
        except (ValueError, IndexError, OverflowError, decimal.DecimalException):
            return None, "bad_body", schema_id


#: So many values are objects of a Python worker at a time.
DECODED = 1024


def decode_registry(records: DataFrame, reader: str, writers: dict[int, str], value: str = "value",
                    name: str = "decoded") -> DataFrame:
    """The records with their value replaced by ``name`` (struct of the reader schema's fields,
    null unless decoded), ``status`` (one of ``STATUSES``) and ``schema_id``.

    ``writers``: the registry's schemas by id. Row order and number stay; the settings are
    checked before anything runs.
    """
    for text in writers.values():       # fails on the driver, not in every task
        Resolver(Schema(text), Schema(reader))
    struct_type = spark_type(Schema(reader).root)
    if not isinstance(struct_type, T.StructType):
        raise SchemaError("the reader schema must be a record")
    keep = [f for f in records.schema.fields if f.name != value]
    out = T.StructType([*keep, T.StructField(name, struct_type), T.StructField("status", T.StringType()),
                        T.StructField("schema_id", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        decoder, arrow = Decoder(reader, writers), to_arrow_schema(out)
        for b in (b.slice(a, DECODED) for b in batches for a in range(0, b.num_rows, DECODED)):
            got = list(map(decoder.framed, b.column(value).to_pylist()))
            parts = [b.column(f.name) for f in keep]
            parts += [pa.array([g[i] for g in got], arrow.field(c).type)
                      for i, c in enumerate((name, "status", "schema_id"))]
            yield pa.RecordBatch.from_arrays(parts, schema=arrow)

    return records.select(*[f.name for f in keep], value).mapInArrow(run, out)


# ---- writing ----------------------------------------------------------------

def write_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def encoder(s: dict) -> Callable[[Any], bytes]:
    """Writes values of a parsed schema (physical values; a union's as (branch, value))."""
    kind = s["type"]
    if kind == "record":
        parts = [(f["name"], encoder(f["type"])) for f in s["fields"]]
        return lambda v: b"".join(write(v[name]) for name, write in parts)
    if kind == "union":
        parts = [encoder(b) for b in s["branches"]]
        return lambda v: write_long(v[0]) + parts[v[0]](v[1])
    if kind == "array":
        item = encoder(s["items"])
        return lambda v: (write_long(len(v)) + b"".join(map(item, v)) if v else b"") + b"\0"
    if kind == "map":
        item, key = encoder(s["values"]), encoder({"type": "string"})
        return lambda v: (write_long(len(v)) + b"".join(key(k) + item(x) for k, x in dict(v).items())
                          if v else b"") + b"\0"
    if kind == "string":
        return lambda v: write_long(len(data := v.encode())) + data
    if kind == "bytes":
        return lambda v: write_long(len(v)) + bytes(v)
    if kind == "enum":
        return lambda v: write_long(s["symbols"].index(v))
    return {"null": lambda v: b"", "boolean": lambda v: b"\1" if v else b"\0", "int": write_long,
            "long": write_long, "float": lambda v: struct.pack("<f", v),
            "double": lambda v: struct.pack("<d", v), "fixed": bytes}[kind]


def framed(schema_id: int, body: bytes) -> bytes:
    return bytes([REGISTRY_MAGIC]) + schema_id.to_bytes(4, "big") + body
