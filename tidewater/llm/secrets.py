"""Secret scans with multipart credential linking.

Strong finds stand alone: secret assignments, access identifiers and long hex
runs. Weak candidates (other identifiers, key-like strings without a keyword,
endpoints) say little alone; each identifier opens a scope, the text around it
inside its paragraph, and an interval join of the scopes with the other parts of
the same text reports a weak candidate only where its complement is in the scope:

* ``ident`` (client or user id assignment): a secret is in its scope;
* ``weak`` (key-like string): it lies in the scope of an identifier;
* ``endpoint`` (URL or address): it lies in a scope that also holds a secret.

Identifiers are ``access`` and ``ident``; secrets are ``assign``, ``hex``, ``weak``.
A part is in a scope if it overlaps it, so that a long secret which starts beside
the identifier counts wherever it ends. The join key is (row, bin of the position),
so that a very long text is spread over many keys; a scope has a fixed width, and
a part is in the bins in which it and a scope can meet, each pair in one of them.

Positions are code points, ends exclusive. Edge cases: a null or empty text has no
spans; repeated rows are scanned one by one; null ids are kept; texts without
finds return a row with zero counts; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import narrow, written

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")

IDENT = re.compile(r"""(?ai:access_?key_?id|client_?id|account_?id|user_?name|user|login)"""
                   r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}""")
KEYLIKE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""(?a:\b[a-z][a-z0-9+]{1,20}://[^\s"'<>]+"""
                      r"""|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{1,5})?\b)""")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Bits per character from which on a string is key-like.
ENTROPY = 3.0
#: Code points to either side of an identifier that belong to its scope.
REACH = 300


def _entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The strong finds, leftmost and without overlaps within each kind."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS) or not text.isascii():
            out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                    if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LEAST]
    # Runs of hex characters are maximal, so the least length can be in the pattern.
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def free_of(spans: list[tuple[str, int, int]]):
    """Whether (start, end) meets none of the spans: a look-up in their union."""
    starts, ends = [], []
    for s, e in sorted((s, e) for _, s, e in spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)

    def free(s: int, e: int) -> bool:
        at = bisect.bisect_left(starts, e) - 1
        return at < 0 or ends[at] <= s
    return free


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates outside the strong finds; none without an identifier to link to."""
    free = free_of(base)
    idents = [("ident", m.start(), m.end()) for m in IDENT.finditer(text)
              if free(m.start(), m.end())] if "=" in text or ":" in text else []
    if not idents and not any(k == "access" for k, _, _ in base):
        return []
    free = free_of(base + idents)
    ends = [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)
            if free(m.start(), m.end())]
    free = free_of(base + idents + ends)
    keys = [("weak", m.start(), m.end()) for m in KEYLIKE.finditer(text)
            if free(m.start(), m.end()) and re.search(r"\d", m[0]) and re.search("[A-Za-z]", m[0])
            and _entropy(m[0]) >= ENTROPY]
    return idents + keys + ends


def scopes(text: str, spans: list[tuple[str, int, int]], reach: int) -> list[tuple[int, int, int]]:
    """(identifier's start, scope start, scope end) of each identifier."""
    found = sorted((s, e) for k, s, e in spans if k in ("access", "ident"))
    if not found:
        return []
    cuts = [0, *(m.start() for m in PARAGRAPH.finditer(text)), len(text)]
    out, at = [], 0
    for s, e in found:
        while at + 2 < len(cuts) and cuts[at + 1] <= s:
            at += 1
        out.append((s, max(s - reach, cuts[at]), min(e + reach, max(cuts[at + 1], e))))
    return out


_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                  T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))
_SCOPE = T.ArrayType(T.StructType([T.StructField("at", T.LongType()),
                                   T.StructField("lo", T.LongType()),
                                   T.StructField("hi", T.LongType())]))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per row of (doc_id, text): doc_id, base spans, weak candidates and scopes."""
    out = T.StructType([docs.schema["doc_id"], T.StructField("base", _SPAN),
                        T.StructField("weak", _SPAN), T.StructField("scopes", _SCOPE)])

    def one(text: str | None) -> tuple[list, list, list]:
        text = text or ""
        base = base_spans(text)
        weak = weak_spans(text, base)
        return base, weak, scopes(text, base + weak, reach) if weak else []

    def as_dicts(rows: list[tuple], names: tuple[str, ...]) -> list[dict]:
        return [dict(zip(names, r)) for r in rows]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [one(t) for t in b["text"]]
            names = ("kind", "start", "end")
            yield pd.DataFrame({"doc_id": b["doc_id"],
                                "base": [as_dicts(g[0], names) for g in got],
                                "weak": [as_dicts(g[1], names) for g in got],
                                "scopes": [as_dicts(g[2], ("at", "lo", "hi")) for g in got]})

    return docs.mapInPandas(run, out)


def linked(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of the weak candidates whose complement is in scope.

    scanned: (row, base, weak, scopes), ``row`` unique.
    """
    width = 4 * reach
    some = scanned.where(F.size("scopes") > 0)
    scope = some.select("row", F.explode("scopes").alias("s")).select("row", "s.*")
    scope = scope.select("*", F.explode(F.sequence(F.floor(F.col("lo") / width),
                                                   F.floor(F.col("hi") / width))).alias("bin"))
    parts = some.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*")
    parts = parts.select("*", F.explode(F.sequence(F.floor(F.col("start") / width),
                                                   F.floor((F.col("end") - 1) / width))).alias("bin"))
    # A pair that shares several bins comes out of the first one.
    pairs = scope.join(parts, ["row", "bin"]).where(
        (F.col("start") < F.col("hi")) & (F.col("end") > F.col("lo"))
        & (F.col("bin") == F.floor(F.greatest("start", "lo") / width)))
    secret = F.col("kind").isin("assign", "hex", "weak")
    # Whether a scope holds a secret; the scope of an identifier reports the identifier.
    full = pairs.groupBy("row", "at").agg(F.max(secret.cast("int")).alias("full"))
    hits = pairs.join(full.where("full = 1"), ["row", "at"])
    weak = hits.where(F.col("kind").isin("weak", "endpoint")
                      | ((F.col("kind") == "ident") & (F.col("start") == F.col("at"))))
    return weak.select("row", "kind", "start", "end").distinct()


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 reach: int = REACH) -> DataFrame:
    """Per row of ``docs``: doc_id, base (array of spans), spans (base and linked ones).

    Both are ordered by start, then by kind as in ``KINDS``.
    """
    rows = narrow(docs, id_col, text_col)
    scanned = written(scan(rows, reach).withColumn("row", F.monotonically_increasing_id()),
                      "secret-scan")
    more = linked(scanned, reach).groupBy(F.col("row").alias("r")).agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    every = scanned.join(more, scanned["row"] == more["r"], "left")
    rank = F.array(*[F.lit(k) for k in KINDS])

    def ordered(spans):
        keyed = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"),
            s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed),
                           lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                              s["end"].alias("end")))

    return every.select("doc_id", ordered(F.col("base")).alias("base"),
                        ordered(F.concat("base", F.coalesce("more", F.array().cast(_SPAN))))
                        .alias("spans"))


def span_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of ``secret_spans``."""
    def written_out(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(written_out(F.col("base")), 256).alias("base_sha256"),
        written_out(F.col("spans")).alias("spans"))
