"""Line dedup by winnowing: later repeats of a run of lines are deleted.

The lines with a word of a text, in order, are hashed; each run of ``gram`` lines
has a hash, and of each ``window`` successive ones the least (the last of equal
ones) is selected as a fingerprint. A run of ``gram + window - 1`` lines, the
threshold, fills one such window, so any two texts that share it select the same
fingerprint in it. Positions are joined on fingerprints that occur more than once;
around each, the windows that selected it are compared with all others of the same
fingerprint and lines, which extends the match in both directions line by line as
far as it goes. A line is deleted if it lies in a run of the threshold's length
that also starts at an earlier place: in a document before it (by id), or
earlier in the same one. Blank lines do not count; those behind a deleted line go
with it.

All DataFrame and SQL functions. No pair of occurrences is ever formed: each
window is compared with the first place of its lines only, found by an aggregate
that combines before the shuffle, so a line that a third of all texts hold costs
one row each. Hashes of windows have 128 bits.

Edge cases: a null text stays null and an empty one empty, with 0 lines; documents
with the same id are ordered by the hash of their text, a null id comes last;
fully equal rows count as one document and are cut alike; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import narrow, only_where, packed, unpacked, written

GRAM, WINDOW = 2, 2
HAS_WORD = r"[^\x20\x09-\x0D]"


def _ahead(a: Column, by: int) -> Column:
    return F.slice(a, F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0)))


def _keyed(rows: DataFrame) -> DataFrame:
    """With the place in order: last, id, th (together unique up to rows of equal text)."""
    none = F.lit("" if dict(rows.dtypes)["doc_id"] == "string" else 0)
    return rows.withColumn("last", F.col("doc_id").isNull().cast("int")) \
        .withColumn("id", F.coalesce("doc_id", none.cast(rows.schema["doc_id"].dataType))) \
        .withColumn("th", F.xxhash64("text"))


def selected(rows: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(print, wins, *rest) of (lines hashes ``a`` and ``b``, *rest): one row per fingerprint.

    ``wins``: the start and 128-bit hash of each window that selected it.
    """
    rest = [c for c in rows.columns if c not in ("a", "b")]
    g = F.col("a")
    for by in range(1, gram):
        g = F.zip_with(g, _ahead(F.col("a"), by), lambda x, y: F.xxhash64(x, y))
    whole = F.greatest(F.size("a") - (gram - 1), F.lit(0))
    grams = rows.withColumn("g", F.slice(g, F.lit(1), whole))
    # The hash of a gram and minus its place: the least of these is the last of the least.
    at = grams.withColumn("g", F.transform("g", lambda h, i: F.struct(h.alias("h"),
                                                                      (-i).alias("i"))))
    least, wa, wb = F.col("g"), F.col("a"), F.col("b")
    for by in range(1, window):
        least = F.zip_with(least, _ahead(F.col("g"), by), lambda x, y: F.least(x, y))
    for by in range(1, gram + window - 1):
        wa = F.zip_with(wa, _ahead(F.col("a"), by), lambda x, y: F.xxhash64(x, y))
        wb = F.zip_with(wb, _ahead(F.col("b"), by), lambda x, y: F.xxhash64(x, y))
    n = F.greatest(F.size("a") - (gram + window - 2), F.lit(0))
    wins = at.select(*rest, F.explode(F.slice(F.transform(
        F.arrays_zip(least.alias("m"), wa.alias("a"), wb.alias("b")),
        lambda z, i: F.struct(i.alias("s"), z["m"].alias("m"), z["a"].alias("a"),
                              z["b"].alias("b"))), F.lit(1), n)).alias("w"))
    # Windows that selected the same place of a text are neighbours in one task already.
    return wins.groupBy(*rest, F.col("w.m.h").alias("print"), F.col("w.m.i").alias("place")).agg(
        F.collect_list(F.struct("w.s", "w.a", "w.b")).alias("wins")).drop("place")


def later_windows(prints: DataFrame, place: list[str]) -> DataFrame:
    """(*place, starts) of the windows whose lines also start at an earlier place."""
    often = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    cands = prints.join(often, "print").select(*place, F.explode("wins").alias("w")) \
        .select(*place, "w.s", "w.a", "w.b")
    here = F.struct(*place, "s")
    first = cands.groupBy("a", "b").agg(F.min(here).alias("first"), F.count("*").alias("n")) \
        .where("n > 1").drop("n")
    later = cands.join(first, ["a", "b"]).where(here > F.col("first"))
    return later.groupBy(*place).agg(F.sort_array(F.collect_set("s")).alias("starts"))


def _cut(rows: DataFrame, carry: list[str], gram: int, window: int) -> DataFrame:
    """(doc_id, *carry, text, n_lines, n_removed, n_spans) of (doc_id, text, *carry)."""
    rows = _keyed(rows)
    place, t = ["last", "id", "th"], gram + window - 1
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(HAS_WORD))
    hashed = rows.select(*place, lines.alias("l")).where(F.size("l") >= t).select(
        *place, F.transform("l", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("l", lambda x: F.xxhash64(F.lit(1), x)).alias("b"))
    prints = written(selected(hashed, gram, window).dropDuplicates([*place, "print", "wins"]),
                     "line-prints")
    starts = later_windows(prints, place)
    cut = rows.join(starts, place, "left")
    whole = cut.select("doc_id", *carry, "text", "starts",
                       F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    # Places of the lines with a word, and behind them the end.
    whole = whole.withColumn("at", F.concat(F.array_compact(F.transform(
        "lines", lambda x, i: F.when(x.rlike(HAS_WORD), i))), F.array(F.size("lines"))))
    gone = F.array_distinct(F.flatten(F.transform(
        F.coalesce("starts", F.array().cast("array<int>")),
        lambda s: F.sequence(s, s + (t - 1)))))
    whole = whole.withColumn("gone", F.array_sort(gone))
    places = F.flatten(F.transform("gone", lambda j: F.sequence(
        F.get("at", j), F.get("at", j + 1) - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), places)
    text = F.when(F.size("gone") == 0, F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    runs = F.size("gone") - F.size(F.filter(
        F.zip_with("gone", F.slice("gone", F.lit(2), F.size("gone")), lambda a, b: b - a),
        lambda d: d == 1))
    return whole.select("doc_id", *carry, text.alias("text"),
                        (F.size("at") - 1).cast("bigint").alias("n_lines"),
                        F.size("gone").cast("bigint").alias("n_removed"),
                        runs.cast("bigint").alias("n_spans"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text without the deleted lines, n_lines (with a word),
    n_removed (of those), n_spans (maximal runs of removed ones)."""
    return _cut(narrow(docs, id_col, text_col), [], gram, window)


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with their texts cut; a text that loses all its lines goes."""
    cut = _cut(packed(docs, id_col, text_col), ["rest"], gram, window)
    left = only_where(cut, (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return unpacked(left, docs.columns, text_col)


def line_digests(cut: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, n_spans, kept_sha256 of ``dedup_lines``."""
    return cut.select("doc_id", "n_lines", "n_removed", "n_spans",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def oracle(gram: int = GRAM, window: int = WINDOW) -> str:
    """The same in SQL, by windows of the threshold's length alone; ids must be unique."""
    t = gram + window - 1
    nexts = ", ".join(f"lead(line, {k}) OVER o AS l{k}" for k in range(1, t))
    run = "[line, " + ", ".join(f"l{k}" for k in range(1, t)) + "]"
    return f"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM raw),
marked AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS word FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i
      FROM marked WHERE word),
w AS (SELECT doc_id, i, line, {nexts} FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, md5(array_to_string({run}, chr(10))) AS run FROM w WHERE l{t - 1} IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM r),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM f, range({t}) AS s(j) WHERE k > 1),
kept AS (SELECT m.doc_id, m.pos, m.line, m.word, g.i AS gone,
                max(CASE WHEN m.word THEN m.pos END)
                  OVER (PARTITION BY m.doc_id ORDER BY m.pos) AS owner
         FROM marked m LEFT JOIN n USING (doc_id, pos)
         LEFT JOIN gone g ON g.doc_id = m.doc_id AND g.i = n.i),
lost AS (SELECT doc_id, pos FROM kept WHERE gone IS NOT NULL),
text AS (SELECT k.doc_id, string_agg(k.line, chr(10) ORDER BY k.pos)
                  FILTER (WHERE x.pos IS NULL) AS text
         FROM kept k LEFT JOIN lost x ON x.doc_id = k.doc_id AND x.pos = k.owner
         GROUP BY k.doc_id),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE prev IS NULL OR i > prev + 1)
                  AS n_spans
         FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM gone)
         GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) FILTER (WHERE word) AS n_lines FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(text, '')) AS kept_sha256
FROM lines JOIN text USING (doc_id) LEFT JOIN runs USING (doc_id)"""
