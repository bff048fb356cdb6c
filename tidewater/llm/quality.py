"""Quality rules: base rules and a hashed n-gram log-likelihood ratio.

Two multinomials over ``buckets`` hashed word unigrams and bigrams are counted
over the whole input: one over the trusted documents, one over all documents.
A document's verdict is the mean log ratio of its n-grams under the two,
compared with a fixed threshold. Everything is DataFrame and SQL functions; the
only state that passes through the driver and travels to every task is the
table of ``buckets`` integer weights, whose size does not depend on the input.

Edge cases: a null or blank text has no words (all counts 0, ``base_failed``
true, score null, not kept); repeated rows are judged row by row and counted as
often as they appear; a document trusted by several label rows counts once;
null ids are judged but never trusted; an empty table gives an empty result;
without any trusted document the ratio is defined as 0 everywhere, so that
only the base rules reject. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import narrow, only_where, packed, unpacked, words, written

BUCKETS = 1 << 17
SMOOTHING = 1.0
#: Weights are kept as integers of this fraction, so sums do not depend on the order.
SCALE = 1_000_000
#: Mean log ratio per n-gram from which on a document is kept.
THRESHOLD = -0.55
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30


def _shift(a: Column, by: int) -> Column:
    return F.slice(a, F.lit(by + 1), F.greatest(F.size(a), F.lit(0)))


def _pairs(a: Column, by: int) -> Column:
    """Hash of the elements at i and i + by, for each i; the last ``by`` lack a partner."""
    return F.zip_with(a, _shift(a, by), lambda x, y: F.xxhash64(x, y))


def _hashed(docs: DataFrame, *keep: Column) -> DataFrame:
    """``h1``: a hash per word; ``h2``: per word and its successor (the last one has none)."""
    split = docs.withColumn("words", words(F.col("text")))
    one = split.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    return one.withColumn("h2", _pairs(F.col("h1"), 1))


def _features(h1: Column, h2: Column) -> Column:
    return F.concat(h1, F.slice(h2, F.lit(1), F.greatest(F.size(h2) - 1, F.lit(0))))


def ngram_weights(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS,
                  smoothing: float = SMOOTHING) -> DataFrame:
    """One row: array ``w`` of the scaled log ratio of each bucket.

    docs: (doc_id, text); trusted_ids: (doc_id). All documents are counted.
    """
    trusted = trusted_ids.where("doc_id is not null").select("doc_id").distinct() \
        .withColumn("trusted", F.lit(1))
    # Labels grow with the documents: never broadcast.
    marked = docs.join(trusted.hint("merge"), "doc_id", "left")
    grams = _hashed(marked).select(
        F.coalesce("trusted", F.lit(0)).alias("trusted"),
        F.explode(_features(F.col("h1"), F.col("h2"))).alias("h"))
    counts = grams.groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(
        F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    counts = written(counts, "ngram-counts")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("n_raw"),
                       F.coalesce(F.sum("target"), F.lit(0)).alias("n_target"))
    spark = docs.sparkSession
    table = spark.range(buckets).withColumnRenamed("id", "b").join(counts, "b", "left") \
        .join(F.broadcast(total), F.lit(True))
    ratio = (F.log((F.coalesce("target", F.lit(0)) + smoothing)
                   / (F.col("n_target") + smoothing * buckets))
             - F.log((F.coalesce("raw", F.lit(0)) + smoothing)
                     / (F.col("n_raw") + smoothing * buckets)))
    scaled = F.when(F.col("n_target") == 0, F.lit(0)).otherwise(
        F.round(ratio * SCALE)).cast("int")
    rows = table.select("b", scaled.alias("v"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "v"))),
                                lambda s: s["v"]).alias("w"))


def _repeat_words(win: Column) -> Column:
    """Words inside windows whose hash occurs twice or more in ``win``."""
    ranked = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # One pass over the sorted windows: a window repeats if a neighbour has its hash.
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(ranked, lambda s: s["h"]))
    after = F.transform(_shift(ranked, 1), lambda s: s["h"])
    marked = F.zip_with(F.arrays_zip(ranked.alias("s"), before.alias("p")), after,
                        lambda sp, n: F.when((sp["s"]["h"] == sp["p"]) | (sp["s"]["h"] == n),
                                             sp["s"]["i"]))
    starts = F.array_sort(F.array_compact(marked))
    return F.aggregate(F.zip_with(starts, _shift(starts, 1),
                                  lambda a, b: F.least(F.lit(WINDOW), b - a)),
                       F.lit(0).cast("bigint"), lambda s, x: s + x)


def _judged(rows: DataFrame, labels: DataFrame, carry: list[str], buckets: int, smoothing: float,
            threshold: float) -> DataFrame:
    """The counts, the score and the verdict of (doc_id, text, *carry)."""
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    weights = ngram_weights(rows.select("doc_id", "text"), trusted, buckets, smoothing).first()["w"]
    # A constant array; Spark folds the cast once and ships the result with the plan.
    w = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")

    hashed = _hashed(rows)
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"),
                     lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = hashed.select(
        "doc_id", *carry, F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOLS)).cast("bigint")
         .alias("n_symbols"),
        lines.alias("lines"), "h1", "h2", _pairs(F.col("h2"), 2).alias("h4"))
    wins = base.withColumn("h8", F.slice(_pairs(F.col("h4"), 4), F.lit(1),
                                         F.greatest(F.size("h4") - (WINDOW - 1), F.lit(0))))
    feats = _features(F.col("h1"), F.col("h2"))
    llr = F.aggregate(feats, F.lit(0).cast("bigint"),
                      lambda s, h: s + F.get(w, F.pmod(h, F.lit(buckets)).cast("int")))
    out = wins.select(
        "doc_id", *carry, "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("h8")) < F.size("h8"), _repeat_words(F.col("h8")))
         .otherwise(F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.when(F.col("n_words") > 0,
               F.round(llr / F.lit(float(SCALE)) / (2 * F.col("n_words") - 1), 9)).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: the base counts, the mean log ratio ``score`` and ``kept``.

    labels: (doc_id, quality, toxic); documents with quality 1 and toxic 0 are trusted.
    """
    return _judged(narrow(docs, id_col, text_col), labels, [], buckets, smoothing, threshold)


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING,
                   threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rows = packed(docs, id_col, text_col).withColumn("body", F.col("text"))
    judged = _judged(rows, labels, ["body", "rest"], buckets, smoothing, threshold)
    good = only_where(judged, F.col("kept")).select(F.col("body").alias("text"), "rest")
    return unpacked(good, docs.columns, text_col)
