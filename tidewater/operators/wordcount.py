"""Word count with a deny list and a dropped-word total.

Counts are per batch (``reduceByKey`` within one micro-batch), not running.
The dropped-word total adds each denied word's *count* and runs over batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.text import fill, split_lines, split_words
from tidewater.operators.joins import join_small

# The default deny list and the two report line formats.
DEFAULT_DENY = ("a", "b", "c")
DROPPED_LINE = "Dropped {total} word(s) totally"
COUNTS_HEADER = "Counts at time {batch} ["
COUNTS_PAIR = "({word},{count})"
COUNTS_END = "]"
# Sections of a report, in order.
HEADER, PAIR, END, COUNTER = range(4)


def deny_table(spark: SparkSession, words: Sequence[str] = DEFAULT_DENY) -> DataFrame:
    """Deny list as a one-column DataFrame (``word``) of ``len(words)`` rows.

    Built as an inline ``VALUES`` relation with bound parameters: Catalyst
    knows its exact size (a local relation), so the broadcast size check has a
    proven bound, and no word is ever spliced into SQL text.
    """
    uniq = list(dict.fromkeys(words))
    if not uniq:
        return spark.sql("SELECT CAST(NULL AS STRING) AS word WHERE false")
    rows = ", ".join(f"(:w{i})" for i in range(len(uniq)))
    return spark.sql(f"SELECT word FROM VALUES {rows} AS t(word)",
                     args={f"w{i}": w for i, w in enumerate(uniq)})


def lines(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per line of ``text`` (T1); ``keep`` columns are carried along."""
    return df.select(*keep, F.explode(split_lines(text)).alias("line"))


def words(df: DataFrame, line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word of ``line``."""
    return df.select(*keep, F.explode(split_words(line)).alias("word"))


def text_words(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Lines then words of a text column in one projection (T1 + T2)."""
    ls = F.explode(split_lines(text)).alias("line")
    return (df.select(*keep, ls)
              .select(*keep, F.explode(split_words("line")).alias("word")))


def count_words(w: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., word, cnt)``: count per word (A1). Partial + final aggregate."""
    return w.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("cnt"))


def drop_denied(counts: DataFrame, deny: DataFrame) -> DataFrame:
    """Rows (words or counts) whose word is not on the deny list (J1 / T4: exact,
    case-sensitive)."""
    return join_small(counts, deny, on="word", how="left_anti")


def keep_denied(counts: DataFrame, deny: DataFrame) -> DataFrame:
    """Rows (words or counts) whose word is on the deny list (the dropped ones)."""
    return join_small(counts, deny, on="word", how="left_semi")


def word_counts(text_df: DataFrame, deny: DataFrame, text: str = "text",
                by: Sequence[str] = ()) -> DataFrame:
    """Full word count: T1 -> T2 -> A1 -> J1 (denied words removed)."""
    return drop_denied(count_words(text_words(text_df, text, keep=by), by), deny)


def dropped_per_batch(words_df: DataFrame, deny: DataFrame, batch: str = "batch_id") -> DataFrame:
    """``(batch, dropped)``: how many words of each batch are on the deny list
    (A2: the sum of the denied words' counts). Batches without a denied word
    get 0, as the counter stays unchanged.

    One pass over the words: a broadcast flag join, then one partial + final
    aggregate by batch (the shuffle carries one row per batch and map task).
    """
    flag = deny.select("word", F.lit(1).alias("_denied"))
    flagged = join_small(words_df.select(batch, "word"), flag, on="word", how="left")
    return flagged.groupBy(batch).agg(
        F.coalesce(F.sum("_denied"), F.lit(0)).cast("long").alias("dropped"))


def running_dropped(per_batch: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Adds ``dropped_total``: the counter after each batch (running sum).

    The input has one row per batch, so the window is over the number of
    batches, never over words.
    """
    w = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.withColumn("dropped_total", F.sum("dropped").over(w).cast("long"))


def dropped_report(total: Column | str) -> Column:
    """The counter's console line: ``Dropped <n> word(s) totally``."""
    t = F.col(total) if isinstance(total, str) else total
    return fill(DROPPED_LINE, total=t.cast("string"))


def report_lines(counts: DataFrame, batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    """the complete report of each batch, a line per row: ``(batch, section, word, line)``.

    ``Counts at time <batch> [``, one line for each kept word and its count, ``]``. Every pair
    of ``counts`` has a line, however many there are; in order of batch, section and word
    the lines read as the report. No row grows with the batch.
    """
    pair = fill(COUNTS_PAIR, word=F.col("word"), count=F.col("cnt").cast("string"))
    pairs = counts.select(batch, F.lit(PAIR).alias("section"), "word", pair.alias("line"))
    frame = batches.select(batch, F.explode(F.array(
        F.struct(F.lit(HEADER).alias("section"),
                 fill(COUNTS_HEADER, batch=F.col(batch).cast("string")).alias("line")),
        F.struct(F.lit(END).alias("section"), F.lit(COUNTS_END).alias("line")))).alias("f"))
    frame = frame.select(batch, "f.section", F.lit(None).cast("string").alias("word"), "f.line")
    return frame.unionByName(pairs)
