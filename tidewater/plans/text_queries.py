"""Registered word-count queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.cells import snake_column
from tidewater.operators import wordcount as wc
from tidewater.sources.tables import read_table


def wordcount_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 1: ``(word, cnt)`` over every line of every document."""
    docs = read_table(spark, sf_dir, "documents", ["text"])
    return wc.word_counts(docs, wc.deny_table(spark))


def dropped_words_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 2: one row, the denied words' total count over all documents."""
    docs = read_table(spark, sf_dir, "documents", ["text"])
    denied = wc.keep_denied(wc.text_words(docs), wc.deny_table(spark))
    total = denied.agg(F.count(F.lit(1)).cast("long").alias("dropped"))
    return total.select("dropped", wc.dropped_report("dropped").alias("report"))


def _conversation_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations", ["turn", "text"])
    return wc.text_words(conv.withColumnRenamed("turn", "batch_id"), keep=["batch_id"])


def _conversation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wc.count_words(_conversation_words(spark, sf_dir), by=["batch_id"])


def wordcount_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 3: ``(batch_id, word, cnt)``; a batch is one conversation turn."""
    return wc.drop_denied(_conversation_counts(spark, sf_dir), wc.deny_table(spark))


def dropped_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 4: per batch the dropped count, the running total and its line."""
    per_batch = wc.dropped_per_batch(_conversation_words(spark, sf_dir), wc.deny_table(spark))
    return (wc.running_dropped(per_batch)
              .withColumn("report", wc.dropped_report("dropped_total")))


def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete report of every batch as lines (F6): all kept words with their counts, then
    the counter."""
    kept = wc.drop_denied(_conversation_counts(spark, sf_dir), wc.deny_table(spark))
    totals = dropped_running_total(spark, sf_dir)
    counter = totals.select("batch_id", F.lit(wc.COUNTER).alias("section"),
                            F.lit(None).cast("string").alias("word"), F.col("report").alias("line"))
    return wc.report_lines(kept, totals).unionByName(counter)


def camel_to_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 5: database column name of every customer name (F2)."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return cust.select("c_custkey", "c_name", snake_column("c_name").alias("column_name"))


QUERIES = {
    "wordcount_documents": wordcount_documents,
    "dropped_words_total": dropped_words_total,
    "wordcount_per_batch": wordcount_per_batch,
    "dropped_running_total": dropped_running_total,
    "batch_report": batch_report,
    "camel_to_snake": camel_to_snake,
}
