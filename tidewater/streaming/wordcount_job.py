"""Recoverable streaming word count.

Text arrives as rows with a ``text`` column (socket, Kafka value or files).
Each micro-batch is counted on its own (not a running count), denied words are
dropped and their counts added to a running dropped-word total. Outputs, all
partitioned by epoch and idempotent on replay:

* ``word_counts``: epoch, batch, word, cnt
* ``dropped``: epoch, batch, dropped
* ``totals``: epoch, total: the dropped-word counter after the epoch
* ``progress``: topic, partition, from_offset, until_offset, records (for streams that carry
  Kafka positions), so that a later job can resume from this one
* ``report``: text, per epoch the complete report of each batch, one line for every kept word,
  and ``Dropped <total> word(s) totally`` (the appended report file of K3). The lines are
  written in order by as many tasks as they need.

``batch`` is the epoch itself unless ``batch_column`` names a column carried
by the data (then an epoch may hold several data batches and a data batch may
span epochs; counts are additive, readers sum them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators import wordcount as wc
from tidewater.operators.joins import join_small
from tidewater.operators.offsets import batch_ranges
from tidewater.sinks.tables import read_epoch, read_table, read_text_table, write_epoch
from tidewater.streaming.runner import output_generation, run_available, start

DROPPED_SCHEMA = "batch long, dropped long, epoch long"
TOTALS_SCHEMA = "total long"
COUNTS_SCHEMA = "batch long, word string, cnt long, epoch long"


class WordCountJob:
    def __init__(self, spark: SparkSession, job_dir: str,
                 deny_words: Sequence[str] = wc.DEFAULT_DENY,
                 batch_column: str | None = None, echo: bool = False):
        self.spark = spark
        self.echo = echo
        self.checkpoint = f"{job_dir}/checkpoint"
        self.out = output_generation(spark, self.checkpoint, f"{job_dir}/out")
        self.deny_words = tuple(deny_words)
        self.batch_column = batch_column

    # -- one micro-batch ----------------------------------------------------
    def process_batch(self, df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        batch = (F.col(self.batch_column) if self.batch_column else F.lit(epoch)).cast("long")
        # A batch of few files is read by few tasks: its texts are dealt over all cores before they are split.
        texts = df.select(batch.alias("batch"), "text").repartition(spark.sparkContext.defaultParallelism)
        words = wc.text_words(texts, keep=["batch"])
        counts = wc.count_words(words, by=["batch"])
        deny = wc.deny_table(spark, self.deny_words).withColumn("denied", F.lit(True))
        flagged = join_small(counts, deny, on="word", how="left").persist()
        try:
            write_epoch(flagged.where(F.col("denied").isNull()).select("batch", "word", "cnt"),
                        f"{self.out}/word_counts", epoch)
            dropped = (flagged.groupBy("batch").agg(
                F.sum(F.when(F.col("denied"), F.col("cnt")).otherwise(F.lit(0)))
                 .cast("long").alias("dropped")))
            write_epoch(dropped, f"{self.out}/dropped", epoch)
            kept = flagged.where(F.col("denied").isNull()).select("batch", "word", "cnt")
            # The counter: what stood after the epoch before, and this one's.
            before = read_epoch(spark, f"{self.out}/totals", epoch - 1, TOTALS_SCHEMA)
            total = (dropped.select("dropped").unionByName(
                         before.select(F.col("total").alias("dropped")))
                     .agg(F.coalesce(F.sum("dropped"), F.lit(0)).cast("long").alias("total")))
            write_epoch(total, f"{self.out}/totals", epoch)
            total = read_epoch(spark, f"{self.out}/totals", epoch, TOTALS_SCHEMA)
            batches = read_epoch(spark, f"{self.out}/dropped", epoch, DROPPED_SCHEMA)
            # K3: the batches' complete reports, then the counter line.
            last = F.lit(None).cast("long").alias("batch")
            counter = total.select(last, F.lit(wc.COUNTER).alias("section"),
                                   F.lit(None).cast("string").alias("word"),
                                   wc.dropped_report("total").alias("line"))
            lines = (wc.report_lines(kept, batches, "batch").unionByName(counter)
                     .orderBy(F.col("batch").asc_nulls_last(), "section", "word"))
            write_epoch(lines.select(F.col("line").alias("value")), f"{self.out}/report", epoch,
                        fmt="text")
            if {"topic", "partition", "offset"} <= set(df.columns):
                write_epoch(batch_ranges(df), f"{self.out}/progress", epoch)
            if self.echo:   # K4: the same lines, one partition at a time
                for r in lines.toLocalIterator():
                    print(r.line, flush=True)
        finally:
            flagged.unpersist()

    # -- driving ------------------------------------------------------------
    def start(self, stream: DataFrame, trigger: dict | None = None):
        return start(stream, self.process_batch, self.checkpoint, trigger)

    def run_available(self, stream: DataFrame) -> None:
        run_available(stream, self.process_batch, self.checkpoint)

    # -- results ------------------------------------------------------------
    def counts(self) -> DataFrame:
        """``(batch_id, word, cnt)`` summed over epochs."""
        c = read_table(self.spark, f"{self.out}/word_counts", COUNTS_SCHEMA)
        return c.groupBy(F.col("batch").alias("batch_id"), "word").agg(
            F.sum("cnt").cast("long").alias("cnt"))

    def dropped_totals(self) -> DataFrame:
        """``(batch_id, dropped, dropped_total)``; one row per batch."""
        d = read_table(self.spark, f"{self.out}/dropped", DROPPED_SCHEMA)
        per = d.groupBy(F.col("batch").alias("batch_id")).agg(
            F.sum("dropped").cast("long").alias("dropped"))
        w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return per.withColumn("dropped_total", F.sum("dropped").over(w).cast("long"))

    def report(self) -> DataFrame:
        """``line, epoch``: the report file's lines."""
        return read_text_table(self.spark, f"{self.out}/report").withColumnRenamed("value", "line")


def text_stream(spark: SparkSession, path: str, schema: str = "value string",
                fmt: str = "text", max_files_per_trigger: int | None = None) -> DataFrame:
    """File twin of the socket source (S6, S9): new files in ``path`` become
    micro-batches; ``text`` format yields one row per line in ``value``."""
    r = spark.readStream
    if fmt != "text":
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.format(fmt).load(path)
    return df.withColumnRenamed("value", "text") if fmt == "text" else df


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket (for users; not used in
    tests, which open no ports)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load().withColumnRenamed("value", "text"))
