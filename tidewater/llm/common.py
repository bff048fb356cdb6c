"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import fresh_dir

# The white space and the word pattern of the query contracts.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch location and read it back.

    Cuts the lineage: a lost executor costs at most the stage that is running.
    """
    spark = df.sparkSession
    path = f"{fresh_dir(spark, name)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *columns: str, gathered: bool = False) -> DataFrame:
    """As ``written``, dealt by these columns: joins on them do not move this table again.

    Rows are shuffled first, so that a bucket is one file, unless they come ``gathered``: each
    task holds all rows of its values.
    """
    spark = df.sparkSession
    if not gathered:
        df = df.repartition(shared_partitions(spark), *columns)
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    df.write.bucketBy(shared_partitions(spark), *columns).option("compression", "zstd") \
        .option("path", f"{fresh_dir(spark, name)}/rows").saveAsTable(table)
    out = spark.table(table)
    out.schema                      # resolved: the name is not needed any more
    spark.sql(f"DROP TABLE {table}")
    return out


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and text columns, as ``doc_id`` and ``text``; other columns cannot clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and ``rest``, a struct of all columns but the text."""
    rest = [docs[c].alias(c) for c in docs.columns if c != text_col]
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       F.struct(*rest).alias("rest"))


def unpacked(rows: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """The columns again, from ``text`` and ``rest``."""
    return rows.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.{c}").alias(c)
                         for c in columns])


def only_where(df: DataFrame, cond: Column) -> DataFrame:
    """The rows for which ``cond`` holds, left out by an empty explode.

    A filter on computed columns is pushed below the projections that compute them and repeats
    their work, many times over where they build on each other.
    """
    one = F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return df.select("*", F.explode(one).alias("_one")).drop("_one")


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters; empty for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACE_RUN))


def shared_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
