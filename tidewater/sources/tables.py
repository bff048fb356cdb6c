"""Parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; project ``columns`` right at the scan.

    The projection is what Catalyst prunes to anyway; stating it keeps the
    ``ReadSchema`` of every plan explicit.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
