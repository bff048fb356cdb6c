"""Epoch-keyed tables on a Hadoop-compatible file system.

Every output of a micro-batch is written as the folder ``epoch=<id>`` in
overwrite mode, so re-running an epoch after a failure replaces exactly its
own rows (idempotent, K3 / R6). Readers of state only look at
earlier epochs, so a half-written current epoch is never read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def write_epoch(df: DataFrame, path: str, epoch: int, column: str = "epoch",
                fmt: str = "parquet") -> None:
    """Write ``df`` as the folder ``path/column=epoch``, replacing only it.

    The folder is written directly (not by dynamic partition overwrite of
    ``path``), so a plan of the same micro-batch that reads earlier epochs of
    ``path`` is never refreshed or invalidated by this write.
    """
    df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{column}={int(epoch)}")


#: Bytes that a task of ``overwritten`` gathers before it writes them out.
WORK_ROW_GROUP = 16 << 20


def overwritten(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the working folder ``path``, in place of what it held, and read it back.
    ``df`` must not read the folder itself; what was read from it before is gone."""
    df.write.mode("overwrite").option("parquet.block.size", str(WORK_ROW_GROUP)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All epochs of a table (``schema`` includes ``epoch``); empty if absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_epoch(spark: SparkSession, path: str, epoch: int, schema: str) -> DataFrame:
    """One epoch's rows, from its own folder: the cost does not grow with the number of
    epochs. ``schema`` may include ``epoch``; empty if the folder is absent."""
    from pyspark.sql import functions as F

    fields = [f for f in spark.createDataFrame([], schema).schema.fields if f.name != "epoch"]
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    folder = f"{path.rstrip('/')}/epoch={int(epoch)}"
    df = (spark.read.schema(plain).parquet(folder) if epoch >= 0 and exists(spark, folder)
          else spark.createDataFrame([], plain))
    return df.withColumn("epoch", F.lit(int(epoch)).cast("long"))


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of all epochs: ``value, epoch``; empty if absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], "value string, epoch long")
    return spark.read.format("text").load(path).withColumn("epoch", col_long("epoch"))


def col_long(name: str):
    from pyspark.sql import functions as F

    return F.col(name).cast("long")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared scratch root and read it
    back: several consumers then scan this (column-pruned) table instead of
    recomputing the lineage, and the lineage is cut (a lost executor reruns
    from the table, not from the sources)."""
    from tidewater.session import fresh_dir

    path = fresh_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
