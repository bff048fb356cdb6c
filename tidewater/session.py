"""Session construction and the shared scratch location."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every query in this package is written against. AQE re-plans joins
# and coalesces shuffle partitions at runtime; skew join splits a hot key's
# partition on the big side of a sort-merge join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Size estimates of file scans are the compressed file size; columnar
    # parquet commonly inflates 3-5x in memory. Estimating conservatively keeps
    # every broadcast decision (ours and Spark's threshold) on the safe side.
    "spark.sql.sources.fileCompressionFactor": "4",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Side effects (database writes) must not run twice because of a
    # speculative copy of a task.
    "spark.speculation": "false",
}


def get_session(master: str | None = None, app: str = "tidewater",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               bytes_per_shuffle_partition: int = 1 << 30) -> dict[str, str]:
    """Settings sized to the input so that partitions fit in executor memory.

    * shuffle partitions: about one per GiB of input (the shuffled volume is at
      most the input for these operators, usually far less after partial
      aggregation), at least two per core so every core has work; AQE then
      coalesces small ones and splits skewed ones;
    * split size 256 MiB for large inputs (fewer, fuller scan tasks), the
      default 128 MiB otherwise;
    * broadcast only sides under 64 MiB (our joins also check the estimate).
    """
    parts = max(2 * total_cores, -(-input_bytes // bytes_per_shuffle_partition))
    large = input_bytes > 64 * total_cores * (128 << 20)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str((256 if large else 128) << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20 if large else 64 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.fileCompressionFactor": "4",
    }


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (it must
    be on shared storage). Only when the session has none and its master is
    local, as in tests, a fresh local folder is created and registered; any
    other master without the setting is refused, as its executors would write
    to disks of their own.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {sc.master})")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of the scratch root (never reused, never wiped).

    Created through Hadoop's FileSystem API on the root's qualified path, so a
    scheme-less ``spark.checkpoint.dir`` resolves against the cluster's default
    file system (e.g. HDFS), not the driver's local disk.
    """
    import uuid

    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = jvm.org.apache.hadoop.fs.Path(fs.makeQualified(root), f"{name}-{uuid.uuid4().hex}")
    fs.mkdirs(path)
    return path.toString()
