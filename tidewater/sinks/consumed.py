"""The consumed offsets of a job, per epoch and compacted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import dedup
from tidewater.sinks.tables import exists, list_dirs, write_epoch


class ConsumedOffsets:
    """Runs of consumed offsets under ``path``: a folder per epoch, and a snapshot of all of them
    every ``compact_every`` epochs, sorted by bin, so that a batch reads the row groups of its bins."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 64):
        self.spark, self.path, self.compact_every = spark, path, compact_every

    def before(self, epoch: int) -> DataFrame | None:
        """The runs of the epochs below ``epoch`` (None: there are none)."""
        snaps = [int(d.split("=", 1)[1]) for d in list_dirs(self.spark, f"{self.path}/snapshot")
                 if d.startswith("upto=")]
        upto = max((s for s in snaps if s < epoch), default=-1)
        folders = [f"{self.path}/epoch={e}" for e in range(upto + 1, epoch)]
        folders = [f for f in folders if exists(self.spark, f)]
        if upto >= 0:
            folders.append(f"{self.path}/snapshot/upto={upto}")
        return self.spark.read.schema(dedup.RUNS).parquet(*folders) if folders else None

    def unseen(self, records: DataFrame, epoch: int) -> DataFrame:
        """The batch without what earlier epochs have consumed, and without its own repeats."""
        consumed = self.before(epoch)
        if consumed is None:
            return records.dropDuplicates(dedup.PLACE)
        bins = dedup.touched(records)
        if bins is None:
            return records
        return dedup.unseen(records, consumed.where(F.col("bin").between(*bins)))   # pushed to the files

    def write(self, records: DataFrame, epoch: int) -> None:
        """Add the epoch's offsets (replaces the epoch on replay)."""
        write_epoch(dedup.consumed_runs(records), self.path, epoch)
        if (epoch + 1) % self.compact_every == 0:
            every = dedup.merged_runs(self.before(epoch + 1))
            every.repartitionByRange("topic", "partition", "bin").sortWithinPartitions("topic", "partition", "bin") \
                .write.mode("overwrite").parquet(f"{self.path}/snapshot/upto={epoch}")
