"""A target table in versions (2.13): cells by bucket of their key, a manifest per version.

A batch writes the cells it touches as one delta folder per touched bucket; a bucket with
more than ``max_deltas`` of them is folded into one base. What a batch costs follows the
cells it touches, and each cell is rewritten once per ``max_deltas`` batches that touch its bucket.

A version is the manifest that lists, for each bucket, the folders that make it up. It is
written last: readers see a version whole or not at all, older versions stay readable, and
a replayed batch starts from the version before its own. Manifests have at most
``buckets * (max_deltas + 1)`` rows. Folders that no kept version names can go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import apply
from tidewater.sinks.tables import exists, list_dirs

MANIFEST = "bucket int, folder string, base boolean"


class VersionedTarget:
    def __init__(self, spark: SparkSession, root: str, schema: str, buckets: int = 16, max_deltas: int = 8):
        """``schema``: of the long cells, ``table_name, key, column, type, value, w``. ``buckets``: one
        task writes a bucket's part of a batch; it is fixed for the table's life."""
        self.spark, self.root, self.schema = spark, root, schema
        self.buckets, self.max_deltas = buckets, max_deltas

    def versions(self) -> list[int]:
        """The versions whose manifest is finished."""
        path = f"{self.root}/manifest"
        found = [int(d.split("=", 1)[1]) for d in list_dirs(self.spark, path) if d.startswith("v=")]
        return sorted(v for v in found if exists(self.spark, f"{path}/v={v}/_SUCCESS"))

    def manifest(self, version: int | None) -> list[tuple[int, str, bool]]:
        if version is None:
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/v={version}").collect()
        return [tuple(r) for r in rows]

    def _bucket(self):
        return F.pmod(F.xxhash64(*apply.ROW), F.lit(self.buckets)).cast("int")

    def _folders(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/{f}" for f in folders])

    def _write(self, cells: DataFrame, name: str) -> list[tuple[int, str]]:
        """Write cells by bucket, sorted by key; (bucket, folder) of the buckets that have any."""
        path = f"{self.root}/data/{name}"
        cells.withColumn("bucket", self._bucket()).repartition("bucket") \
            .sortWithinPartitions("bucket", *apply.ROW).write.mode("overwrite").partitionBy("bucket").parquet(path)
        return [(int(d.split("=", 1)[1]), f"{name}/{d}") for d in list_dirs(self.spark, path)]

    def read(self, version: int | None = None) -> DataFrame:
        """The cells of a version (default: the newest), each with its newest value."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else None
        elif version not in known:
            raise ValueError(f"no version {version}; there are {known}")
        return apply.fold(self._folders([f for _, f, _ in self.manifest(version)]).select(
            *apply.ROW, "column", F.struct("type", "value", "w").alias("v")))

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The cells of these keys (``table_name, key``): only folders of their buckets are opened."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else None)
        held = {r[0] for r in keys.select(self._bucket()).distinct().collect()}     # at most ``buckets``
        some = self._folders([f for b, f, _ in self.manifest(version) if b in held]).join(
            keys.select(*apply.ROW).distinct(), apply.ROW, "left_semi")
        return apply.fold(some.select(*apply.ROW, "column", F.struct("type", "value", "w").alias("v")))

    def apply(self, cells: DataFrame, version: int) -> None:
        """Make ``version``: the one before it and these folded cells. Running it again gives the same."""
        before = self.manifest(max((v for v in self.versions() if v < version), default=None))
        entries = before + [(b, f, False) for b, f in self._write(cells, f"v={version}")]
        deltas: dict[int, int] = {}
        for b, _, base in entries:
            deltas[b] = deltas.get(b, 0) + (not base)
        full = {b for b, n in deltas.items() if n > self.max_deltas}
        if full:
            whole = apply.fold(self._folders([f for b, f, _ in entries if b in full]).select(
                *apply.ROW, "column", F.struct("type", "value", "w").alias("v")))
            entries = [e for e in entries if e[0] not in full]
            entries += [(b, f, True) for b, f in self._write(whole, f"base={version}")]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite") \
            .parquet(f"{self.root}/manifest/v={version}")
