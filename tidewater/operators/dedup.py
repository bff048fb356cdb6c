"""Records that have been consumed before, by their offsets.

A topic partition's consumed offsets are kept as runs ``[lo, hi)`` inside bins of ``BIN``
offsets: one row per (topic, partition, bin), whatever its records. Without gaps a bin is
one run; with gaps the runs are exact, so that a record that comes late with a lower offset is
not taken for a repeated one. A batch meets only the bins that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = ["topic", "partition", "offset"]
BIN_BITS = 12
RUNS = "topic string, partition int, bin long, runs array<struct<lo:bigint,hi:bigint>>"
_KEY = ["topic", "partition", "bin"]


def offset_bin(offset: Column | str = "offset") -> Column:
    return F.shiftright(offset, BIN_BITS)


def _runs(offsets: Column) -> Column:
    """The runs of sorted distinct offsets: where one has no neighbour before it, and none behind it."""
    starts = F.filter(offsets, lambda o, i: (i == 0) | (F.get(offsets, i - 1) != o - 1))
    ends = F.filter(offsets, lambda o, i: (i == F.size(offsets) - 1) | (F.get(offsets, i + 1) != o + 1))
    return F.zip_with(starts, ends, lambda lo, hi: F.struct(lo.alias("lo"), (hi + 1).alias("hi")))


def consumed_runs(records: DataFrame) -> DataFrame:
    """``RUNS`` rows of the records' offsets: at most 2^BIN_BITS distinct offsets gather in one group."""
    rows = records.select("topic", "partition", offset_bin().alias("bin"), "offset")
    some = rows.groupBy(*_KEY).agg(F.array_sort(F.collect_set("offset")).alias("offsets"))
    return some.select(*_KEY, _runs(F.col("offsets")).alias("runs"))


def merged_runs(runs: DataFrame) -> DataFrame:
    """One row per bin of many: the runs of all of them (of different offsets), neighbours joined."""
    every = runs.groupBy(*_KEY).agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"))
    r = F.col("runs")
    starts = F.filter(r, lambda x, i: (i == 0) | (F.get(r, i - 1)["hi"] != x["lo"]))
    ends = F.filter(r, lambda x, i: (i == F.size(r) - 1) | (F.get(r, i + 1)["lo"] != x["hi"]))
    return every.select(*_KEY, F.zip_with(starts, ends, lambda a, b: F.struct(
        a["lo"].alias("lo"), b["hi"].alias("hi"))).alias("runs"))


def touched(records: DataFrame) -> tuple[int, int] | None:
    """The lowest and highest bin of a batch (None: no records)."""
    lo, hi = records.agg(F.min(offset_bin()), F.max(offset_bin())).first()
    return None if lo is None else (lo, hi)


def unseen(records: DataFrame, consumed: DataFrame) -> DataFrame:
    """The records whose offsets no run of ``consumed`` holds, one of each place."""
    once = records.dropDuplicates(PLACE).withColumn("bin", offset_bin())
    known = merged_runs(consumed)
    joined = once.join(known, _KEY, "left")
    held = F.coalesce(F.exists("runs", lambda r: (F.col("offset") >= r["lo"]) & (F.col("offset") < r["hi"])),
                      F.lit(False))
    return joined.where(~held).select(*records.columns)
