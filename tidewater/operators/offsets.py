"""Start-offset policies (S10a-e), offset ranges and progress.

Every input is a table with one row per topic partition, so the joins here
are over the partition count, not over records; ``batch_progress`` is the one
operator that reads records, and it is a partial + final aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TP = ["topic", "partition"]

POLICIES = ("zero", "latest", "resume_latest", "resume_earliest", "group", "group_latest")


def log_bounds(records: DataFrame, retained_from: Column | None = None) -> DataFrame:
    """``(topic, partition, earliest, latest)`` of a record table.

    ``latest`` is the next offset to be written (max + 1). ``retained_from``
    optionally gives a per-row lower bound of what retention kept.
    """
    first = F.min("offset") if retained_from is None else F.min(F.greatest("offset", retained_from))
    return records.groupBy(*TP).agg(first.cast("long").alias("earliest"),
                                    (F.max("offset") + 1).cast("long").alias("latest"))


def start_offset(policy: str, c: Column, e: Column, l: Column) -> Column:
    """Start offset of one partition from committed ``c``, earliest ``e``,
    latest ``l`` (null ``c``: the group has no commit for the partition).

    * ``zero`` (S10a): 0 without a commit, else the commit.
    * ``latest`` (S10b): 0 without a commit, else the latest offset.
    * ``resume_latest`` (S10c): the commit when it lies within
      ``[earliest, latest]``, else latest; earliest without a commit.
    * ``resume_earliest`` (S10d): the commit raised to earliest (no upper
      check); earliest without a commit.
    * ``group`` (the whole rule in one): without a commit for any partition, 0
      everywhere (first use); else the commit when it lies within the log, latest
      when it does not, earliest for a partition without one.
    * ``group_latest``: first use as before; else latest (earliest without a commit).
    """
    if policy == "zero":
        return F.coalesce(c, F.lit(0).cast("long"))
    if policy == "latest":
        return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(l)
    if policy == "resume_latest":
        return F.when(c.isNull(), e).when((c < e) | (c > l), l).otherwise(c)
    if policy == "resume_earliest":
        return F.when(c.isNull(), e).otherwise(F.greatest(c, e))
    if policy in ("group", "group_latest"):
        # ``any_commit``: whether the group has a commit for any partition (see below)
        known = F.when((c < e) | (c > l), l).otherwise(c) if policy == "group" else l
        return F.when(~F.col("any_commit"), F.lit(0).cast("long")) \
            .otherwise(F.when(c.isNull(), e).otherwise(known))
    raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")


def start_at(policy: str, committed: int | None, earliest: int | None, latest: int | None,
             any_commit: bool) -> int:
    """``start_offset`` of one partition as a number, for a source that knows the log's bounds
    (None: nothing written) on the driver."""
    c, e, l = committed, earliest, latest
    if e is None or l is None:
        return c or 0
    first_use = {"zero": c is None, "latest": c is None, "group": not any_commit, "group_latest": not any_commit}
    if first_use.get(policy):
        return 0
    if c is None:
        return e
    if policy in ("latest", "group_latest"):
        return l
    if policy == "resume_earliest":
        return max(c, e)
    if policy in ("resume_latest", "group"):
        return c if e <= c <= l else l
    if policy == "zero":
        return c
    raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")


def resolve_start_offsets(committed: DataFrame, bounds: DataFrame, policy: str) -> DataFrame:
    """S10e: combine the commits, earliest and latest offsets of every topic partition that any
    of the three knows (full join on ``(topic, partition)``) and apply ``policy``.
    A partition without bounds (nothing written yet, or only its commit is known) has null
    bounds and starts at its commit, else at 0.
    Output: ``topic, partition, committed, earliest, latest, start_offset``.
    """
    j = bounds.join(committed.select(*TP, "committed"), TP, "full")
    used = committed.agg((F.count("committed") > 0).alias("any_commit"))     # one row
    j = j.join(F.broadcast(used), F.lit(True))
    c, e, l = F.col("committed"), F.col("earliest"), F.col("latest")
    start = F.coalesce(start_offset(policy, c, e, l), c, F.lit(0).cast("long"))
    return j.select(*TP, c, e, l, start.cast("long").alias("start_offset"))


def rate_batches(records: DataFrame, max_per_partition: int,
                 start: Column | None = None) -> DataFrame:
    """S9 on a record table: batch ``b`` of a partition holds the offsets
    ``[start + b*cap, start + (b+1)*cap)``, as a per-partition rate cap
    times the batch interval cuts them."""
    s = F.lit(0) if start is None else start
    return records.withColumn(
        "batch_id", F.floor((F.col("offset") - s) / F.lit(max_per_partition)).cast("long"))


def batch_progress(records: DataFrame, batch: str = "batch_id") -> DataFrame:
    """A5 / K2: per batch and partition the consumed range
    ``[from_offset, until_offset)`` and the record count."""
    return records.groupBy(batch, *TP).agg(
        F.min("offset").cast("long").alias("from_offset"),
        (F.max("offset") + 1).cast("long").alias("until_offset"),
        F.count(F.lit(1)).alias("records"))


def batch_ranges(records: DataFrame) -> DataFrame:
    """K2: the consumed range of each topic partition of one micro-batch."""
    return records.groupBy(*TP).agg(
        F.min("offset").cast("long").alias("from_offset"),
        (F.max("offset") + 1).cast("long").alias("until_offset"),
        F.count(F.lit(1)).alias("records"))


def committed_from_progress(progress: DataFrame) -> DataFrame:
    """Consumer commit per partition from a progress table: the highest
    ``until_offset`` (what a restart resumes from)."""
    return progress.groupBy(*TP).agg(F.max("until_offset").cast("long").alias("committed"))


def starting_offsets(records: DataFrame, progress: DataFrame, policy: str) -> str:
    """``startingOffsets`` JSON for a new query on a topic (S10 + K2).

    ``records``: the topic's records (a batch Kafka read from earliest to
    latest, or Kafka-shaped files); ``progress``: a previous job's progress
    table (its commits). Both reduce to one row per topic partition before
    anything reaches the driver.
    """
    from tidewater.sources.kafka import starting_offsets_json

    bounds = log_bounds(records.select(*TP, "offset"))
    start = resolve_start_offsets(committed_from_progress(progress), bounds, policy)
    return starting_offsets_json(start)
