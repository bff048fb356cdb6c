"""Committing the consumed offset ranges of a batch (K2a-d)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from tidewater.sinks.tables import write_epoch

LOG = logging.getLogger("tidewater.progress")
ON_ERROR = ("raise", "log")


def write_progress(ranges: DataFrame, path: str, epoch: int, on_error: str = "raise") -> bool:
    """Write one row per topic partition (``offsets.batch_ranges``) as the epoch's progress, visible as
    a whole once it is written. Returns whether it was.

    An empty batch has no offsets to commit: it is logged and writes nothing. ``on_error``: a failed
    write fails the batch (``raise``), or is logged and left (``log``): the checkpoint holds the
    offsets, the table misses this epoch.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, got {on_error!r}")
    try:
        rows = ranges.collect()         # at most one row per topic partition
        if not rows:
            LOG.error("epoch %s: empty batch, no offsets to commit", epoch)
            return False
        spark = ranges.sparkSession
        write_epoch(spark.createDataFrame(rows, ranges.schema).coalesce(1), path, epoch)
    except Exception as e:
        if on_error == "raise":
            raise
        LOG.error("epoch %s: offsets not committed: %s", epoch, e)
        return False
    return True
