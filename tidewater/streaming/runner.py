"""Starting a micro-batch query on a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.sinks.tables import exists, list_dirs


def output_generation(spark: SparkSession, checkpoint: str, out_root: str) -> str:
    """Output folder of a job (K7).

    Recovery (the checkpoint has progress) continues in the newest output
    generation; a fresh start opens a new, empty generation instead of
    deleting the old output, which stays readable but is no longer used.
    """
    gens = sorted(int(d.split("=", 1)[1]) for d in list_dirs(spark, out_root)
                  if d.startswith("gen="))
    recovering = exists(spark, f"{checkpoint}/offsets")
    if recovering and gens:
        g = gens[-1]
    else:
        g = (gens[-1] + 1) if gens else 0
    return f"{out_root}/gen={g}"


def start(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str,
          trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """``foreachBatch`` query; ``trigger`` e.g. ``{"processingTime": "10 seconds"}``
    (R1) or ``{"availableNow": True}`` (tests, catch-up runs)."""
    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def run_available(stream: DataFrame, process: Callable[[DataFrame, int], None],
                  checkpoint: str, timeout_s: float | None = None) -> None:
    """Process everything available now, then stop (raises the query's error)."""
    q = start(stream, process, checkpoint, {"availableNow": True})
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
