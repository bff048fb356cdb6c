"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) of the links (a, b) of bigints: the least node of each component.

    In each round a node takes the least of its own root, its neighbours' roots and
    its root's root; the last doubles the way that roots travel, so that long chains
    take a logarithmic number of rounds. A node with very many links costs one
    combined row per task. After only so many ``rounds``, equal roots still mean connected
    nodes, but not the other way round.
    """
    ways = links.select(F.explode(F.array(F.struct(F.col("a"), F.col("b")),
                                          F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("w")).select("w.a", "w.b")
    ways = written(ways.distinct(), "ways")
    labels = written(ways.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while rounds is None or rounds > 0:
        near = ways.join(labels.select(F.col("node").alias("b"), "root"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        here = labels.join(near, "node").select("node", "root",
                                                F.least("root", "near").alias("next"))
        far = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        labels = written(here.join(far, "next").select(
            "node", F.least("next", "far").alias("root"),
            (F.least("next", "far") < F.col("root")).alias("moved")), "labels")
        rounds = None if rounds is None else rounds - 1
        done = rounds is None and labels.where("moved").isEmpty()
        labels = labels.select("node", "root")
        if done:
            break
    return labels
