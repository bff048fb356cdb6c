"""Joins with small sides and with hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side that is usually small. No hint: the planner broadcasts a local
    relation of known size, AQE any side whose measured size is under its threshold, and
    what is larger is joined by sort and merge."""
    return big.join(small, on=on, how=how)


def hot_key_join(big: DataFrame, small: DataFrame, keys: list[str], count_col: str, hot_rows: int,
                 salt_by: list[str]) -> DataFrame:
    """Left join of ``big`` with ``small`` (at most one row per key) in which no key sends more
    than about ``hot_rows`` rows of ``big`` to one task.

    ``small`` carries each key's number of rows in ``big`` (``count_col``). The keys above
    ``hot_rows`` are at most rows(big) / hot_rows: this list is broadcast, so the rows of
    ``big`` get their salts where they are, before anything is shuffled by the key. They
    are dealt over ``ceil(n / hot_rows)`` salts by a hash of ``salt_by`` (a task retry
    computes the same one), and only the hot keys' rows of ``small`` are repeated per salt.
    """
    salts = F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int")
    hot = small.where(F.col(count_col) > hot_rows).select(*keys, salts.alias("_salts"))
    b = (big.join(F.broadcast(hot), keys, "left")
            .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                        .otherwise(F.pmod(F.xxhash64(*salt_by), F.col("_salts")).cast("int")))
            .drop("_salts"))
    s = small.withColumn("_salt", F.explode(F.when(
        F.col(count_col) > hot_rows, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    return b.join(s, [*keys, "_salt"], "left").drop("_salt")
