"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words; a document's expected number of
copies is target / source size. The whole part is given to every document of
the source, the fractional part is rounded by the pivotal method: two
documents meet, mass moves at random from one to the other until one of them
holds 0 or 1, the other goes on to meet the next. The meetings form a tree:
blocks of ``fan_in`` documents of like size are each reduced to one residual
document, the residuals of a source form the blocks of the next level, and so
on until each source has one residual left, which is rounded by its own mass.
A source's number of copies is thus its expected number, rounded, and because
documents meet others of like size first, so nearly is its number of words.

All DataFrame and SQL functions; only (row, source, size, mass) take part, the
texts do not. Blocks are dealt by a hash within source and size class, so a
source with a third of all rows is spread over many tasks. Randomness is a hash
of seed, document id and level: reruns agree.

Edge cases: a null or blank text has size 0 and keeps its place (taken 0); a
null source is a source of its own and comes last; repeated ids are told
apart by their source and text hash, fully equal rows share one draw; null ids
take part; if all sizes are 0 every target is 0; an empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, packed, unpacked, written

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
FAN_IN = 128
SEED = 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source.

    Shares by weight, each stopped at ``max_copies`` times its source's size and
    the excess reshared by weight. With the sources in order of limit / weight,
    those stopped are a prefix; the others share what is left.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]),
                   F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    per = per.withColumn("weight", weight.cast("bigint")) \
             .withColumn("cap", F.col("source_size") * max_copies)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
                 .rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(fill), F.lit(0))
    left_w = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(fill), F.lit(0))
    per = per.withColumn("left", left).withColumn("left_w", left_w) \
             .withColumn("open", F.col("cap") * F.col("left_w") >= F.col("left") * F.col("weight"))
    # The first source in this order that is not stopped gives the level for all after it.
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "left", "left_w"))
                  ).over(every)
    per = per.withColumn("level", first)
    share = F.col("level.left").cast("double") / F.col("level.left_w") * F.col("weight")
    target = F.least(F.col("cap").cast("double"), F.coalesce(share, F.col("cap").cast("double")))
    return per.select("source", "source_size", target.alias("target"))


def _u(level: int, seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on these columns only."""
    h = F.xxhash64(F.lit(seed), F.lit(level), *cols)
    return (F.pmod(h, F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def _meet(acc: Column, x: Column) -> Column:
    """One meeting of the pivotal method: the holder ``acc`` and the next unit ``x``."""
    p, q, u = acc["p"], x["p"], x["u"]
    both = p + q
    low = both < 1.0
    # Below 1 the loser drops to 0; from 1 on the winner leaves with 1.
    first = F.when(low, u * both < p).otherwise(u * (2.0 - both) < 1.0 - q)
    stays = F.when(low, first).otherwise(~first)
    rest = F.when(low, both).otherwise(F.greatest(both - 1.0, F.lit(0.0)))
    won = F.when(low, F.lit(None)).otherwise(F.when(first, acc["k"]).otherwise(x["k"]))
    return F.struct(
        F.when(stays, acc["k"]).otherwise(x["k"]).alias("k"),
        rest.alias("p"),
        F.when(stays, acc["size"]).otherwise(x["size"]).alias("size"),
        F.when(won.isNull(), acc["won"]).otherwise(F.array_append(acc["won"], won)).alias("won"))


def _reduce(units: DataFrame, level: int, seed: int) -> DataFrame:
    """Blocks of units to (source, residual k, p, size, won): one row per block."""
    unit = F.struct(F.col("size"), _u(level, seed, F.col("k")).alias("u"), F.col("k"), F.col("p"))
    packed = units.groupBy("source", "block").agg(F.array_sort(F.collect_list(unit)).alias("us"))
    head = F.get("us", F.lit(0))
    start = F.struct(head["k"].alias("k"), head["p"].alias("p"), head["size"].alias("size"),
                     F.array().cast("array<struct<id:bigint,row:bigint>>").alias("won"))
    acc = F.aggregate(F.slice("us", F.lit(2), F.greatest(F.size("us") - 1, F.lit(0))), start, _meet)
    return packed.select("source", acc.alias("a")).select("source", "a.*")


def _blocks(units: DataFrame, level: int, seed: int, fan_in: int) -> DataFrame:
    """Deal the units of each source and size class over blocks of about ``fan_in``."""
    # A source that fits in one block meets in order of size as a whole.
    per = units.groupBy("source").agg(F.count("*").alias("all")).withColumnRenamed("source", "s0")
    units = units.join(per, F.col("source").eqNullSafe(F.col("s0")))
    cls = F.when((F.lit(level) > 0) | (F.col("all") <= fan_in), 0).otherwise(
        F.floor(F.log2(F.col("size") + F.lit(1)) * 2)).cast("int")
    units = units.withColumn("cls", cls).drop("s0", "all")
    n = units.groupBy("source", "cls").agg(F.count("*").alias("n")) \
             .withColumnRenamed("source", "s").withColumnRenamed("cls", "c")
    # One row per source and size class.
    dealt = units.join(n, F.col("source").eqNullSafe(F.col("s")) & (F.col("cls") == F.col("c")))
    blocks = F.ceil(F.col("n") / F.lit(fan_in))
    at = F.pmod(F.xxhash64(F.lit(seed + 1), F.lit(level), "k"), blocks)
    return dealt.withColumn("block", F.struct("cls", at.alias("at"))).drop("s", "c", "cls", "n")


def pivotal_rounding(units: DataFrame, fan_in: int = FAN_IN, seed: int = SEED) -> DataFrame:
    """Round the masses of (source, k struct<id, row>, size, p in [0, 1)) to 0 or 1.

    Returns (source, k) of the units rounded up.
    """
    won, level = [], 0
    todo = units.where("p > 0")
    while True:
        out = written(_reduce(_blocks(todo, level, seed, fan_in), level, seed), f"pivotal-{level}")
        won.append(out.select("source", F.explode("won").alias("k")))
        todo = out.where("p > 0").select("source", "k", "size", "p")
        level += 1
        most = todo.groupBy("source").count().agg(F.max("count")).first()[0]
        if (most or 0) <= 1:
            break
    last = todo.where(_u(-1, seed, F.col("k")) < F.col("p")).select("source", "k")
    for w in won:
        last = last.unionByName(w)
    return last


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                max_copies: int = MAX_COPIES, fan_in: int = FAN_IN,
                seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, row, source, size, source_size, target, copies, taken.

    ``row`` tells rows of a source with the same id apart: the hash of their text.
    """
    text = docs[text_col].cast("string")
    rows = written(docs.select(
        docs[id_col].alias("doc_id"), F.xxhash64(text).alias("row"),
        docs[source_col].cast("string").alias("source"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint").alias("size")),
        "mix-sizes")
    targets = written(source_targets(rows, weights, max_copies), "mix-targets")
    t = targets.withColumnRenamed("source", "s")
    each = rows.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A ratio a rounding error away from a whole number is that number.
    whole = F.when(F.abs(per - F.round(per)) < 1e-9, F.round(per)).otherwise(F.floor(per))
    each = each.withColumn("whole", whole.cast("bigint")) \
               .withColumn("p", F.greatest(per - F.col("whole"), F.lit(0.0)))
    each = each.withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p")))
    key = F.struct(F.col("doc_id").cast("bigint").alias("id"), "row")
    units = each.select("source", key.alias("k"), "size", "p").where("size > 0").distinct()
    up = pivotal_rounding(units, fan_in, seed).select(
        F.col("source").alias("up_source"), F.col("k.id").alias("up_id"), F.col("k.row").alias("up_row")).withColumn("up", F.lit(1))
    joined = each.join(up, F.col("doc_id").eqNullSafe(F.col("up_id"))
                       & (F.col("row") == F.col("up_row"))
                       & F.col("source").eqNullSafe(F.col("up_source")), "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("up", F.lit(0))) \
              .otherwise(F.least(F.lit(1), F.col("whole"))).cast("bigint")
    return joined.select("doc_id", "row", "source", "size", "source_size", "target",
                         copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                    max_copies: int = MAX_COPIES, fan_in: int = FAN_IN,
                    seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns."""
    taken = mix_sources(docs, id_col, text_col, source_col, weights, max_copies, fan_in, seed) \
        .where("copies > 0").select("doc_id", "row", "source", "copies").distinct()
    rows = packed(docs, id_col, text_col).withColumn("row", F.xxhash64("text")) \
        .withColumn("source", F.col(f"rest.{source_col}").cast("string"))
    both = rows.alias("d").join(taken.alias("t"),
                                F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))
                                & (F.col("d.row") == F.col("t.row"))
                                & F.col("d.source").eqNullSafe(F.col("t.source")))
    each = both.select("d.text", "d.rest", F.explode(F.sequence(F.lit(1), F.col("t.copies"))))
    return unpacked(each, docs.columns, text_col)
