"""Applying change events to a Spark-native target.

The target is kept *long*: one row per ``(table_name, key, column)`` with the
value, its type tag and the order of the event that wrote it, so a later batch
can compare per column. Semantics, per batch in event order:

* An insert adds its key. A key that already exists (in the target, or by an
  earlier insert) makes the insert an ``error`` (as a primary-key violation
  would), never an upsert.
* An update whose key exists at that moment is ``applied``. One whose key does
  not exist yet is ``zero_rows`` (it matched no row) and gets one second
  chance: it is matched again after the *next* batch that runs has been
  applied (the next batch id present; at ``flush`` when no batch follows). Still no row -> dead letter with reason
  ``zero_rows_after_retry``.
* Final values: insert values are the base; among the updates applied to a
  column, the newest ``(batch_id, topic, partition, offset)`` wins - also when an
  older update is applied late by its retry.

Everything below is one aggregate (first insert and event count per key),
one join of the events with it, and one ``max_by`` fold: all partial-
aggregate friendly, no window and nothing that gathers a key's events in one
place. Hot keys are salted before the join shuffles anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.changelog import IGNORED, INSERT, UPDATE
from tidewater.operators.joins import hot_key_join

ROW = ["table_name", "key"]
EVENT_ID = ["batch_id", "topic", "partition", "offset"]
STATUS_COLUMNS = EVENT_ID + ["attempt", "status", "reason"]


def _order() -> Column:
    return F.struct("batch_id", "topic", "partition", "offset")


def keyed(prepared: DataFrame) -> DataFrame:
    """Valid inserts and updates with their row identity and order."""
    return (prepared.where(F.col("reason").isNull() & (F.col("route") != IGNORED))
                    .withColumnRenamed("tableName", "table_name")
                    .withColumn("ord", _order()))


#: Order of keys that are in the target already: before every event.
BEFORE_ALL = (("batch_id", -1, "long"), ("topic", "", "string"), ("partition", -1, "int"),
              ("offset", -1, "long"))


def first_inserts(valid: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``(table_name, key, first_ins, events)``: the order of each key's first valid insert
    (null: none) and the number of its events, in one aggregate. Keys of ``existing``
    (already in the target) come before all events: every insert of them is a duplicate,
    every update applies."""
    ins = valid.select(*ROW, F.when(F.col("route") == INSERT, F.col("ord")).alias("first_ins"),
                       F.lit(1).cast("long").alias("events"))
    if existing is not None:
        # no distinct(): the min() below absorbs duplicate keys
        first = F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in BEFORE_ALL])
        ins = ins.unionByName(existing.select(*ROW, first.alias("first_ins"),
                                              F.lit(0).cast("long").alias("events")))
    return ins.groupBy(*ROW).agg(F.min("first_ins").alias("first_ins"),
                                 F.sum("events").alias("_events"))


# A key with more events than this is split over several tasks in the join.
HOT_KEY_ROWS = 1_000_000


def with_first_insert(valid: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``valid`` events with their key's ``first_ins`` (null: no insert yet). Keys with more
    than ``HOT_KEY_ROWS`` events are salted before the join (``joins.hot_key_join``), so a
    key holding a third of all events does not land in one task."""
    first = first_inserts(valid, existing)
    return hot_key_join(valid, first, ROW, "_events", HOT_KEY_ROWS,
                        ["topic", "partition", "offset"]).drop("_events")


def with_next_batch(events: DataFrame, prepared: DataFrame) -> DataFrame:
    """Adds ``next_batch``: the smallest batch id above the event's batch
    (null for the last batch). The window runs over one row per batch id."""
    batches = prepared.select("batch_id").distinct()
    nxt = batches.withColumn("next_batch", F.lead("batch_id").over(Window.orderBy("batch_id")))
    return events.join(nxt, "batch_id", "left")


def first_status(prepared: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Every valid insert / update with ``first_ins`` and ``first_status`` (applied, zero_rows,
    error)."""
    j = with_first_insert(keyed(prepared), existing)
    fi, o = F.col("first_ins"), F.col("ord")
    is_ins, is_upd = F.col("route") == INSERT, F.col("route") == UPDATE
    return j.withColumn("first_status", F.when(is_ins & (fi == o), F.lit("applied"))
                        .when(is_ins, F.lit("error"))
                        .when(is_upd & fi.isNotNull() & (fi < o), F.lit("applied"))
                        .otherwise(F.lit("zero_rows")))


def outcomes(prepared: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``first_status`` and, for zero-row updates, ``retry_status`` (applied, dead_letter)."""
    j = with_next_batch(first_status(prepared, existing), prepared)
    # the retry runs after the next batch that exists (or at flush after the last)
    fi, nb = F.col("first_ins"), F.col("next_batch")
    retry_ok = fi.isNotNull() & (nb.isNull() | (fi["batch_id"] <= nb))
    return j.withColumn("retry_status", F.when(
        F.col("first_status") == "zero_rows",
        F.when(retry_ok, F.lit("applied")).otherwise(F.lit("dead_letter"))))


def _attempt(n: int, status: Column, reason: Column) -> Column:
    return F.struct(F.lit(n).alias("attempt"), status.alias("status"),
                    reason.cast("string").alias("reason"))


def status_rows(prepared: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Status table: one row per event attempt (``attempt`` 0 for every event,
    1 for the retry of a zero-row update). The outcomes are computed once; each event's
    attempts leave as an array."""
    out = outcomes(prepared, existing)
    fs, rs = F.col("first_status"), F.col("retry_status")
    first = _attempt(0, fs, F.when(fs == "error", F.lit("duplicate_key"))
                             .when(fs == "zero_rows", F.lit("no_matching_row")))
    retry = _attempt(1, rs, F.when(rs == "dead_letter", F.lit("zero_rows_after_retry")))
    tries = F.when(rs.isNull(), F.array(first)).otherwise(F.array(first, retry))
    tried = out.select(*EVENT_ID, F.explode(tries).alias("a")).select(*EVENT_ID, "a.*")
    other = prepared.where(F.col("reason").isNotNull() | (F.col("route") == IGNORED)).select(
        *EVENT_ID, F.lit(0).alias("attempt"),
        F.when(F.col("route") == IGNORED, F.lit("ignored")).otherwise(F.lit("rejected")).alias("status"),
        F.col("reason"))
    return tried.unionByName(other)


def dead_letters(prepared: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """K5 / K6: statements that failed (``error``, executor side) or matched
    no row twice (``zero_rows_after_retry``, driver side)."""
    failed = F.col("first_status") == "error"
    dead = outcomes(prepared, existing).where(failed | (F.col("retry_status") == "dead_letter"))
    return dead.select(*EVENT_ID, F.when(failed, F.lit(0)).otherwise(F.lit(1)).alias("attempt"),
                       F.when(failed, F.lit("error")).otherwise(F.lit("zero_rows_after_retry"))
                        .alias("reason"), "statement")


def retry_outcome(prepared: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Every zero-row update, after which batch its retry ran (null:
    at the flush after the last batch) and how it ended."""
    out = outcomes(prepared, existing)
    return out.where(F.col("first_status") == "zero_rows").select(
        *EVENT_ID, F.col("next_batch").alias("retry_after_batch"),
        F.when(F.col("retry_status") == "applied", F.lit("applied_on_retry"))
         .otherwise(F.lit("dead_letter")).alias("outcome"), "statement")


def event_cells(applied: DataFrame) -> DataFrame:
    """Long cells of applied events (``table_name, key, route, ord, cells``)
    with the fold order ``w = (is_update, event order)``."""
    cells = applied.select(*ROW, (F.col("route") == UPDATE).alias("is_update"), "ord",
                           F.explode("cells").alias("c"))
    return cells.select(*ROW, F.col("c.column").alias("column"),
                        F.struct(F.col("c.type").alias("type"), F.col("c.value").alias("value"),
                                 F.struct("is_update", "ord").alias("w")).alias("v"))


def applied_cells(out: DataFrame) -> DataFrame:
    """Cells of every event applied at once or by its retry."""
    return event_cells(out.where((F.col("first_status") == "applied")
                                 | (F.col("retry_status") == "applied")))


def fold(cells: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Per ``(table_name, key, column)`` the value with the greatest order
    (``max_by``, a partial aggregate). ``state`` is an earlier result of this
    function (long target), folded in the same way.
    Output: ``table_name, key, column, type, value, w``.
    """
    if state is not None:
        cells = cells.unionByName(state.select(
            *ROW, "column", F.struct("type", "value", "w").alias("v")))
    g = cells.groupBy(*ROW, "column").agg(F.max_by("v", F.col("v.w")).alias("v"))
    return g.select(*ROW, "column", "v.type", "v.value", "v.w")


def final_state(prepared: DataFrame) -> DataFrame:
    """R2 + fold over all batches and their retries (empty target at start)."""
    return fold(applied_cells(outcomes(prepared))).drop("w")


def to_wide(state: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The long target as rows: one per ``(table_name, key)`` with one column per name in
    ``columns`` (values as text; absent cells are null) and ``unlisted``: the names of the
    key's other columns, joined by commas (null: none), so that none is lost unseen.

    Plain aggregates with the columns given up front: no extra pass to discover them.
    """
    values = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
    others = F.collect_set(F.when(~F.col("column").isin(*columns), F.col("column")))
    names = F.array_join(F.array_sort(others), ",")
    return state.groupBy(*ROW).agg(*values, F.when(F.size(others) > 0, names).alias("unlisted"))
