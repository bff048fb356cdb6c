"""Registered change-event queries: cells, statements, routes, rejects (6-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import apply, changelog
from tidewater.sinks.tables import materialize
from tidewater.sources.fixtures import CDC_KEYS, read_cdc_events

EVENT_ID = ["topic", "partition", "offset", "batch_id"]


def cdc_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 6: each written-candidate cell with full and first-segment values."""
    return changelog.cells_long(read_cdc_events(spark, sf_dir))


def cdc_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 7: rendered statement of every valid insert / update."""
    p = changelog.prepare(read_cdc_events(spark, sf_dir), CDC_KEYS)
    return p.where(F.col("statement").isNotNull()).select(
        *EVENT_ID, "route", "statement", "statement_compat")


def cdc_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 8: events per batch and route."""
    ev = read_cdc_events(spark, sf_dir)
    return (ev.groupBy("batch_id", changelog.route("actionType").alias("route"))
              .agg(F.count(F.lit(1)).alias("events")))


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 9: events refused before any write, with the reason."""
    p = changelog.prepare(read_cdc_events(spark, sf_dir), CDC_KEYS, compat=False)
    return p.where(F.col("reason").isNotNull()).select(*EVENT_ID, "route", "reason")


def _prepared(spark: SparkSession, sf_dir: str, consumers: int = 2) -> DataFrame:
    """Prepared events. With three or more consumers in the plan (the apply
    queries: valid events, the per-key table, the batch ids) they are written
    once to the shared scratch folder and read back (column-pruned), instead
    of scanning the sources and redoing the map work per consumer."""
    p = changelog.prepare(read_cdc_events(spark, sf_dir), CDC_KEYS, compat=False)
    return materialize(p, "prepared-events") if consumers >= 3 else p



def cdc_apply_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 17: status of every event attempt against the native target."""
    return apply.status_rows(_prepared(spark, sf_dir, consumers=3))


def cdc_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 18: the target after all batches and retries, long form."""
    return apply.final_state(_prepared(spark, sf_dir, consumers=3))


# Columns of the customer target written by the change events (fixed values).
TARGET_COLUMNS = ("acct_bal", "cust_key", "cust_name", "last_order_date", "mkt_segment", "note")


def cdc_target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target as rows: one per key, one column per listed column, and the names of any
    others that the key has."""
    return apply.to_wide(apply.final_state(_prepared(spark, sf_dir, consumers=3)), TARGET_COLUMNS)


def cdc_retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 19: each zero-row update and the outcome of its one retry."""
    return apply.retry_outcome(_prepared(spark, sf_dir, consumers=3))


def cdc_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead-letter table: failed statements and second zero-row misses."""
    return apply.dead_letters(_prepared(spark, sf_dir, consumers=3))


QUERIES = {
    "cdc_cells": cdc_cells,
    "cdc_statements": cdc_statements,
    "cdc_routes": cdc_routes,
    "cdc_rejects": cdc_rejects,
    "cdc_apply_status": cdc_apply_status,
    "cdc_final_state": cdc_final_state,
    "cdc_target_rows": cdc_target_rows,
    "cdc_retry_outcome": cdc_retry_outcome,
    "cdc_dead_letter": cdc_dead_letter,
}
