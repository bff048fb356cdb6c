"""Applying change events to an external database through DB-API.

Work is planned in Spark so the database sees a few statements per key and
batch, however many events the key has. In this order:

* ``before``: the key's updates ordered before its first insert of the batch
  (all of them when the batch has no insert), folded to one ``UPDATE`` with
  the newest value per column (``max_by``, a partial aggregate, so a hot key
  is pre-aggregated before any shuffle);
* ``insert``: the first insert of the key (later ones are duplicates);
* ``pending``: the second chance of the batch before: its zero-row updates,
  without the columns that newer updates of that batch have written since;
* ``after``: the updates after that insert, folded the same way.

Each key's rows go to one task (hash of the key; one row per key and
segment, so no task gets a large group). A task runs its statements in one
transaction and records their outcomes in a ledger table in that same
transaction, by job, batch, table, key and segment: whatever task meets them
again, in whatever number of tasks, finds the ledger rows and returns them
instead of writing twice (exactly-once effect), and another job never does.
A folded update that fails is run again event by event (``single_events``), so
one bad value fails its own event only. Values are always bound parameters;
identifiers were checked by ``changelog.prepare``. A failed connection raises
so Spark retries the task (instead of logging every statement as failed).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import apply, changelog
from tidewater.operators.joins import join_small

ROW = apply.ROW
SEGMENTS = ("before", "insert", "pending", "after")
OUTCOME_SCHEMA = "table_name string, key string, segment string, outcome string, error string"
LEDGER = "tidewater_ledger"
OUT_COLUMNS = ["table_name", "key", "segment", "outcome", "error"]


def plan(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Returns ``(events, work)``.

    ``events``: valid events with ``segment`` (before / insert / duplicate /
    after). ``work``: one row per ``(table_name, key, segment)`` with the
    folded ``cells`` (array of struct(column, type, value)).
    """
    v = apply.with_first_insert(apply.keyed(prepared))
    fi, o, is_ins = F.col("first_ins"), F.col("ord"), F.col("route") == changelog.INSERT
    seg = (F.when(is_ins & (o == fi), F.lit("insert")).when(is_ins, F.lit("duplicate"))
            .when(fi.isNull() | (o < fi), F.lit("before")).otherwise(F.lit("after")))
    events = v.withColumn("segment", seg)
    upd = (events.where(F.col("segment").isin("before", "after"))
                 .select(*ROW, "segment", "ord", F.explode("cells").alias("c"))
                 .groupBy(*ROW, "segment", F.col("c.column").alias("column"))
                 .agg(F.max_by(F.struct(F.col("c.type").alias("type"),
                                        F.col("c.value").alias("value")), F.col("ord")).alias("v")))
    upd = upd.groupBy(*ROW, "segment").agg(
        F.array_sort(F.collect_list(F.struct("column", "v.type", "v.value"))).alias("cells"))
    ins = events.where(F.col("segment") == "insert").select(
        *ROW, "segment", F.transform("cells", lambda c: F.struct(
            c["column"].alias("column"), c["type"].alias("type"), c["value"].alias("value")))
        .alias("cells"))
    return events, upd.unionByName(ins)


def _placeholder(paramstyle: str, i: int) -> str:
    return {"qmark": "?", "format": "%s", "pyformat": "%s", "numeric": f":{i + 1}"}[paramstyle]


def key_values(key: str, n: int) -> list[str]:
    """The values of a key's text (``changelog.key_text``) with n columns."""
    if n == 1:
        return [key]
    return [re.sub(r"\\(.)", r"\1", v, flags=re.S) for v in re.findall(r"((?:[^\\,]|\\.)*)(?:,|\Z)",
                                                                   key, re.S)[:n]]


def _statement(table: str, keys: tuple[str, ...], segment: str, cells, paramstyle: str):
    cols = [c["column"] for c in cells]
    vals = [c["value"] for c in cells]
    if segment == "insert":
        ph = ", ".join(_placeholder(paramstyle, i) for i in range(len(cols)))
        return f"INSERT INTO {table} ({', '.join(cols)}) VALUES ({ph})", vals
    # Without columns left to write, the statement only asks whether the row is there.
    sets = ", ".join(f"{c} = {_placeholder(paramstyle, i)}" for i, c in enumerate(cols)) \
        or f"{keys[0]} = {keys[0]}"
    at = " AND ".join(f"{k} = {_placeholder(paramstyle, len(cols) + i)}" for i, k in enumerate(keys))
    return f"UPDATE {table} SET {sets} WHERE {at}", vals


#: Keys looked up in the ledger by one statement.
LOOKUP = 200


def _create_ledger(cur) -> None:
    cur.execute(f"CREATE TABLE IF NOT EXISTS {LEDGER} (job_id TEXT, batch_id BIGINT, "
                "table_name TEXT, row_key TEXT, segment TEXT, outcome TEXT, error TEXT)")


def _done(cur, paramstyle: str, job_id: str, batch_id: int, keys: list[str]) -> dict:
    """Ledger rows of these keys: {(table, key, segment): (outcome, error)}."""
    out = {}
    for a in range(0, len(keys), LOOKUP):
        part = keys[a:a + LOOKUP]
        ph = [_placeholder(paramstyle, i) for i in range(len(part) + 2)]
        cur.execute(f"SELECT table_name, row_key, segment, outcome, error FROM {LEDGER} "
                    f"WHERE job_id = {ph[0]} AND batch_id = {ph[1]} "
                    f"AND row_key IN ({', '.join(ph[2:])})", [job_id, batch_id, *part])
        out.update({tuple(r[:3]): tuple(r[3:]) for r in cur.fetchall()})
    return out


def _executor(connect: Callable[[], object], key_column: changelog.KeyColumns, paramstyle: str, job_id: str,
              batch_id: int):
    ph = [_placeholder(paramstyle, i) for i in range(7)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conn = cur = None
        try:
            for b in batches:      # rows arrive sorted by key, then in order of execution
                if b.empty:
                    continue
                if conn is None:
                    conn = connect()    # raises on failure: Spark retries the task
                    cur = conn.cursor()
                    _create_ledger(cur)
                done = _done(cur, paramstyle, job_id, batch_id, list(dict.fromkeys(b["key"])))
                out, new = [], []
                for r in b.to_dict("records"):
                    row = (r["table_name"], r["key"], r["segment"])
                    if row in done:     # committed before: report, do not apply again
                        out.append((*row, *done[row]))
                        continue
                    keys = changelog.key_columns(key_column, r["table_name"])
                    sql, params = _statement(r["table_name"], keys, r["segment"],
                                             list(r["cells"]), paramstyle)
                    if r["segment"] != "insert":
                        params = params + key_values(r["key"], len(keys))
                    try:
                        cur.execute("SAVEPOINT s")
                        cur.execute(sql, params)
                        n = cur.rowcount
                        cur.execute("RELEASE SAVEPOINT s")
                        outcome = "applied" if (r["segment"] == "insert" or n > 0) else "zero_rows"
                        new.append((*row, outcome, None))
                    except Exception as e:  # this statement failed; the others go on
                        cur.execute("ROLLBACK TO SAVEPOINT s")
                        new.append((*row, "error", str(e)))
                cur.executemany(f"INSERT INTO {LEDGER} VALUES ({', '.join(ph)})",
                                [(job_id, batch_id) + o for o in new])
                # Rows yielded before the commit belong to this task attempt only:
                # if the commit fails the attempt fails and its output is dropped.
                yield pd.DataFrame(out + new, columns=OUT_COLUMNS)
            if conn is not None:
                conn.commit()
        finally:
            if conn is not None:
                conn.close()

    return run


def execute(work: DataFrame, connect: Callable[[], object],
            key_column: changelog.KeyColumns = changelog.DEFAULT_KEY,
            batch_id: int = 0, paramstyle: str = "qmark", tasks: int | None = None,
            job_id: str = "", order: tuple[str, ...] = ()) -> DataFrame:
    """Run the planned statements; returns one outcome row per work row.

    A key's rows run in the order of the segments, or of the columns ``order``.
    Call it once per batch and materialise the result once (write it):
    evaluating it twice would ask the database twice (the ledger then answers
    the second time).
    """
    n = tasks or work.sparkSession.sparkContext.defaultParallelism
    seg_order = F.array_position(F.array(*[F.lit(x) for x in SEGMENTS]), F.col("segment"))
    by_key = work.repartition(n, *ROW).sortWithinPartitions(*ROW, *(order or (seg_order,)))
    return by_key.select(*ROW, "segment", "cells").mapInPandas(
        _executor(connect, key_column, paramstyle, job_id, batch_id), OUTCOME_SCHEMA)


def prune(connect: Callable[[], object], job_id: str, below: int, paramstyle: str = "qmark") -> None:
    """Delete the job's ledger rows of batches that can no longer be replayed."""
    conn = connect()
    try:
        cur = conn.cursor()
        _create_ledger(cur)
        cur.execute(f"DELETE FROM {LEDGER} WHERE job_id = {_placeholder(paramstyle, 0)} "
                    f"AND batch_id < {_placeholder(paramstyle, 1)}", [job_id, below])
        conn.commit()
    finally:
        conn.close()


def single_events(events: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Work rows for the updates of every folded update that failed, one per event: the segment
    names the event. ``ord`` gives their order."""
    failed = outcomes.where((F.col("outcome") == "error")
                            & F.col("segment").isin("before", "after")).select(*ROW, "segment")
    cells = F.transform("cells", lambda c: F.struct(
        c["column"].alias("column"), c["type"].alias("type"), c["value"].alias("value")))
    return events.join(failed, [*ROW, "segment"], "left_semi").select(
        *ROW, _event_segment().alias("segment"), cells.alias("cells"), "ord")


def _event_segment() -> Column:
    return F.concat_ws(":", F.lit("event"), "topic", "partition", "offset")


def without_written(before: DataFrame, after: DataFrame) -> DataFrame:
    """The ``pending`` work of zero-row updates: their cells but for the columns that newer
    applied updates of the same key have written."""
    newer = after.select(*ROW, F.transform("cells", lambda c: c["column"]).alias("newer"))
    left = F.filter("cells", lambda c: ~F.array_contains("newer", c["column"]))
    return before.join(newer, ROW, "left").select(
        *ROW, F.lit("pending").alias("segment"),
        F.when(F.col("newer").isNull(), F.col("cells")).otherwise(left).alias("cells"))


def event_status(events: DataFrame, outcomes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per event: ``applied``, ``zero_rows`` or ``error`` from its own outcome (where it was run
    alone) or its segment's (``keep``: event columns carried along)."""
    alone = outcomes.where(F.col("segment").startswith("event:")).select(
        *ROW, F.col("segment").alias("_event"), F.col("outcome").alias("_outcome"),
        F.col("error").alias("_error"))
    j = join_small(events.withColumn("_event", _event_segment()),
                   outcomes, on=[*ROW, "segment"], how="left")
    j = join_small(j, alone, on=[*ROW, "_event"], how="left") \
        .withColumn("error", F.when(F.col("_outcome").isNull(), F.col("error"))
                    .otherwise(F.col("_error"))) \
        .withColumn("outcome", F.coalesce("_outcome", "outcome"))
    status = (F.when(F.col("segment") == "duplicate", F.lit("error"))
               .otherwise(F.col("outcome")))
    reason = (F.when(F.col("segment") == "duplicate", F.lit("duplicate_key"))
               .when(F.col("outcome") == "error", F.col("error"))
               .when(F.col("outcome") == "zero_rows", F.lit("no_matching_row")))
    return j.select(*apply.EVENT_ID, F.lit(0).alias("attempt"), status.alias("status"),
                    reason.alias("reason"), *keep)
