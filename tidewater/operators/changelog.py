"""Change events -> routed, validated, rendered statements.

An event is ``(tableName, actionType, columns MAP<STRING,STRING>, where)``.
Everything is a per-row projection (higher-order functions over the map), so
no step shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.cells import (EXCLUDED_COLUMN, IDENTIFIER, QUOTED_TAGS, cell_type,
                                       cell_value, is_blank, is_identifier, raw_value,
                                       snake_column, sql_literal)
from tidewater.functions.text import fill

# The two actions that produce a statement, and the statement
# formats (lists joined by ",", no spaces).
INSERT, UPDATE, IGNORED = "insert", "update", "ignored"
INSERT_FORMAT = "insert into {table}({columns}) values({values})"
UPDATE_FORMAT = "update {table} set {assignments} where {where}"
ASSIGNMENT_FORMAT = "{column}={value}"
LIST_SEPARATOR = ","

# Accepted update predicate: <column> = <number or quoted string>, and more of
# them joined by "and".
_TERM = (r"([A-Za-z_][A-Za-z0-9_]*)\s*=\s*"
         r"(-?[0-9]+(?:\.[0-9]+)?(?![A-Za-z0-9_.])|'(?:[^']|'')*')")
_PLAIN = _TERM.replace("([A-Za-z_]", "(?:[A-Za-z_]").replace("(-?", "(?:-?")
PREDICATE = rf"^\s*{_PLAIN}(?:\s+(?i:and)\s+{_PLAIN})*\s*\z"
_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"

#: Key columns of a table: one name, several, or a table of them by table name,
#: where the entry None holds for all others.
KeyColumns = str | tuple[str, ...] | dict[str | None, str | tuple[str, ...]]
DEFAULT_KEY = "cust_key"

REJECT_REASONS = ("undecodable", "bad_identifier", "no_columns", "missing_key", "missing_where",
                  "unsupported_predicate")
# The route of a record that could not be decoded (``events.undecodable``).
UNDECODABLE = "undecodable"


def route(action: Column | str = "actionType") -> Column:
    """``insert`` / ``update`` for exactly those texts, else ``ignored``."""
    a = F.col(action) if isinstance(action, str) else action
    return (F.when(a == INSERT, F.lit(INSERT)).when(a == UPDATE, F.lit(UPDATE))
             .otherwise(F.lit(IGNORED)))


def key_columns(keys: KeyColumns, table: str | None) -> tuple[str, ...]:
    """The key columns of one table."""
    if isinstance(keys, dict):
        keys = keys.get(table, keys.get(None, DEFAULT_KEY))
    return (keys,) if isinstance(keys, str) else tuple(keys)


def key_names(keys: KeyColumns, table: Column) -> Column:
    """array<string> of the key columns of each row's table."""
    def names(t: str | None) -> Column:
        return F.array(*[F.lit(c) for c in key_columns(keys, t)])

    out = names(None)
    for t in (keys if isinstance(keys, dict) else ()):
        if t is not None:
            out = F.when(table == t, names(t)).otherwise(out)
    return out


def key_text(values: Column) -> Column:
    """One text for the values of a key: the value itself, or for several all of them with
    ``\\`` and ``,`` escaped, joined by ``,``. Null if one is null."""
    escaped = F.transform(values, lambda v: F.regexp_replace(v, r"([\\,])", r"\\$1"))
    return F.when(F.size(values) == 1, F.get(values, F.lit(0))) \
        .when(F.exists(values, lambda v: v.isNull()), F.lit(None).cast("string")) \
        .otherwise(F.array_join(escaped, ","))


def number_text(v: Column) -> Column:
    """A number written one way: no leading zeros, no trailing zeros of a fraction (007 is 7).
    One replacement within the other, so that ``v`` is evaluated once."""
    v = F.regexp_replace(v, r"^(-?)0+(?=[0-9])", "$1")
    v = F.regexp_replace(v, r"(\.[0-9]*[1-9])0+\z|\.0+\z", "$1")
    return F.regexp_replace(v, r"^-0\z", "0")


def all_cells(columns: Column | str = "columns", mode: str = "full") -> Column:
    """array<struct<name, column, type, value, literal>> of the cells with a value, sorted by
    name; no-value cells are dropped (C3). A step reads the fields of the one before, as a
    lambda evaluates an expression once for each place it stands in."""
    m = F.col(columns) if isinstance(columns, str) else columns
    entries = F.sort_array(F.map_entries(m))   # by key; no comparator lambda
    raw = F.transform(entries, lambda e: F.struct(
        e["key"].alias("name"), e["value"].alias("cell"), raw_value(e["value"], mode).alias("raw")))
    valued = F.filter(raw, lambda e: ~is_blank(e["raw"]))
    typed = F.transform(valued, lambda e: F.struct(
        e["name"].alias("name"), cell_type(e["cell"]).alias("type"), e["raw"].alias("value")))
    return F.transform(typed, lambda c: F.struct(
        c["name"].alias("name"), snake_column(c["name"]).alias("column"), c["type"].alias("type"),
        c["value"].alias("value"), sql_literal(c["type"], c["value"]).alias("literal")))


def kept_cells(columns: Column | str = "columns", mode: str = "full") -> Column:
    """The cells that are written: ``all_cells`` without ``id``."""
    return _written(all_cells(columns, mode))


def _written(cells: Column) -> Column:
    return F.filter(cells, lambda c: c["name"] != EXCLUDED_COLUMN)


def _render(table: Column, rt: Column, where: Column, kept: Column) -> Column:
    cols = F.array_join(F.transform(kept, lambda c: c["column"]), LIST_SEPARATOR)
    vals = F.array_join(F.transform(kept, lambda c: c["literal"]), LIST_SEPARATOR)
    sets = F.array_join(F.transform(
        kept, lambda c: fill(ASSIGNMENT_FORMAT, column=c["column"], value=c["literal"])),
        LIST_SEPARATOR)
    ins = fill(INSERT_FORMAT, table=table, columns=cols, values=vals)
    upd = fill(UPDATE_FORMAT, table=table, assignments=sets, where=where)
    has = F.size(kept) > 0
    return (F.when((rt == INSERT) & has, ins)
             .when((rt == UPDATE) & has & ~is_blank(where), upd))


def _first_segment(c: Column) -> Column:
    v = F.substring_index(c["value"], ":", 1)
    v = F.when(~is_blank(v), v)
    return F.struct(c["name"].alias("name"), c["column"].alias("column"), c["type"].alias("type"),
                    v.alias("value"), sql_literal(c["type"], v).alias("literal"))


def _literal_value(lit: Column) -> Column:
    """The value of a predicate's literal: quotes off, numbers written one way."""
    inner = F.regexp_replace(F.regexp_replace(lit, r"^'|'$", ""), "''", "'")
    return F.when(lit.startswith("'"), inner).otherwise(number_text(lit))


def prepare(events: DataFrame, key_column: KeyColumns = DEFAULT_KEY, mode: str = "full",
            compat: bool = True) -> DataFrame:
    """Adds ``route``, ``cells`` (kept cells), ``key`` (row key as text, ``key_text``),
    ``reason`` (null or a reject reason), ``statement`` (rendered SQL text,
    null when rejected or ignored) and, with ``compat``, ``statement_compat``:
    the text rendered with first-segment cell values.

    Rules: a table or column name must be an identifier (L5); an update needs
    a predicate that gives each key column of its table a literal, joined by
    ``and``, and nothing else (L2, L6; never an update without one); insert
    and update need at least one written cell (L2); an insert must carry the
    key columns (``id`` may be one: it is not written, but it identifies the
    row). Numbers in keys are compared by value. A record that could not be
    decoded (``undecodable`` true, where the events have that column) is
    rejected.

    Each step is a projection over columns of the step before, so that nothing is evaluated
    once per mention; the result leaves through ``explode`` of a one-element array. The
    Generate is a barrier: a filter on ``reason`` or ``statement`` downstream is not pushed
    below it, so the map work is never evaluated twice (once in a pushed-down filter, once
    in the projection).
    """
    table, where, rt, keys = F.col("tableName"), F.col("where"), F.col("route"), F.col("_keys")
    rts = route("actionType")
    if "undecodable" in events.columns:
        rts = F.when(F.col("undecodable"), F.lit(UNDECODABLE)).otherwise(rts)
    w = F.coalesce(where, F.lit(""))
    base = events.withColumns({
        "route": rts, "_table_ok": is_identifier(table), "_where_blank": is_blank(where),
        "_keys": key_names(key_column, table), "_terms": w.rlike(PREDICATE),
        "_all": all_cells("columns", mode)})
    if compat and mode != "full":
        base = base.withColumn("_first", kept_cells("columns", "first_segment"))

    cells, terms, update = F.col("_cells"), F.col("_terms"), rt == UPDATE
    base = base.withColumns({
        "_cells": _written(F.col("_all")),
        "_names": F.when(terms & update, F.regexp_extract_all(w, F.lit(_TERM), F.lit(1))),
        "_literals": F.when(terms & update, F.regexp_extract_all(w, F.lit(_TERM), F.lit(2))),
        # The cell of each key column, of an insert.
        "_key_cells": F.when(rt == INSERT, F.transform(keys, lambda k: F.get(F.filter(
            F.col("_all"), lambda c: c["column"] == k), 0)))})
    # Every key column once, nothing else.
    parsed = F.coalesce((F.size("_names") == F.size(keys))
                        & (F.size(F.array_except(keys, F.col("_names"))) == 0), F.lit(False))
    base = base.withColumns({
        "_parsed": parsed, "_cols_ok": F.forall(cells, lambda c: c["column"].rlike(IDENTIFIER))})

    def key_value(c: Column) -> Column:
        number = ~c["type"].isin(*QUOTED_TAGS) & c["value"].rlike(_NUMBER)
        return F.when(F.coalesce(number, F.lit(False)), number_text(c["value"])).otherwise(c["value"])

    literals = F.transform(keys, lambda k: F.get("_literals", F.array_position("_names", k).cast("int") - 1))
    parsed = F.col("_parsed")
    base = base.withColumn("_values", F.when(rt == INSERT, F.transform("_key_cells", key_value))
                           .when(update & parsed, F.transform(literals, _literal_value)))
    base = base.withColumn("_key", key_text(F.col("_values")).cast("string"))
    reason = (F.when(rt == UNDECODABLE, F.lit("undecodable"))
               .when(rt == IGNORED, F.lit(None))
               .when(~F.col("_table_ok") | ~F.col("_cols_ok"), F.lit("bad_identifier"))
               .when((rt == INSERT) & (F.size(cells) == 0), F.lit("no_columns"))
               .when((rt == INSERT) & F.col("_key").isNull(), F.lit("missing_key"))
               .when(update & F.col("_where_blank"), F.lit("missing_where"))
               .when(update & ~parsed, F.lit("unsupported_predicate"))
               .when(update & (F.size(cells) == 0), F.lit("no_columns"))
               .cast("string"))
    base = base.withColumn("_reason", reason)
    ok = F.col("_reason").isNull() & (rt != IGNORED)
    base = base.withColumn("_statement", F.when(ok, _render(table, rt, where, cells)))
    fields = [cells.alias("cells"), F.col("_key").alias("key"), F.col("_reason").alias("reason"),
              F.col("_statement").alias("statement")]
    if compat and mode == "full":
        # The first-segment value is the full value up to its first ":" (a prefix: blank full
        # means blank first). Only values with a ":" read differently; otherwise the
        # first-segment text is the statement itself.
        colon = F.exists(cells, lambda c: c["value"].contains(":"))
        base = base.withColumn("_first", F.when(ok & colon, F.filter(
            F.transform(cells, _first_segment), lambda c: c["value"].isNotNull())))
        first = F.col("_first")
        fields.append(F.when(first.isNotNull(), _render(table, rt, where, first))
                       .otherwise(F.col("_statement")).alias("statement_compat"))
    elif compat:
        fields.append(F.when(ok, _render(table, rt, where, F.col("_first"))).alias("statement_compat"))
    return base.select("*", F.explode(F.array(F.struct(*fields))).alias("_p")) \
        .select(*events.columns, "route", "_p.*")


def cells_long(events: DataFrame) -> DataFrame:
    """One row per non-``id`` cell with both value readings (L1)."""
    ex = events.select("topic", "partition", "offset",
                       F.explode("columns").alias("name", "cell"))
    ex = ex.where(F.col("name") != EXCLUDED_COLUMN)
    cell, tag = F.col("cell"), cell_type("cell")
    full, first = cell_value(cell, "full"), cell_value(cell, "first_segment")
    return ex.select("topic", "partition", "offset", "name",
                     snake_column("name").alias("column"), tag.alias("type"),
                     full.alias("value_full"), first.alias("value_first"),
                     sql_literal(tag, full).alias("literal_full"),
                     sql_literal(tag, first).alias("literal_first"))
