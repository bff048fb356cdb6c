"""Typed cells and column names of change events.

A cell is text ``"<Type>:<value>"``. Two readings are offered:

* ``full`` (default): the value is everything after the first ``:``.
* ``first_segment``: the value is only the text between the first and the
  second ``:``, as a ``split(":")[1]`` reads it (``Date:2020-01-01 10:20:30``
  gives ``2020-01-01 10``).

In both a blank value (only characters <= U+0020, the rule of Java's
``String.trim``) means "no value" and the cell is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type tags whose value is written as a quoted SQL string.
QUOTED_TAGS = ("String", "Date", "Character")
# Fixed value: the cell name that is never written.
EXCLUDED_COLUMN = "id"

# \z, not $: a Java "$" also matches before a final line terminator.
_BLANK = r"^[\x00-\x20]*\z"
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*\z"

MODES = ("full", "first_segment")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for null or text made only of characters <= U+0020."""
    c = _col(c)
    return c.isNull() | c.rlike(_BLANK)


def cell_type(cell: Column | str) -> Column:
    """Type tag: the text before the first ``:`` (null when there is none)."""
    cell = _col(cell)
    return F.when(F.instr(cell, ":") > 0, F.substring_index(cell, ":", 1))


def raw_value(cell: Column | str, mode: str = "full") -> Column:
    """The text that ``mode`` reads as a typed cell's value, blank or not."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    cell = _col(cell)
    if mode == "full":
        pos = F.instr(cell, ":")
        return F.when(pos > 0, F.substr(cell, pos + 1))
    return F.try_element_at(F.split(cell, ":"), F.lit(2))


def cell_value(cell: Column | str, mode: str = "full") -> Column:
    """Raw value of a typed cell, or null when it has none / it is blank (F1)."""
    raw = raw_value(cell, mode)
    return F.when(~is_blank(raw), raw)


def sql_literal(tag: Column, value: Column) -> Column:
    """SQL text of a value: quoted for String / Date / Character, else as is.

    Quotes inside a quoted value are doubled, so the text stays one literal
    (L5); the database sink does not use this text, it binds parameters.
    """
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(value.isNull(), F.lit(None).cast("string")) \
        .when(tag.isin(*QUOTED_TAGS), quoted).otherwise(value)


def cell_literal(cell: Column | str, mode: str = "full") -> Column:
    """SQL literal text of a typed cell, null when it has no value."""
    cell = _col(cell)
    return sql_literal(cell_type(cell), cell_value(cell, mode))


def snake_column(name: Column | str) -> Column:
    """Column name as written to the database (F2).

    Per character: when it equals its upper-case form and is not a decimal
    digit, an ``_`` goes before it; every character is lower-cased.
    ``userName`` -> ``user_name``, ``UserName`` -> ``_user_name``,
    ``user_id`` -> ``user__id``, ``ID`` -> ``_i_d``.
    """
    name = _col(name)

    def one(ch: Column) -> Column:
        marked = (F.upper(ch) == ch) & ~ch.rlike(r"^\p{Nd}$")
        return F.when(marked, F.concat(F.lit("_"), F.lower(ch))).otherwise(F.lower(ch))

    # ASCII names (the usual case): a character equals its upper case form and
    # is no digit exactly when it is not in [a-z0-9]; one codegen'd regex.
    ascii_fast = F.lower(F.regexp_replace(name, "([^a-z0-9])", "_$1"))
    per_char = F.array_join(F.transform(F.split(name, ""), one), "")
    return (F.when(name == "", F.lit("")).when(name.rlike(r"^[\x00-\x7F]*$"), ascii_fast)
             .otherwise(per_char))


def is_identifier(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(IDENTIFIER), F.lit(False))
