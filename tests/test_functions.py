"""Function tables: inputs and expected outputs."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions.cells import cell_literal, cell_value, is_blank, snake_column
from tidewater.functions.text import split_lines, split_words

# Java Pattern.compile(" ").split(s)
WORDS = [
    ("", [""]), ("a", ["a"]), (" a", ["", "a"]), ("a  b ", ["a", "", "b"]),
    ("   ", []), (" ", []), ("a b   ", ["a", "b"]), ("tab\tx y", ["tab\tx", "y"]),
]

NAMES = [
    ("userName", "user_name"), ("UserName", "_user_name"), ("user_id", "user__id"),
    ("ID", "_i_d"), ("col1Name", "col1_name"), ("a$b", "a_$b"), ("x", "x"), ("", ""),
]

# cell -> (first-segment literal, full literal)
CELLS = [
    ("String:abc", "'abc'", "'abc'"), ("String:", None, None), ("String: ", None, None),
    ("String:a:b", "'a'", "'a:b'"),
    ("Date:2020-01-01 10:20:30", "'2020-01-01 10'", "'2020-01-01 10:20:30'"),
    ("Integer:5", "5", "5"), (":x", "x", "x"), ("abc", None, None), ("", None, None),
    ("Long::7", None, ":7"), ("Character:y", "'y'", "'y'"), (":", None, None),
    ("::", None, ":"), ("String:o'brien", "'o''brien'", "'o''brien'"),
]

LINES = [
    ("", []), ("a", ["a"]), ("a\n", ["a"]), ("a\n\n", ["a", ""]), ("\n", [""]),
    ("a\nb", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]),
]


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_split_words_equals_java(spark):
    got = _one(spark, [(s,) for s, _ in WORDS], "s string", split_words("s"))
    assert got == [w for _, w in WORDS]


def test_split_words_matches_jvm_directly(spark):
    pat = spark.sparkContext._jvm.java.util.regex.Pattern.compile(" ")
    got = _one(spark, [(s,) for s, _ in WORDS], "s string", split_words("s"))
    assert got == [list(pat.split(s)) for s, _ in WORDS]


def test_split_lines(spark):
    got = _one(spark, [(s,) for s, _ in LINES], "s string", split_lines("s"))
    assert got == [w for _, w in LINES]


def test_snake_column(spark):
    got = _one(spark, [(s,) for s, _ in NAMES], "s string", snake_column("s"))
    assert got == [w for _, w in NAMES]


@pytest.mark.parametrize("mode,idx", [("first_segment", 1), ("full", 2)])
def test_cell_literal(spark, mode, idx):
    got = _one(spark, [(c[0],) for c in CELLS], "s string", cell_literal("s", mode))
    assert got == [c[idx] for c in CELLS]


def test_blank_is_java_trim(spark):
    rows = [(" \t\n",), ("\x01",), (" a ",), (None,), (" ",)]
    assert _one(spark, rows, "s string", is_blank("s")) == [True, True, False, True, False]


def test_cell_value_rejects_unknown_mode():
    with pytest.raises(ValueError):
        cell_value(F.col("x"), "bogus")


def test_identifier_rejects_trailing_newline(spark):
    from tidewater.functions.cells import is_identifier

    rows = [("customer",), ("customer\n",), ("t; drop",), ("_a1",), ("1a",), (None,)]
    assert _one(spark, rows, "s string", is_identifier("s")) == [True, False, False, True, False, False]


def test_only_java_blanks_are_blank(spark):
    from tidewater.functions.cells import is_blank

    rows = [("",), ("  \t\n\r\x00",), ("\u0085",), ("\u2028",), ("\u2029",), (" \u2028",), ("a\n",)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(is_blank("v")).collect()]
    assert got == [True, True, False, False, False, False, False]
