"""Every registered query against its DuckDB oracle.

Runs on sf0.001 (fast); ``tools/check_oracle.py`` runs the same on sf0.01.
"""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tidewater.plans import registry
from tidewater.sources.tables import TABLES
from tools.check_oracle import digest

NAMES = sorted(registry.queries())
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    s_cols, s_n, s_h, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(entry_mod.oracle_sql()[name])
    o_cols, o_n, o_h, _ = digest(rel.columns, rel.fetchall())
    assert (s_cols, s_n) == (o_cols, o_n)
    assert s_h == o_h
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["word", "cnt"]
    assert df.count() > 0
