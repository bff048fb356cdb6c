"""Routing, validation and rendering edge cases of change events."""

from pyspark.sql import functions as F

from tidewater.operators import changelog

SCHEMA = ("topic string, partition int, offset long, batch_id long, tableName string, "
          "actionType string, columns map<string,string>, where string")


def _prep(spark, rows, **options):
    df = spark.createDataFrame([("t", 0, i, 0) + r for i, r in enumerate(rows)], SCHEMA)
    return {r.offset: r for r in changelog.prepare(df, **options).collect()}


def test_routes_are_exact(spark):
    got = _prep(spark, [("c", "insert", {"custKey": "Long:1"}, ""),
                        ("c", "Insert", {"custKey": "Long:1"}, ""),
                        ("c", "UPDATE", {"v": "Integer:1"}, "cust_key=1"),
                        ("c", "delete", {"v": "Integer:1"}, "cust_key=1"),
                        ("c", None, {"v": "Integer:1"}, "cust_key=1")])
    assert [got[i].route for i in range(5)] == ["insert", "ignored", "ignored", "ignored", "ignored"]
    assert all(got[i].reason is None and got[i].statement is None for i in range(1, 5))


def test_predicates(spark):
    got = _prep(spark, [("c", "update", {"v": "Integer:1"}, "  cust_key =  7  "),
                        ("c", "update", {"v": "Integer:1"}, "cust_key='a''b'"),
                        ("c", "update", {"v": "Integer:1"}, "other_key=7"),
                        ("c", "update", {"v": "Integer:1"}, "cust_key=7 and x=1"),
                        ("c", "update", {"v": "Integer:1"}, "cust_key=-7.5")])
    assert (got[0].key, got[0].reason) == ("7", None)
    assert (got[1].key, got[1].reason) == ("a'b", None)
    assert got[2].reason == "unsupported_predicate" and got[3].reason == "unsupported_predicate"
    assert (got[4].key, got[4].reason) == ("-7.5", None)
    assert got[1].statement == "update c set v=1 where cust_key='a''b'"


def test_rendering_sorts_cells_and_compat_reading(spark):
    got = _prep(spark, [("c", "insert", {"zeta": "String:z", "custKey": "Long:3", "id": "Long:3",
                                         "when": "Date:2020-01-01 10:20:30", "blank": "String:  "}, "")])
    r = got[0]
    assert r.statement == ("insert into c(cust_key,when,zeta) "
                           "values(3,'2020-01-01 10:20:30','z')")
    assert r.statement_compat == "insert into c(cust_key,when,zeta) values(3,'2020-01-01 10','z')"
    assert [c.name for c in r.cells] == ["custKey", "when", "zeta"]


def test_keys_by_table_id_and_and(spark):
    keys = {"acct": ("id", "tenant"), "plain": "id", None: "cust_key"}
    up = {"v": "Integer:1"}
    got = _prep(spark, [
        ("acct", "insert", {"id": "Long:7", "tenant": "Integer:02", "v": "Integer:1"}, ""),
        ("acct", "update", up, "tenant=2 AND  id = 7"),
        ("acct", "update", up, "id=7"),
        ("acct", "update", up, "id=7 and id=8"),
        ("acct", "update", up, "id=7 and tenant=2 and v=1"),
        ("acct", "update", up, "tenant=',' and id='a\\b and c=1'"),
        ("plain", "insert", {"id": "Long:9", "v": "Integer:1"}, ""),
        ("plain", "update", up, "id=9"),
        ("c", "insert", {"custKey": "BigDecimal:7.0", "v": "Integer:1"}, ""),
        ("c", "update", up, "cust_key=007"),
        ("c", "update", up, "cust_key='007'"),
        ("c", "update", up, "cust_key=7 or 1=1"),
        ("plain", "insert", {"id": "Long:9"}, ""),
        ("acct", "insert", {"id": "Long:7", "v": "Integer:1"}, ""),
        ("c", "update", up, "cust_key=-0.0"),
        ("c", "update", up, "cust_key=1x"),
    ], key_column=keys)
    assert [got[i].key for i in (0, 1, 6, 7, 8, 9, 10, 14)] == [
        "7,2", "7,2", "9", "9", "7", "7", "007", "0"]
    assert got[5].key == r"a\\b and c=1,\,"
    assert all(got[i].reason is None for i in (0, 1, 5, 6, 7, 8, 9, 10, 14))
    assert [got[i].reason for i in (2, 3, 4, 11, 12, 13, 15)] == [
        "unsupported_predicate"] * 4 + ["no_columns", "missing_key", "unsupported_predicate"]
    assert got[0].statement == "insert into acct(tenant,v) values(02,1)"


def test_undecodable_records_are_rejected(spark):
    df = spark.createDataFrame([("t", 0, 1, 0, None, None, None, None, True),
                                ("t", 0, 2, 0, "c", "insert", {"custKey": "Long:1"}, "", False)],
                               SCHEMA + ", undecodable boolean")
    got = {r.offset: (r.route, r.reason) for r in changelog.prepare(df).collect()}
    assert got == {1: ("undecodable", "undecodable"), 2: ("insert", None)}


def test_a_cell_is_evaluated_once_per_step(spark):
    """The number of places that mention the map or a value: each is evaluated by itself in a lambda."""
    assert str(changelog.number_text(F.col("zz"))).count("zz") == 1
    numbers = ["007", "-0", "-0.00", "1.500", "10.0", "0.05", "100", "-00.10"]
    df = spark.createDataFrame([(n,) for n in numbers], "v string")
    assert [r[0] for r in df.select(changelog.number_text(F.col("v"))).collect()] == [
        "7", "0", "0", "1.5", "10", "0.05", "100", "-0.1"]
