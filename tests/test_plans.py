"""Plan shapes that the scale design relies on (read from explain output)."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_wordcount_deny_list_is_broadcast_below_partial_aggregate(spark):
    p = _plan(spark, "wordcount_documents")
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert "partial_count" in p
    # the anti join sits below the partial aggregate: filtered before the shuffle
    assert p.index("partial_count") < p.index("BroadcastHashJoin")
    assert "ReadSchema: struct<text:string>" in p


def test_report_is_not_gathered_or_cut(spark):
    p = _plan(spark, "batch_report")
    assert "collect_list" not in p and "Limit" not in p


@pytest.mark.parametrize("name", ["cdc_statements", "cdc_rejects", "cdc_apply_status"])
def test_map_work_is_not_duplicated_into_filters(spark, name):
    p = _plan(spark, name)
    for line in p.splitlines():
        if "Filter " in line:
            assert "lambdafunction" not in line, line[:200]


def test_fold_is_a_partial_aggregate(spark):
    p = _plan(spark, "cdc_final_state")
    assert "partial_max_by" in p


@pytest.mark.parametrize("name,schema", [
    ("decode_text_json", "struct<event_id:bigint,user_id:bigint,props:string>"),
    ("camel_to_snake", "struct<c_custkey:bigint,c_name:string>"),
])
def test_scans_read_only_needed_columns(spark, name, schema):
    assert f"ReadSchema: {schema}" in _plan(spark, name)


def test_scale_conf():
    from tidewater.session import scale_conf

    small = scale_conf(input_bytes=100 << 20, total_cores=8)
    big = scale_conf(input_bytes=100 << 40, total_cores=3000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) >= 100_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
