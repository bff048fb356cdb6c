"""A key holding a large share of all events is salted over several tasks before anything
is shuffled by the key, and the result is the same."""

from pyspark.sql import functions as F

from tidewater.operators import apply, changelog


def _events(spark, n_hot=3000, n_cold=300):
    hot = (spark.range(n_hot).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.col("id") + 10).alias("offset"),
        F.lit(1).cast("long").alias("batch_id"), F.lit("customer").alias("tableName"),
        F.lit("update").alias("actionType"),
        F.create_map(F.lit("v"), F.concat(F.lit("Integer:"), F.col("id").cast("string"))).alias("columns"),
        F.lit("cust_key=1").alias("where")))
    ins = (spark.range(n_cold).select(
        F.lit("t").alias("topic"), (F.col("id") % 4).cast("int").alias("partition"),
        F.col("id").alias("offset"), F.lit(0).cast("long").alias("batch_id"),
        F.lit("customer").alias("tableName"), F.lit("insert").alias("actionType"),
        F.create_map(F.lit("custKey"), F.concat(F.lit("Long:"), (F.col("id") + 1).cast("string"))).alias("columns"),
        F.lit("").alias("where")))
    return hot.unionByName(ins)


def test_hot_key_is_split_and_result_unchanged(spark):
    ev = _events(spark)
    want = sorted(map(tuple, apply.final_state(changelog.prepare(ev, compat=False)).collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    hot = apply.HOT_KEY_ROWS
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        apply.HOT_KEY_ROWS = 250                # the hot key (3000 events) -> 12 salts
        out = apply.outcomes(changelog.prepare(ev, compat=False))
        got_status = out.groupBy("first_status").count().collect()
        plan_df = out.select("key", "first_status")
        plan_df.collect()                       # runs this Dataset's own plan
        final_plan = plan_df._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, apply.final_state(changelog.prepare(ev, compat=False)).collect()))
    finally:
        apply.HOT_KEY_ROWS = hot
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want
    assert dict(map(tuple, got_status)) == {"applied": 3300}
    # The salts come from a broadcast; the only sort-merge join is on the salted key.
    joins = [x for x in final_plan.splitlines() if "SortMergeJoin" in x]
    assert joins and all("_salt" in x for x in joins)
    moved = [x for x in final_plan.splitlines() if "Exchange hashpartitioning" in x
             and "_salt" not in x]
    # By the raw key only the combined rows of the aggregate are shuffled.
    assert all("ord" not in x for x in moved)
    assert "BroadcastHashJoin" in final_plan
    # the fold keeps only the newest value of the hot key's column
    assert ("customer", "1", "v", "Integer", "2999") in got
