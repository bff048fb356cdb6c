"""Redelivered records (R6) and the versioned target (2.13)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import apply, dedup
from tidewater.sinks.consumed import ConsumedOffsets
from tidewater.sinks.versioned import VersionedTarget
from tidewater.streaming.cdc_job import TARGET, CdcApplyJob

PLACES = "topic string, partition int, offset long"


def places(spark, rows):
    return spark.createDataFrame(rows, PLACES)


def spans(df):
    return {(r.topic, r.partition, r.bin): [(x.lo, x.hi) for x in r.runs] for r in df.collect()}


def test_runs_of_offsets(spark):
    df = places(spark, [("t", 0, o) for o in (5, 6, 7, 7, 9, 4095, 4096, 4097)] + [("t", 1, 5)])
    runs = dedup.consumed_runs(df)
    assert spans(runs) == {("t", 0, 0): [(5, 8), (9, 10), (4095, 4096)], ("t", 0, 1): [(4096, 4098)], ("t", 1, 0): [(5, 6)]}
    more = dedup.consumed_runs(places(spark, [("t", 0, 8), ("t", 0, 4), ("t", 0, 20)]))
    assert spans(dedup.merged_runs(runs.unionByName(more)))["t", 0, 0] == [(4, 10), (20, 21), (4095, 4096)]
    assert dedup.touched(df) == (0, 1) and dedup.touched(df.limit(0)) is None


def test_each_record_is_taken_once(spark, workdir):
    """Random batches with repeats, late offsets and replays, against a set."""
    rng = random.Random(11)
    job, seen = ConsumedOffsets(spark, f"{workdir}/consumed", compact_every=3), set()
    for epoch in range(8):
        rows = [("t", rng.randrange(2), rng.randrange(4090, 4140)) for _ in range(25)]
        want = set(rows) - seen
        for _ in range(2 if epoch % 3 == 1 else 1):     # a replay of the epoch sees the same
            got = [tuple(r) for r in job.unseen(places(spark, rows), epoch).collect()]
            assert len(got) == len(set(got)) and set(got) == want
            job.write(places(spark, sorted(want) or [("t", 0, -1)][:0]), epoch)
        seen |= want
    assert os.path.isdir(f"{workdir}/consumed/snapshot/upto=5")
    assert job.unseen(places(spark, []), 8).count() == 0


def cells(spark, rows):
    """Folded cells of [(key, column, value, batch)]."""
    raw = spark.createDataFrame(rows, "key string, column string, value string, batch long")
    ord_ = F.struct(F.col("batch").alias("batch_id"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                    F.col("batch").alias("offset"))
    return apply.fold(raw.select(F.lit("c").alias("table_name"), "key", "column", F.struct(
        F.lit("String").alias("type"), "value", F.struct(F.lit(True).alias("is_update"), ord_.alias("ord")).alias("w"))
        .alias("v")))


def held(df):
    return {(r.key, r.column): r.value for r in df.collect()}


def test_versions_compaction_and_replay(spark, workdir):
    target = VersionedTarget(spark, f"{workdir}/t", TARGET, buckets=3, max_deltas=2)
    assert held(target.read()) == {}
    state, after = {}, {}
    rng = random.Random(12)
    for v in range(7):
        batch = {(f"k{rng.randrange(9)}", rng.choice("ab")): f"{v}.{n}" for n in range(4 if v else 12)}
        for _ in range(2 if v == 4 else 1):             # version 4 is written twice
            target.apply(cells(spark, [(*k, x, v) for k, x in batch.items()]), v)
        state |= batch
        after[v] = dict(state)
        deltas = {}
        for b, _, base in target.manifest(v):
            deltas.setdefault(b, []).append(base)
        assert all(d.count(True) <= 1 and d.count(False) <= 2 for d in deltas.values())
    assert target.versions() == list(range(7))
    for v in range(7):
        assert held(target.read(v)) == after[v]         # old versions stay readable
    keys = spark.createDataFrame([("c", "k1"), ("c", "none")], "table_name string, key string")
    assert held(target.lookup(keys)) == {k: x for k, x in state.items() if k[0] == "k1"}
    os.remove(f"{workdir}/t/manifest/v=6/_SUCCESS")     # as if the writer had been lost
    assert held(target.read()) == after[5]
    with pytest.raises(ValueError):
        target.read(6)


def test_a_small_batch_writes_its_buckets_only(spark, workdir):
    target = VersionedTarget(spark, f"{workdir}/t", TARGET, buckets=16)
    target.apply(cells(spark, [(f"k{i}", "a", "x", 0) for i in range(200)]), 0)
    target.apply(cells(spark, [("k1", "a", "y", 1)]), 1)
    assert len([d for d in os.listdir(f"{workdir}/t/data/v=1") if d.startswith("bucket=")]) == 1
    assert len(target.manifest(1)) == 17 and held(target.read())["k1", "a"] == "y"


def test_redelivery_changes_nothing(spark, workdir):
    schema = f"{PLACES}, tableName string, actionType string, columns map<string,string>, `where` string"

    def event(o, action, key, note):
        columns = {"note": f"String:{note}"} | ({"custKey": f"Long:{key}"} if action == "insert" else {})
        return ("t", 0, o, "customer", action, columns, f"cust_key={key}")

    first = [event(0, "insert", 1, "a"), event(1, "update", 1, "b"), event(9, "update", 2, "early")]
    second = [event(5, "insert", 2, "late, and a lower offset"), event(10, "update", 1, "c")]
    job = CdcApplyJob(spark, f"{workdir}/job")
    job.process_batch(spark.createDataFrame(first + first[:2], schema), 0)
    job.process_batch(spark.createDataFrame(first[::-1] + second + second, schema), 1)
    job.process_batch(spark.createDataFrame(first + second, schema), 2)
    job.flush()
    got = sorted((r.offset, r.attempt, r.status) for r in job.status().collect())
    assert got == [(0, 0, "applied"), (1, 0, "applied"), (5, 0, "applied"), (9, 0, "zero_rows"),
                   (9, 1, "applied"), (10, 0, "applied")]
    assert {r.key: r.value for r in job.final_state().where("column = 'note'").collect()} == {"1": "c", "2": "early"}
    assert {r.key: r.value for r in job.target.read(0).where("column = 'note'").collect()} == {"1": "b"}
    assert job.progress().agg(F.sum("records")).first()[0] == 5


def test_progress_of_empty_and_failed_batches(spark, workdir, caplog):
    from tidewater.operators.offsets import batch_ranges
    from tidewater.sinks.progress import write_progress

    ranges = batch_ranges(places(spark, [("t", 0, 3), ("t", 0, 5), ("t", 1, 7)]))
    assert write_progress(ranges, f"{workdir}/p", 0)
    got = spark.read.parquet(f"{workdir}/p/epoch=0").collect()
    assert sorted(map(tuple, got)) == [("t", 0, 3, 6, 2), ("t", 1, 7, 8, 1)]
    assert not write_progress(batch_ranges(places(spark, [])), f"{workdir}/p", 1)
    assert "empty batch" in caplog.text and not os.path.exists(f"{workdir}/p/epoch=1")
    with open(f"{workdir}/file", "w"):
        pass
    with pytest.raises(Exception):
        write_progress(ranges, f"{workdir}/file", 2)
    assert not write_progress(ranges, f"{workdir}/file", 2, on_error="log")
    assert "not committed" in caplog.text
    with pytest.raises(ValueError):
        write_progress(ranges, f"{workdir}/p", 3, on_error="ignore")


def test_a_batch_caches_nothing(spark, workdir, monkeypatch):
    """What a batch makes is in a working folder while it is read, and the next batch takes its place."""
    cached = []
    write = VersionedTarget.apply
    monkeypatch.setattr(VersionedTarget, "apply", lambda self, some, version: (cached.append(
        spark.sparkContext._jsc.getPersistentRDDs().size() - before), write(self, some, version)))
    job = CdcApplyJob(spark, f"{workdir}/job")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    schema = ("topic string, partition int, offset long, tableName string, actionType string, "
              "columns map<string,string>, where string")

    def insert(o):
        return "t", 0, o, "customer", "insert", {"custKey": f"Long:{o}", "note": "String:x"}, ""

    for epoch in range(3):
        rows = [insert(o) for o in range(10 * epoch, 10 * epoch + 10 - epoch)]
        job.process_batch(spark.createDataFrame(rows, schema), epoch)
        for name in ("prepared", "outcomes"):
            assert spark.read.parquet(f"{job.out}/work/{name}").count() == 10 - epoch
    assert cached == [0, 0, 0]
    assert job.status().groupBy("status").count().collect() == [("applied", 27)]
    assert job.final_state().count() == 54
