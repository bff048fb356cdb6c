"""The record log as a streaming source: bounds, policies, caps, restarts."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import offsets
from tidewater.plans import log_queries
from tidewater.sinks.tables import read_table, write_epoch
from tidewater.sources import log
from tidewater.streaming.runner import start

SCHEMA = ("key binary, value binary, topic string, partition int, offset long, timestamp timestamp, "
          "timestampType int")
PROGRESS = "topic string, partition int, from_offset long, until_offset long, records long, epoch long"


def records(spark, rows):
    """Records of [(topic, partition, offset)] whose value names them."""
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    return df.select(F.lit(None).cast("binary").alias("key"),
                     F.encode(F.concat_ws("/", "topic", "partition", "offset"), "UTF-8").alias("value"),
                     "topic", "partition", "offset", F.timestamp_seconds("offset").alias("timestamp"),
                     F.lit(0).alias("timestampType"))


def follow(spark, workdir, **options):
    """Run the query until the log is consumed; {epoch: {(topic, partition): (from, until, n)}}."""
    stream = log.log_stream(spark, f"{workdir}/log", f"{workdir}/ck", **options)

    def keep(df, epoch):
        write_epoch(df.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"),
                              "timestamp"), f"{workdir}/rows", epoch)
        write_epoch(offsets.batch_ranges(df), f"{workdir}/progress", epoch)

    log.drain(start(stream, keep, f"{workdir}/ck", {"processingTime": "0 seconds"}))
    out = {}
    for r in read_table(spark, f"{workdir}/progress", PROGRESS).collect():
        out.setdefault(r.epoch, {})[r.topic, r.partition] = (r.from_offset, r.until_offset, r.records)
    return out


@pytest.mark.parametrize("policy", offsets.POLICIES)
def test_number_and_column_policies_agree(spark, policy):
    cases = list(itertools.product([None, 0, 3, 5, 9, 12, 20], [(None, None), (5, 12), (0, 1)], [True, False]))
    cases = [(c, *b, any_) for c, b, any_ in cases if any_ or c is None]
    df = spark.createDataFrame(cases, "committed long, earliest long, latest long, any_commit boolean")
    got = df.select("committed", "earliest", "latest", "any_commit", F.coalesce(offsets.start_offset(
        policy, F.col("committed"), F.col("earliest"), F.col("latest")), "committed", F.lit(0)).alias("s"))
    for c, e, l, any_, s in got.where("earliest is not null").collect():
        assert offsets.start_at(policy, c, e, l, any_) == s, (c, e, l, any_)
    assert offsets.start_at(policy, 7, None, None, True) == 7
    assert offsets.start_at(policy, None, None, None, False) == 0


def test_caps_gaps_and_restart(spark, workdir):
    """A long partition takes its cap per batch, a short one ends early, a gap costs no batch."""
    rows = [("t", 0, o) for o in range(25)] + [("t", 1, o) for o in (0, 1, 1000, 1001, 1002)] + [("u", 0, 7)]
    log.append(records(spark, [r for r in rows if r[2] < 1000]), f"{workdir}/log")
    log.append(records(spark, [r for r in rows if r[2] >= 1000]), f"{workdir}/log")
    got = follow(spark, workdir, policy="zero", cap=10)
    assert got == {0: {("t", 0): (0, 10, 10), ("t", 1): (0, 2, 2), ("u", 0): (7, 8, 1)},
                   1: {("t", 0): (10, 20, 10), ("t", 1): (1000, 1003, 3)}, 2: {("t", 0): (20, 25, 5)}}
    # Restart: only what is new, a partition that did not exist from its first record.
    log.append(records(spark, [("t", 0, 25), ("t", 2, 50), ("t", 2, 51)]), f"{workdir}/log")
    got = follow(spark, workdir, policy="latest", cap=10)
    assert got[3] == {("t", 0): (25, 26, 1), ("t", 2): (50, 52, 2)} and max(got) == 3
    seen = read_table(spark, f"{workdir}/rows", "topic string, partition int, offset long, value string, "
                                                "timestamp timestamp, epoch long").collect()
    assert sorted((r.topic, r.partition, r.offset) for r in seen) == sorted(
        rows + [("t", 0, 25), ("t", 2, 50), ("t", 2, 51)])
    assert all(r.value == f"{r.topic}/{r.partition}/{r.offset}" and r.timestamp.timestamp() == r.offset
               for r in seen)


def test_a_batch_that_failed_runs_again_as_planned(spark, workdir):
    log.append(records(spark, [("t", 0, o) for o in range(9)]), f"{workdir}/log")
    tried = []

    def failing(df, epoch):
        tried.append((epoch, [r.offset for r in df.select("offset").orderBy("offset").collect()]))
        if len(tried) == 2:
            raise RuntimeError("lost")

    def run(process):
        log.drain(start(log.log_stream(spark, f"{workdir}/log", f"{workdir}/ck", cap=4), process,
                        f"{workdir}/ck", {"processingTime": "0 seconds"}))

    with pytest.raises(Exception, match="lost"):
        run(failing)
    log.append(records(spark, [("t", 0, 9)]), f"{workdir}/log")
    run(failing)
    assert tried == [(0, [0, 1, 2, 3]), (1, [4, 5, 6, 7]), (1, [4, 5, 6, 7]), (2, [8, 9])]


def test_start_from_commits_and_topics(spark, workdir):
    log.append(records(spark, [("t", 0, o) for o in range(5, 20)] + [("u", 0, o) for o in range(5)]),
               f"{workdir}/log")
    commits = spark.createDataFrame([("t", 0, 12), ("t", 1, 3), ("u", 0, 4)],
                                    "topic string, partition int, committed long")
    got = follow(spark, workdir, policy="resume_earliest", committed=commits, topics=("t",))
    assert got == {0: {("t", 0): (12, 20, 8)}}


def test_unfinished_segments_and_retention(spark, workdir):
    path = f"{workdir}/log"
    for part in (range(4), range(4, 8), range(8, 10)):
        log.append(records(spark, [("a b/c", 0, o) for o in part]), path)
    first, _, last = sorted(os.listdir(path))
    index = log.LogIndex(path)
    assert log.bounds(index.refresh()) == {("a b/c", 0): (0, 10)}
    os.remove(f"{path}/{last}/_SUCCESS")            # as while the write is still going on
    assert log.bounds(log.LogIndex(path).refresh()) == {("a b/c", 0): (0, 8)}
    os.rename(f"{path}/{first}", f"{workdir}/{first}")
    assert log.bounds(log.LogIndex(path).refresh()) == {("a b/c", 0): (4, 8)}
    assert log.LogIndex(f"{workdir}/none").refresh() == []


def test_rounds_take_the_same_batches_at_once(spark, workdir):
    """Several batches in one micro-batch: each within its cap, numbered by round, small row groups."""
    import pyarrow.parquet as pq

    rows = [("t", 0, o) for o in range(25)] + [("t", 1, o) for o in (0, 1, 1000, 1001, 1002)] + [("u", 0, 7)]
    log.append(records(spark, [r for r in rows if r[2] < 1000]), f"{workdir}/log")
    log.append(records(spark, [r for r in rows if r[2] >= 1000]), f"{workdir}/log")
    got = log_queries.follow(spark, f"{workdir}/log", workdir, rounds=2, policy="zero", cap=10)
    seen = {(r.epoch, r.batch_id, r.topic, r.partition): (r.from_offset, r.until_offset, r.records)
            for r in got.collect()}
    assert seen == {(0, 0, "t", 0): (0, 10, 10), (0, 0, "t", 1): (0, 2, 2), (0, 0, "u", 0): (7, 8, 1),
                    (0, 1, "t", 0): (10, 20, 10), (0, 1, "t", 1): (1000, 1003, 3), (1, 2, "t", 0): (20, 25, 5)}
    log.append(records(spark, [("v", 0, o) for o in range(log.ROW_GROUP * 2 + 1)]), f"{workdir}/big")
    sizes = [meta.row_group(g).num_rows for f in log.LogIndex(f"{workdir}/big").refresh()
             for meta in [pq.ParquetFile(f.path).metadata] for g in range(meta.num_row_groups)]
    assert sum(sizes) == log.ROW_GROUP * 2 + 1 and max(sizes) <= log.ROW_GROUP


def test_a_file_is_read_a_row_group_at_a_time(spark, workdir):
    n = 2 * log.ROW_GROUP + 5
    offsets_ = spark.range(n).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    rows = offsets_.select(F.lit(None).cast("binary").alias("key"), F.lit(b"v").alias("value"), "topic", "partition",
                           "offset", F.timestamp_seconds("offset").alias("timestamp"), F.lit(0).alias("timestampType"))
    rows.coalesce(1).write.partitionBy("topic", "partition").parquet(f"{workdir}/log/segment=0")
    reader = log.LogStreamReader({"path": f"{workdir}/log"})
    sizes, got = [], 0
    for part in reader.partitions(reader.initialOffset(), reader.latestOffset()):
        for b in reader.read(part):
            sizes.append(b.num_rows)
            got += sum(b.column("offset").to_pylist())
    assert max(sizes) <= log.ROW_GROUP and sum(sizes) == n and got == n * (n - 1) // 2
