"""The second chance of zero-row updates on a clock, in keyed state."""

import time

import pandas as pd
from pyspark.sql import functions as F

from tidewater.streaming.timed_job import _IN, SecondChance, TimedApplyJob

SCHEMA = ("topic string, partition int, offset long, tableName string, actionType string, "
          "columns map<string,string>, `where` string")


def land(spark, path, rows):
    """Events of [(offset, action, key, note)]; the key column is cust_key."""
    out = [("t", 0, o, "customer", action, {"custKey": f"Long:{k}", "note": f"String:{note}"} if action == "insert"
            else {"note": f"String:{note}"}, f"cust_key={k}") for o, action, k, note in rows]
    spark.createDataFrame(out, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).parquet(path)


def until(what, seconds=90):
    end = time.time() + seconds
    while True:
        try:
            if what():
                return
        except Exception:       # a replayed epoch replaces its files while we read
            pass
        assert time.time() < end, "did not happen"
        time.sleep(.5)


def statuses(job):
    return sorted((r.offset, r.attempt, r.status, r.reason) for r in job.status().collect())


def notes(job):
    return {(r.key): r.value for r in job.final_state().where(F.col("column") == "note").collect()}


def test_late_parent_in_time_and_too_late(spark, workdir):
    land(spark, f"{workdir}/in", [(0, "insert", 1, "a"), (1, "update", 1, "b"), (2, "update", 2, "early"),
                                  (3, "update", 3, "never"), (4, "insert", 1, "again"), (5, "delete", 1, "x"),
                                  (6, "update", 4, "before"), (7, "insert", 4, "own"), (8, "update", 4, "after")])
    job = TimedApplyJob(spark, f"{workdir}/job", interval=15)
    q = job.start(stream(spark, f"{workdir}/in"), {"processingTime": "1 second"})
    first = [(0, 0, "applied", None), (1, 0, "applied", None), (2, 0, "zero_rows", "no_matching_row"),
             (3, 0, "zero_rows", "no_matching_row"), (4, 0, "error", "duplicate_key"), (5, 0, "ignored", None),
             (6, 0, "zero_rows", "no_matching_row"), (7, 0, "applied", None), (8, 0, "applied", None)]
    until(lambda: len(statuses(job)) >= 9)
    assert statuses(job) == first
    q.stop()                                            # state and timers are in the checkpoint
    job = TimedApplyJob(spark, f"{workdir}/job", interval=15)
    land(spark, f"{workdir}/in", [(9, "insert", 2, "parent")])
    q = job.start(stream(spark, f"{workdir}/in"), {"processingTime": "1 second"})
    # No further batch of events comes: the clock alone retries.
    until(lambda: sum(s[1] == 1 for s in statuses(job)) == 3)
    land(spark, f"{workdir}/in", [(10, "insert", 3, "too late")])
    until(lambda: any(s[0] == 10 for s in statuses(job)))
    q.stop()
    assert q.exception() is None
    assert statuses(job) == sorted(first + [
        (9, 0, "applied", None), (2, 1, "applied", None), (3, 1, "dead_letter", "zero_rows_after_retry"),
        (6, 1, "applied", None), (10, 0, "applied", None)], key=lambda s: s[:2])
    # A late update overrides its late insert, but no newer update.
    assert notes(job) == {"1": "b", "2": "early", "3": "too late", "4": "after"}
    assert {(r.offset, r.reason) for r in job.dead_letters().collect()} == {
        (4, "duplicate_key"), (3, "zero_rows_after_retry")}
    got = job.progress().agg(F.min("from_offset"), F.max("until_offset"), F.sum("records")).first()
    assert tuple(got) == (0, 11, 11)


class MapState(dict):
    containsKey = dict.__contains__
    getValue = dict.__getitem__
    updateValue = dict.__setitem__
    removeKey = dict.__delitem__


class Handle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, MapState())

    def registerTimer(self, due):
        self.timers.append(due)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


def test_one_call_serves_the_keys_of_a_bucket_in_chunks():
    """Many keys per call, frames and chunks of bounded size, timers that read only their own chunks."""
    def batch(rows):
        return pd.DataFrame([("t", 0, o, None, None, f"s{o}", "customer", k, action, f"c{o}")
                             for o, action, k in rows], columns=_IN)

    def run(frames):
        frames = list(frames)
        assert all(len(f) <= 2 for f in frames)
        return sorted((r.offset, r.key, r.attempt, r.status, r.cells) for f in frames for r in f.itertuples())

    handle, job = Handle(), SecondChance(1.0, chunk=2)
    job.init(handle)
    got = run(job.handleInputRows((7,), iter([
        batch([(1, "update", "a"), (2, "update", "b"), (9, "update", "b"), (3, "update", "a")]),
        batch([(6, "insert", "b"), (5, "insert", "b"), (4, "update", "c"), (8, "insert", "b")])]), Clock(0)))
    assert got == [(1, "a", 0, "zero_rows", None), (2, "b", 0, "zero_rows", None), (3, "a", 0, "zero_rows", None),
                   (4, "c", 0, "zero_rows", None), (5, "b", 0, "applied", "c5"), (6, "b", 0, "error", None),
                   (8, "b", 0, "error", None), (9, "b", 0, "applied", "c9")]
    got = run(job.handleInputRows((7,), iter([batch([(10, "insert", "a"), (11, "update", "d"),
                                                     (12, "update", "b"), (13, "insert", "b")])]), Clock(400)))
    assert got == [(10, "a", 0, "applied", "c10"), (11, "d", 0, "zero_rows", None), (12, "b", 0, "applied", "c12"),
                   (13, "b", 0, "error", None)]
    assert handle.timers == [1000, 1400]
    assert run(job.handleExpiredTimer((7,), None, Clock(1000))) == [
        (1, "a", 1, "applied", "c1"), (2, "b", 1, "applied", "c2"), (3, "a", 1, "applied", "c3"),
        (4, "c", 1, "dead_letter", None)]
    assert run(job.handleExpiredTimer((7,), None, Clock(1400))) == [(11, "d", 1, "dead_letter", None)]
    assert not handle.maps["waiting"] and not handle.maps["chunks"]
    assert sorted(handle.maps["first"]) == [("customer", "a"), ("customer", "b")]
