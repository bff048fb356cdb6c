"""DB-API sink against a sqlite3 file."""

import functools
import sqlite3

from pyspark.sql import functions as F

from tidewater.operators import changelog
from tidewater.sinks import dbapi

SCHEMA = ("topic string, partition int, offset long, batch_id long, tableName string, "
          "actionType string, columns map<string,string>, where string")


def _events(spark):
    rows = [
        ("cdc", 0, 1, 0, "customer", "insert", {"custKey": "Long:1", "custName": "String:ann"}, ""),
        ("cdc", 0, 2, 0, "customer", "update", {"acctBal": "BigDecimal:5.00"}, "cust_key=1"),
        ("cdc", 0, 3, 0, "customer", "update", {"acctBal": "BigDecimal:6.00"}, "cust_key=1"),
        ("cdc", 1, 4, 0, "customer", "update", {"acctBal": "BigDecimal:7.00"}, "cust_key=2"),
        ("cdc", 0, 5, 0, "customer", "insert", {"custKey": "Long:1", "custName": "String:dup"}, ""),
        ("cdc", 1, 6, 0, "customer", "update",
         {"custName": "String:o'brien'); drop table customer; --"}, "cust_key=3"),
        ("cdc", 1, 7, 0, "customer", "insert", {"custKey": "Long:3", "custName": "String:cy"}, ""),
        ("cdc", 1, 8, 0, "customer", "insert", {"custKey": "Long:4", "noSuchCol": "String:x"}, ""),
        ("cdc", 1, 9, 0, "customer", "delete", {"custKey": "Long:9"}, "cust_key=9"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _db(path):
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE customer (cust_key TEXT PRIMARY KEY, cust_name TEXT, "
                "acct_bal TEXT, mkt_segment TEXT, last_order_date TEXT, remark TEXT, note TEXT)")
    con.commit()
    con.close()


def test_sqlite_apply_statuses_and_ledger(spark, workdir):
    path = f"{workdir}/target.db"
    _db(path)
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    prepared = changelog.prepare(_events(spark))
    events, work = dbapi.plan(prepared)
    outcomes = dbapi.execute(work, connect, batch_id=0, tasks=2)
    out_rows = sorted(tuple(r) for r in outcomes.collect())
    status = {(r.partition, r.offset): (r.status, r.reason)
              for r in dbapi.event_status(events, spark.createDataFrame(out_rows, dbapi.OUTCOME_SCHEMA)).collect()}
    assert status[(0, 1)] == ("applied", None)
    assert status[(0, 2)][0] == "applied" and status[(0, 3)][0] == "applied"
    assert status[(1, 4)] == ("zero_rows", "no_matching_row")
    assert status[(0, 5)] == ("error", "duplicate_key")
    # the update of key 3 comes before its insert in the batch: zero rows
    assert status[(1, 6)] == ("zero_rows", "no_matching_row")
    assert status[(1, 7)] == ("applied", None)
    assert status[(1, 8)][0] == "error"           # no such column
    assert (1, 9) not in status                    # delete: ignored, never sent

    con = sqlite3.connect(path)
    got = dict(con.execute("SELECT cust_key, cust_name || '|' || coalesce(acct_bal, '') FROM customer"))
    assert got == {"1": "ann|6.00", "3": "cy|"}   # newest update wins; injection text never ran
    con.close()

    # A retried task (same batch, same partition) answers from the ledger.
    again = sorted(tuple(r) for r in dbapi.execute(work, connect, batch_id=0, tasks=2).collect())
    assert again == out_rows

    # Second chance: the zero-row work of key 3 now finds its row.
    retry = work.where((F.col("key") == "3") & (F.col("segment") == "before"))
    r2 = dbapi.execute(retry, connect, batch_id=1, tasks=1).collect()
    assert [(r.key, r.outcome) for r in r2] == [("3", "applied")]
    con = sqlite3.connect(path)
    assert con.execute("SELECT cust_name FROM customer WHERE cust_key='3'").fetchone()[0] == \
        "o'brien'); drop table customer; --"
    con.close()


def test_streaming_db_apply_with_retry_and_flush(spark, workdir):
    from tidewater.streaming.db_job import DbApplyJob

    path = f"{workdir}/stream.db"
    _db(path)
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    job = DbApplyJob(spark, f"{workdir}/job", connect, tasks=2)
    batches = [
        [("cdc", 0, 0, 0, "customer", "insert", {"custKey": "Long:1", "custName": "String:a"}, ""),
         ("cdc", 1, 1, 0, "customer", "update", {"acctBal": "BigDecimal:2.00"}, "cust_key=2"),
         ("cdc", 0, 2, 0, "customer", "update", {"acctBal": "BigDecimal:1.00"}, "cust_key=1")],
        [("cdc", 1, 3, 1, "customer", "insert", {"custKey": "Long:2", "custName": "String:b"}, ""),
         ("cdc", 1, 4, 1, "customer", "update", {"acctBal": "BigDecimal:3.00"}, "cust_key=3")],
    ]
    for e, rows in enumerate(batches):
        job.process_batch(spark.createDataFrame(rows, SCHEMA).drop("batch_id"), e)
    job.process_batch(spark.createDataFrame(batches[1], SCHEMA).drop("batch_id"), 1)  # replay
    job.flush()
    status = sorted((r.offset, r.attempt, r.status) for r in job.status().collect())
    assert status == [(0, 0, "applied"), (1, 0, "zero_rows"), (1, 1, "applied"),
                      (2, 0, "applied"), (3, 0, "applied"), (4, 0, "zero_rows"),
                      (4, 1, "dead_letter")]
    dead = [(r.offset, r.reason, r.statement) for r in job.dead_letters().collect()]
    assert dead == [(4, "zero_rows_after_retry", "update customer set acct_bal=3.00 where cust_key=3")]
    con = sqlite3.connect(path)
    got = sorted(con.execute("SELECT cust_key, cust_name, acct_bal FROM customer"))
    con.close()
    assert got == [("1", "a", "1.00"), ("2", "b", "2.00")]


def test_streaming_db_apply_continues_after_flush(spark, workdir):
    from tidewater.streaming.db_job import DbApplyJob

    path = f"{workdir}/s2.db"
    _db(path)
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    job = DbApplyJob(spark, f"{workdir}/job", connect, tasks=2)
    b0 = [("cdc", 0, 0, 0, "customer", "update", {"acctBal": "BigDecimal:1.00"}, "cust_key=9")]
    b1 = [("cdc", 0, 1, 1, "customer", "insert", {"custKey": "Long:9"}, "")]
    job.process_batch(spark.createDataFrame(b0, SCHEMA).drop("batch_id"), 0)
    job.flush()                                    # key 9 absent: dead letter
    job.process_batch(spark.createDataFrame(b1, SCHEMA).drop("batch_id"), 1)
    status = sorted((r.offset, r.attempt, r.status) for r in job.status().collect())
    assert status == [(0, 0, "zero_rows"), (0, 1, "dead_letter"), (1, 0, "applied")]


def _value(path, key):
    con = sqlite3.connect(path)
    try:
        return con.execute("SELECT cust_name, acct_bal, note FROM customer WHERE cust_key = ?",
                           (key,)).fetchone()
    finally:
        con.close()


def _work(spark, rows):
    return dbapi.plan(changelog.prepare(spark.createDataFrame(rows, SCHEMA)))


def test_a_fresh_job_is_not_answered_by_an_older_jobs_ledger(spark, workdir):
    from tidewater.streaming.db_job import DbApplyJob

    path = f"{workdir}/used.db"
    _db(path)
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    for n, name in enumerate(("one", "two")):
        job = DbApplyJob(spark, f"{workdir}/{name}", connect, tasks=2)
        job.process_batch(spark.createDataFrame(
            [("cdc", 0, 0, 0, "customer", "insert",
              {"custKey": f"Long:{n}", "custName": f"String:{name}"}, "")], SCHEMA).drop("batch_id"), 0)
        assert _value(path, str(n))[0] == name


def test_replay_with_another_number_of_tasks_writes_nothing_twice(spark, workdir):
    path = f"{workdir}/tasks.db"
    _db(path)
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    rows = [("cdc", 0, i, 0, "customer", "insert", {"custKey": f"Long:{i}"}, "") for i in range(40)]
    _, work = _work(spark, rows)
    first = sorted(map(tuple, dbapi.execute(work, connect, tasks=2, job_id="j").collect()))
    for tasks in (1, 3, 5):
        again = sorted(map(tuple, dbapi.execute(work, connect, tasks=tasks, job_id="j").collect()))
        assert again == first
    # A part done before, another task count after: the new keys are still written.
    _, more = _work(spark, rows + [("cdc", 0, 99, 0, "customer", "insert", {"custKey": "Long:99"}, "")])
    got = {r.key: r.outcome for r in dbapi.execute(more, connect, tasks=3, job_id="j").collect()}
    assert got["99"] == "applied" and _value(path, "99") is not None
    dbapi.prune(connect, "j", 1)
    con = sqlite3.connect(path)
    assert con.execute(f"SELECT count(*) FROM {dbapi.LEDGER}").fetchone()[0] == 0
    con.close()


def test_late_retry_does_not_undo_newer_updates(spark, workdir):
    from tidewater.streaming.db_job import DbApplyJob

    path = f"{workdir}/late.db"
    _db(path)
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    job = DbApplyJob(spark, f"{workdir}/job", connect, tasks=2)
    upd = lambda o, k, **v: ("cdc", 0, o, 0, "customer", "update",
                             {c: f"String:{x}" for c, x in v.items()}, f"cust_key={k}")
    ins = lambda o, k: ("cdc", 0, o, 0, "customer", "insert", {"custKey": f"Long:{k}"}, "")
    batches = [[upd(0, 1, acctBal="old", note="kept"),          # key 1 comes in the next batch
                upd(1, 2, acctBal="old", note="kept"), ins(2, 2), upd(3, 2, acctBal="new")],
               [ins(4, 1), upd(5, 1, acctBal="new")]]
    for e, rows in enumerate(batches):
        job.process_batch(spark.createDataFrame(rows, SCHEMA).drop("batch_id"), e)
    assert _value(path, "1") == (None, "new", "kept")
    assert _value(path, "2") == (None, "new", "kept")
    status = {(r.offset, r.attempt): r.status for r in job.status().collect()}
    assert status == {(0, 0): "zero_rows", (0, 1): "applied", (1, 0): "zero_rows", (1, 1): "applied",
                      (2, 0): "applied", (3, 0): "applied", (4, 0): "applied", (5, 0): "applied"}


def test_one_bad_value_fails_its_own_event_only(spark, workdir):
    from tidewater.streaming.db_job import DbApplyJob

    path = f"{workdir}/bad.db"
    _db(path)
    con = sqlite3.connect(path)
    con.execute("CREATE TRIGGER t BEFORE UPDATE ON customer WHEN new.acct_bal = 'bad' "
                "BEGIN SELECT RAISE(ABORT, 'bad balance'); END")
    con.commit()
    con.close()
    connect = functools.partial(sqlite3.connect, path, timeout=60)
    job = DbApplyJob(spark, f"{workdir}/job", connect, tasks=2)
    rows = [("cdc", 0, 0, 0, "customer", "insert", {"custKey": "Long:1"}, ""),
            ("cdc", 0, 1, 0, "customer", "update", {"acctBal": "String:good", "note": "String:a"}, "cust_key=1"),
            ("cdc", 0, 2, 0, "customer", "update", {"acctBal": "String:bad", "note": "String:b"}, "cust_key=1"),
            ("cdc", 0, 3, 0, "customer", "update", {"custName": "String:last"}, "cust_key=1")]
    for _ in range(2):      # and the same on replay
        job.process_batch(spark.createDataFrame(rows, SCHEMA).drop("batch_id"), 0)
        assert _value(path, "1") == ("last", "good", "a")
        status = {r.offset: (r.status, r.reason) for r in job.status().collect()}
        assert status == {0: ("applied", None), 1: ("applied", None), 2: ("error", "bad balance"),
                          3: ("applied", None)}
    assert [(r.offset, r.reason) for r in job.dead_letters().collect()] == [(2, "error")]
