"""Command-line jobs on file sources (the Kafka paths need packages not present here)."""

import os

from pyspark.sql import functions as F

from tidewater import cli
from tidewater.sources.fixtures import read_cdc_events
from tidewater.streaming.cdc_job import CdcApplyJob
from tidewater.streaming.wordcount_job import WordCountJob
from tests.conftest import SF_SMALL


def test_cli_wordcount_once(spark, workdir):
    os.makedirs(f"{workdir}/in")
    with open(f"{workdir}/in/a.txt", "w") as f:
        f.write("x a y\nx\n")
    cli.main(["wordcount", "--files", f"{workdir}/in", "--job-dir", f"{workdir}/job", "--once"])
    got = {(r.word, r.cnt) for r in WordCountJob(spark, f"{workdir}/job").counts().collect()}
    assert got == {("x", 2), ("y", 1)}


def test_cli_cdc_apply_once_with_flush(spark, workdir):
    ev = read_cdc_events(spark, SF_SMALL).where("batch_id = 0 and topic = 'cdc'").drop("batch_id")
    ev.write.parquet(f"{workdir}/in")
    cli.main(["cdc-apply", "--files", f"{workdir}/in", "--job-dir", f"{workdir}/job",
              "--once", "--flush"])
    job = CdcApplyJob(spark, f"{workdir}/job")
    keys = job.final_state().select("key").distinct().count()
    assert keys == ev.where(F.col("actionType") == "insert").count()
    assert job.progress().count() == 4          # one row per cdc partition


def test_cli_cdc_apply_to_database(spark, workdir):
    import json
    import sqlite3

    db = f"{workdir}/t.db"
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE customer (cust_key TEXT PRIMARY KEY, cust_name TEXT, acct_bal TEXT, "
                "mkt_segment TEXT, remark TEXT)")
    con.commit()
    con.close()
    ev = read_cdc_events(spark, SF_SMALL).where("batch_id = 0 and topic = 'cdc'").drop("batch_id")
    ev.write.parquet(f"{workdir}/in")
    cli.main(["cdc-apply", "--files", f"{workdir}/in", "--job-dir", f"{workdir}/job", "--once",
              "--db-module", "sqlite3", "--db-args", json.dumps({"database": db, "timeout": 60})])
    con = sqlite3.connect(db)
    n = con.execute("SELECT count(*) FROM customer").fetchone()[0]
    con.close()
    assert n == ev.where(F.col("actionType") == "insert").count()
