"""Streaming: recovery from checkpoint, replay idempotence, fresh start (5.3, 5.4)."""

import os

from pyspark.sql import functions as F

from tidewater.sinks.tables import write_epoch
from tidewater.streaming.runner import output_generation
from tidewater.streaming.wordcount_job import WordCountJob, text_stream


def _land(path, name, lines, mtime):
    os.makedirs(path, exist_ok=True)
    f = os.path.join(path, name)
    with open(f, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(f, (mtime, mtime))


def _counts(job):
    return {(r.batch_id, r.word): r.cnt for r in job.counts().collect()}


def report_of(job, epoch):
    """The report file's lines, part after part."""
    folder = f"{job.out}/report/epoch={epoch}"
    out = []
    for name in sorted(f for f in os.listdir(folder) if f.startswith("part-")):
        with open(os.path.join(folder, name)) as fh:
            out += fh.read().splitlines()
    return out


def test_report_has_every_word(spark, workdir, capsys):
    job = WordCountJob(spark, f"{workdir}/job", echo=True)
    words = sorted(f"w{i}" for i in range(40))
    job.process_batch(spark.createDataFrame([(" ".join(words + ["a"]),)], "text string"), 0)
    want = ["Counts at time 0 [", *[f"({w},1)" for w in words], "]", "Dropped 1 word(s) totally"]
    assert report_of(job, 0) == want
    assert capsys.readouterr().out.splitlines() == want
    job.process_batch(spark.createDataFrame([], "text string"), 1)      # no words: no report
    assert report_of(job, 1) == ["Dropped 1 word(s) totally"]


def test_wordcount_job_writes_progress(spark, workdir):
    job = WordCountJob(spark, f"{workdir}/job")
    rows = [("x", "t", 0, 5), ("y", "t", 0, 6), ("z", "t", 1, 2)]
    job.process_batch(spark.createDataFrame(rows, "text string, topic string, partition int, offset long"), 0)
    got = spark.read.parquet(f"{job.out}/progress/epoch=0").collect()
    assert sorted(map(tuple, got)) == [("t", 0, 5, 7, 2), ("t", 1, 2, 3, 1)]


def test_wordcount_recovers_and_processes_only_new_files(spark, workdir):
    landing, job_dir = f"{workdir}/in", f"{workdir}/job"
    _land(landing, "f1.txt", ["a b x", "x y"], 1_000_000)
    job = WordCountJob(spark, job_dir)
    job.run_available(text_stream(spark, landing))
    assert _counts(job) == {(0, "x"): 2, (0, "y"): 1}

    _land(landing, "f2.txt", ["x c c z"], 2_000_000)
    job2 = WordCountJob(spark, job_dir)          # restart: recovers from the checkpoint
    assert job2.out == job.out
    job2.run_available(text_stream(spark, landing))
    assert _counts(job2) == {(0, "x"): 2, (0, "y"): 1, (1, "x"): 1, (1, "z"): 1}
    totals = {r.batch_id: (r.dropped, r.dropped_total) for r in job2.dropped_totals().collect()}
    assert totals == {0: (2, 2), 1: (2, 4)}      # counts of a, b, then c, c; running
    assert report_of(job2, 0) == ["Counts at time 0 [", "(x,2)", "(y,1)", "]",
                                  "Dropped 2 word(s) totally"]
    assert report_of(job2, 1) == ["Counts at time 1 [", "(x,1)", "(z,1)", "]",
                                  "Dropped 4 word(s) totally"]

    # Nothing new: no batch runs, nothing changes.
    WordCountJob(spark, job_dir).run_available(text_stream(spark, landing))
    assert _counts(job2) == {(0, "x"): 2, (0, "y"): 1, (1, "x"): 1, (1, "z"): 1}


def test_replaying_an_epoch_changes_nothing(spark, workdir):
    job = WordCountJob(spark, f"{workdir}/job")
    df = spark.createDataFrame([("a a q",), ("q r",)], "text string")
    job.process_batch(df, 0)
    first = sorted(map(tuple, job.counts().collect()))
    job.process_batch(df, 0)                     # the same epoch again (at-least-once)
    assert sorted(map(tuple, job.counts().collect())) == first
    assert first == [(0, "q", 2), (0, "r", 1)]


def test_fresh_start_opens_a_new_output_generation(spark, workdir):
    out_root, ckpt = f"{workdir}/out", f"{workdir}/ckpt"
    assert output_generation(spark, ckpt, out_root).endswith("gen=0")
    write_epoch(spark.range(1), f"{out_root}/gen=0/t", 0)
    # no checkpoint progress: fresh start -> new, empty generation
    assert output_generation(spark, ckpt, out_root).endswith("gen=1")
    os.makedirs(f"{ckpt}/offsets")
    # progress present: recovery continues in the newest generation
    assert output_generation(spark, ckpt, out_root).endswith("gen=0")


def test_stream_equals_batch_with_data_batches_split_over_epochs(spark, workdir):
    landing = f"{workdir}/in"
    rows = [(b, f"w{b} a common") for b in range(4) for _ in range(3)]
    spark.createDataFrame(rows, "batch_id long, text string").repartition(6).write.parquet(landing)
    stream = (spark.readStream.schema("batch_id long, text string")
              .option("maxFilesPerTrigger", "1").parquet(landing))
    job = WordCountJob(spark, f"{workdir}/job", batch_column="batch_id")
    job.run_available(stream)
    got = {(r.batch_id, r.word): r.cnt for r in job.counts().collect()}
    want = {}
    for b, _ in rows:
        for w in (f"w{b}", "common"):
            want[(b, w)] = want.get((b, w), 0) + 1
    assert got == want
    assert job.counts().agg(F.sum("cnt")).first()[0] == 24


def test_cdc_stream_key_log_compaction_and_replay(spark, workdir):
    from tidewater.streaming.cdc_job import CdcApplyJob

    schema = ("topic string, partition int, offset long, tableName string, actionType string, "
              "columns map<string,string>, where string")
    ins = lambda k, o: ("t", 0, o, "customer", "insert", {"custKey": f"Long:{k}", "v": f"Integer:{k}"}, "")
    upd = lambda k, o, v: ("t", 0, o, "customer", "update", {"v": f"Integer:{v}"}, f"cust_key={k}")
    batches = [[ins(1, 0)], [ins(2, 1), upd(3, 2, 30)], [upd(1, 3, 10), ins(3, 4)], [upd(2, 5, 20)]]
    job = CdcApplyJob(spark, f"{workdir}/job", compact_every=2)
    for e, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        job.process_batch(df, e)
        if e == 2:
            job.process_batch(df, e)         # replayed epoch: same outputs
    job.flush()
    assert os.path.isdir(f"{job.out}/keys_compact/upto=1")
    assert os.path.isdir(f"{job.out}/keys_compact/upto=3")
    final = {(r.key, r.column): r.value for r in job.final_state().collect()}
    assert final == {("1", "cust_key"): "1", ("1", "v"): "10", ("2", "cust_key"): "2",
                     ("2", "v"): "20", ("3", "cust_key"): "3", ("3", "v"): "30"}
    status = sorted((r.offset, r.attempt, r.status) for r in job.status().collect())
    assert status == [(0, 0, "applied"), (1, 0, "applied"), (2, 0, "zero_rows"), (2, 1, "applied"),
                      (3, 0, "applied"), (4, 0, "applied"), (5, 0, "applied")]


def test_cdc_stream_continues_after_flush(spark, workdir):
    from tidewater.streaming.cdc_job import CdcApplyJob

    schema = ("topic string, partition int, offset long, tableName string, actionType string, "
              "columns map<string,string>, where string")
    job = CdcApplyJob(spark, f"{workdir}/job")
    job.process_batch(spark.createDataFrame(
        [("t", 0, 0, "customer", "update", {"v": "Integer:1"}, "cust_key=9")], schema), 0)
    job.flush()                                    # key 9 absent: dead letter
    job.process_batch(spark.createDataFrame(
        [("t", 0, 1, "customer", "insert", {"custKey": "Long:9"}, "")], schema), 1)
    status = sorted((r.offset, r.attempt, r.status) for r in job.status().collect())
    assert status == [(0, 0, "zero_rows"), (0, 1, "dead_letter"), (1, 0, "applied")]
    assert {(r.key, r.column) for r in job.final_state().collect()} == {("9", "cust_key")}


def test_texts_of_one_task_are_split_on_all_cores(spark, workdir, monkeypatch):
    from tidewater.operators import wordcount

    parts, words = [], wordcount.text_words

    def counted(df, *a, **k):
        parts.append(df.rdd.getNumPartitions())
        return words(df, *a, **k)

    monkeypatch.setattr(wordcount, "text_words", counted)
    job = WordCountJob(spark, f"{workdir}/job", deny_words=("no",))
    job.process_batch(spark.createDataFrame([("x y no",), ("x",)], "text string").coalesce(1), 0)
    assert parts == [spark.sparkContext.defaultParallelism]
    assert {(r.word, r.cnt) for r in job.counts().collect()} == {("x", 2), ("y", 1)}
