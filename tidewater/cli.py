"""Command-line entry points of the two streaming jobs.

    python -m tidewater.cli wordcount (--socket HOST:PORT | --files DIR | --log DIR | --kafka BROKERS --topic T)
                                      --job-dir DIR [--deny a,b,c] [--interval 1] [--once]
    python -m tidewater.cli cdc-apply (--files DIR | (--log DIR | --kafka BROKERS --topic T) --value-format json|avro)
                                      --job-dir DIR [--key-column cust_key] [--interval 10] [--once --flush]
                                      [--db-module MODULE --db-args JSON]   (else: native target)

A job folder holds the checkpoint and every output; starting again with the
same folder recovers, a new folder starts fresh. ``--once`` processes what is
available and stops (``availableNow``), otherwise the job runs on a
processing-time trigger until stopped.
"""

from __future__ import annotations

import argparse
import functools
import importlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import get_session
from tidewater.sources import avro, kafka
from tidewater.streaming.cdc_job import CdcApplyJob
from tidewater.streaming.db_job import DbApplyJob
from tidewater.streaming.wordcount_job import WordCountJob, socket_stream, text_stream

# Payload of one change event (the value of a Kafka record).
CDC_EVENT_SCHEMA = ("tableName STRING, actionType STRING, columns MAP<STRING, STRING>, "
                    "`where` STRING")
CDC_FILE_SCHEMA = ("topic STRING, partition INT, offset BIGINT, seq BIGINT, tableName STRING, "
                   "actionType STRING, columns MAP<STRING, STRING>, `where` STRING")


def _kafka_stream(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rate = None
    if a.rate_per_partition and a.partitions:
        rate = kafka.max_offsets_per_trigger(a.rate_per_partition, a.partitions, a.interval)
    start = a.starting_offsets
    if a.start_policy and a.resume_from:
        # The previous job's commits, the topic's current bounds, a policy
        from tidewater.operators.offsets import starting_offsets
        from tidewater.sinks.tables import read_table

        from tidewater.streaming.runner import output_generation

        prev = a.resume_from.rstrip("/")
        out = output_generation(spark, f"{prev}/checkpoint", f"{prev}/out")
        progress = read_table(spark, f"{out}/progress",
                              "topic string, partition int, from_offset long, "
                              "until_offset long, records long, epoch long")
        bounds = kafka.read_kafka_batch(spark, kafka.kafka_options(
            a.kafka, a.topic, starting_offsets="earliest"))
        start = starting_offsets(bounds, progress, a.start_policy)
    opts = kafka.kafka_options(a.kafka, a.topic, a.group, start, rate)
    return kafka.read_kafka_stream(spark, opts)


def _log_stream(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Records of a log folder; a new job starts by policy from a previous job's progress."""
    from tidewater.operators.offsets import committed_from_progress
    from tidewater.sinks.tables import read_table
    from tidewater.sources.log import log_stream
    from tidewater.streaming.runner import output_generation

    committed = None
    if a.resume_from:
        prev = a.resume_from.rstrip("/")
        out = output_generation(spark, f"{prev}/checkpoint", f"{prev}/out")
        committed = committed_from_progress(read_table(
            spark, f"{out}/progress", "topic string, partition int, from_offset long, "
                                      "until_offset long, records long, epoch long"))
    cap = max(1, int(a.rate_per_partition * a.interval)) if a.rate_per_partition else None
    return log_stream(spark, a.log, f"{a.job_dir}/checkpoint", a.start_policy or "resume_earliest",
                      committed, cap, tuple(filter(None, (a.topic or "").split(","))))


def cdc_from_kafka(records: DataFrame, value_format: str, avro_schema: str | None = None,
                   writer_schemas: dict[int, str] | None = None) -> DataFrame:
    """Kafka records -> change events with their topic / partition / offset. Avro bodies are read
    with the registry's schema of their id; other ids cannot be decoded."""
    if value_format == "json":
        e = records.select("topic", "partition", "offset",
                           kafka.value_json(CDC_EVENT_SCHEMA, corrupt="_bad").alias("e"))
        bad = F.col("e").isNull() | F.col("e._bad").isNotNull()
    elif value_format == "avro":
        if not avro_schema or not writer_schemas:
            raise SystemExit("--avro-schema and --writer-schemas are required for --value-format avro")
        e = avro.decode_registry(records.select("topic", "partition", "offset", "value"), avro_schema,
                                 writer_schemas, name="e")
        bad = F.col("status") != "ok"
    else:
        raise SystemExit(f"unknown value format {value_format!r}")
    # A record that cannot be decoded stays: it is rejected with its reason and counted.
    fields = [F.col(f"e.{c}") for c in ("tableName", "actionType", "columns", "`where`")]
    return e.select("topic", "partition", "offset", F.col("offset").alias("seq"), *fields,
                    bad.alias("undecodable"))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp: argparse.ArgumentParser, interval: float) -> None:
        sp.add_argument("--job-dir", required=True)
        sp.add_argument("--interval", type=float, default=interval, help="seconds per micro-batch")
        sp.add_argument("--once", action="store_true", help="process what is available, then stop")
        sp.add_argument("--kafka", metavar="BROKERS")
        sp.add_argument("--log", metavar="DIR", help="record log folder (tidewater.sources.log)")
        sp.add_argument("--topic")
        sp.add_argument("--group")
        sp.add_argument("--starting-offsets", help="earliest, latest or startingOffsets JSON")
        sp.add_argument("--start-policy", choices=["zero", "latest", "resume_latest",
                                                   "resume_earliest", "group", "group_latest"],
                        help="with --resume-from: start offsets from a previous job's commits")
        sp.add_argument("--resume-from", metavar="JOB_DIR", help="previous job folder")
        sp.add_argument("--rate-per-partition", type=int, help="records/s per partition")
        sp.add_argument("--partitions", type=int, help="topic partitions (for the rate cap)")
        sp.add_argument("--max-files-per-trigger", type=int)

    w = sub.add_parser("wordcount", help="recoverable per-batch word count")
    common(w, 1.0)
    w.add_argument("--socket", metavar="HOST:PORT")
    w.add_argument("--files", metavar="DIR", help="text files, one line per row")
    w.add_argument("--deny", default="a,b,c", help="comma-separated deny list")
    w.add_argument("--echo", action="store_true", help="print each batch's report lines")

    c = sub.add_parser("cdc-apply", help="apply change events to the native target")
    common(c, 10.0)
    c.add_argument("--files", metavar="DIR", help="Kafka-shaped parquet change events")
    c.add_argument("--value-format", choices=["json", "avro"], default="json")
    c.add_argument("--avro-schema", help="reader schema (JSON text) for registry-framed Avro")
    c.add_argument("--writer-schemas", default="{}",
                   help="JSON object: registry schema id -> writer schema (JSON text)")
    c.add_argument("--key-column", default="cust_key",
                   help="key column, several joined by commas, or a JSON object of them by table "
                        "(the entry \"\" holds for all others)")
    c.add_argument("--value-mode", choices=["full", "first_segment"], default="full",
                   help="how a cell's value is read: all after the first colon, or up to the next")
    c.add_argument("--db-module", help="apply to a database: DB-API module name (e.g. sqlite3)")
    c.add_argument("--db-args", default="{}", help="JSON keyword arguments of its connect()")
    c.add_argument("--flush", action="store_true",
                   help="with --once: retry the last batch's zero-row updates at the end")
    return p


def key_option(text: str):
    """``--key-column`` as the jobs take it."""
    split = lambda v: tuple(v) if isinstance(v, list) else tuple(v.split(","))
    if not text.lstrip().startswith("{"):
        return split(text)
    return {(t or None): split(v) for t, v in json.loads(text).items()}


def _trigger(a: argparse.Namespace) -> dict:
    return {"availableNow": True} if a.once else {"processingTime": f"{a.interval} seconds"}


def main(argv: list[str] | None = None) -> None:
    a = build_parser().parse_args(argv)
    spark = get_session(a.master, app=f"tidewater-{a.command}")
    if a.command == "wordcount":
        if a.socket:
            host, port = a.socket.rsplit(":", 1)
            stream = socket_stream(spark, host, int(port))
        elif a.files:
            stream = text_stream(spark, a.files, max_files_per_trigger=a.max_files_per_trigger)
        elif a.kafka or a.log:
            records = _log_stream(spark, a) if a.log else _kafka_stream(spark, a)
            stream = records.select("topic", "partition", "offset", kafka.value_string().alias("text"))
        else:
            raise SystemExit("one of --socket, --files, --kafka, --log is required")
        job = WordCountJob(spark, a.job_dir, [w for w in a.deny.split(",") if w], echo=a.echo)
    else:
        if a.files:
            r = spark.readStream.schema(CDC_FILE_SCHEMA)
            if a.max_files_per_trigger:
                r = r.option("maxFilesPerTrigger", str(a.max_files_per_trigger))
            stream = r.parquet(a.files)
        elif a.kafka or a.log:
            records = _log_stream(spark, a) if a.log else _kafka_stream(spark, a)
            stream = cdc_from_kafka(records, a.value_format, a.avro_schema,
                                    {int(k): v for k, v in json.loads(a.writer_schemas).items()})
        else:
            raise SystemExit("one of --files, --kafka, --log is required")
        if a.db_module:
            mod = importlib.import_module(a.db_module)
            connect = functools.partial(mod.connect, **json.loads(a.db_args))
            job = DbApplyJob(spark, a.job_dir, connect, key_option(a.key_column),
                             paramstyle=getattr(mod, "paramstyle", "qmark"), mode=a.value_mode)
        else:
            job = CdcApplyJob(spark, a.job_dir, key_option(a.key_column), mode=a.value_mode)
    if a.log and a.once:
        # A capped batch is not all that the log holds: batches run until it is.
        from tidewater.sources.log import drain

        q = job.start(stream, {"processingTime": "0 seconds"})
        drain(q)
    else:
        q = job.start(stream, _trigger(a))
        q.awaitTermination()
    if q.exception() is not None:
        raise SystemExit(str(q.exception()))
    if a.command == "cdc-apply" and a.once and a.flush:
        job.flush()


if __name__ == "__main__":
    main()
