"""A record log on shared storage as a streaming source.

A log is a folder of segments. Each segment is one finished Spark write of Kafka-shaped
records (``append``), by topic and partition and in offset order within its files; its
``_SUCCESS`` mark makes all its files visible at once. The source ``record_log`` follows
it as the Kafka source follows a topic:

* **start**: a new query starts where a policy puts each partition, from the group's commits
  and the log's bounds (``offsets.start_at``); bounds come from the files' footers, not
  from a read of the records;
* **admission**: a batch takes at most ``cap`` offsets of each partition, counted from its
  next record, so that a partition with a long backlog neither grows a batch nor holds up
  the others, and gaps between files cost no empty batches;
* **rounds**: a query that is behind takes up to ``rounds`` such batches in one micro-batch, so
  that it does not pay Spark's cost of a micro-batch for each; the column ``round`` tells them
  apart (without the option a micro-batch is one batch, and there is no such column);
* **recovery**: Spark's checkpoint holds the offsets. A restarted query goes on from the last
  ones logged there (``logged_offsets``), whatever the policy;
* **reading**: one task for each file with offsets in the batch's range, row groups outside it
  are skipped, record batches go to Spark as Arrow.

The driver keeps one entry per file of the log (names, ranges), and offsets per partition.
Partitions that appear later are read from their first record. Segments may be deleted
from the oldest on (retention); offsets may have gaps, but within a partition must grow
from segment to segment.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.offsets import POLICIES, start_at
from tidewater.sinks.tables import list_files
from tidewater.sources.kafka import KAFKA_SCHEMA

#: topic -> partition (as text) -> offset
Offsets = dict[str, dict[str, int]]


#: Records of a row group: a batch decodes at most one of them beyond its own records at each end.
ROW_GROUP = 8192


def append(records: DataFrame, path: str) -> None:
    """Write records as the log's next segment: files of disjoint offset ranges, each sorted."""
    ordered = records.repartitionByRange("topic", "partition", "offset") \
        .sortWithinPartitions("topic", "partition", "offset")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    ordered.write.option("parquet.block.row.count.limit", str(ROW_GROUP)).partitionBy("topic", "partition").parquet(f"{path.rstrip('/')}/segment={name}")


class LogFile(NamedTuple):
    topic: str
    partition: int
    path: str
    first: int
    until: int


def _file_system(path: str):
    """Arrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class LogIndex:
    """The files of all finished segments and their offset ranges, read from the footers once."""

    def __init__(self, path: str):
        self.path = path
        self.segments: dict[str, list[LogFile]] = {}

    def _segment(self, fs, folder: str) -> list[LogFile] | None:
        from pyarrow import fs as pafs
        from pyarrow import parquet as pq

        found = fs.get_file_info(pafs.FileSelector(folder, recursive=True))
        if not any(f.base_name == "_SUCCESS" for f in found):
            return None
        out = []
        for f in found:
            parts = dict(p.split("=", 1) for p in f.path[len(folder):].split("/") if "=" in p)
            if f.type != pafs.FileType.File or f.base_name[0] in "._" or len(parts) < 2:
                continue
            with fs.open_input_file(f.path) as data:
                meta = pq.ParquetFile(data).metadata
            at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == "offset")
            ranges = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            if ranges:
                out.append(LogFile(unquote(parts["topic"]), int(parts["partition"]), f.path,
                                   min(r.min for r in ranges), max(r.max for r in ranges) + 1))
        return out

    def refresh(self) -> list[LogFile]:
        """The files now; footers are read of new segments only."""
        from pyarrow import fs as pafs

        fs, root = _file_system(self.path)
        names = [f.path for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                 if f.type == pafs.FileType.Directory and f.base_name.startswith("segment=")]
        fresh = [n for n in names if n not in self.segments]
        with ThreadPoolExecutor(16) as pool:
            got = dict(zip(fresh, pool.map(lambda n: self._segment(fs, n), fresh)))
        known = self.segments | {n: files for n, files in got.items() if files is not None}
        self.segments = {n: known[n] for n in names if n in known}
        return [f for files in self.segments.values() for f in files]


def bounds(files: list[LogFile]) -> dict[tuple[str, int], tuple[int, int]]:
    """(earliest, latest) of each topic partition."""
    out: dict[tuple[str, int], tuple[int, int]] = {}
    for f in files:
        lo, hi = out.get((f.topic, f.partition), (f.first, f.until))
        out[f.topic, f.partition] = min(lo, f.first), max(hi, f.until)
    return out


def _nested(flat: dict[tuple[str, int], int]) -> Offsets:
    out: Offsets = {}
    for (topic, partition), offset in sorted(flat.items()):
        out.setdefault(topic, {})[str(partition)] = offset
    return out


def _flat(nested: Offsets) -> dict[tuple[str, int], int]:
    return {(t, int(p)): int(o) for t, some in nested.items() for p, o in some.items()}


class LogRange(InputPartition):
    """The offsets [first, until) of one file; ``ends``: where each round ends."""

    def __init__(self, file: LogFile, first: int, until: int, ends: list[int]):
        self.file, self.first, self.until, self.ends = file, first, until, ends


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.index = LogIndex(options["path"])
        self.policy = options.get("startpolicy", "resume_earliest")
        self.committed = _flat(json.loads(options.get("committed", "{}")))
        self.topics = set(filter(None, options.get("subscribe", "").split(",")))
        self.cap = int(options["cap"]) if options.get("cap") else None
        self.rounds = int(options["rounds"]) if options.get("rounds") else None
        self.start: dict[tuple[str, int], int] | None = None
        #: Up to where the query has planned its batches (None: a new query).
        self.at = _flat(json.loads(options["resume"])) if options.get("resume") else None

    def _files(self) -> list[LogFile]:
        return [f for f in self.index.refresh() if not self.topics or f.topic in self.topics]

    def _start(self) -> dict[tuple[str, int], int]:
        """Where a new query starts: decided once, whichever of the next two Spark asks first."""
        if self.start is None:
            known = bounds(self._files())
            mine = {k: c for k, c in self.committed.items() if not self.topics or k[0] in self.topics}
            self.start = {k: start_at(self.policy, mine.get(k), *known.get(k, (None, None)), bool(mine))
                          for k in {*known, *mine}}
        return self.start

    def initialOffset(self) -> dict:
        return _nested(self._start())

    def _rounds(self, files: list[LogFile], at: dict) -> Iterator[dict[tuple[str, int], int]]:
        """Where the next batches from ``at`` end, up to ``rounds`` of them: each takes at most ``cap``
        offsets of a partition, from its next record on."""
        ordered: dict[tuple[str, int], list[LogFile]] = {}
        for f in sorted(files, key=lambda f: f.until):
            ordered.setdefault((f.topic, f.partition), []).append(f)
        known = bounds(files)
        for _ in range(self.rounds or 1):
            end = dict(at)
            for key, (earliest, latest) in known.items():
                here = at.get(key, earliest)
                if self.cap is not None:
                    some = ordered[key]
                    while some and some[0].until <= here:
                        some.pop(0)
                    following = min((f.first for f in some), default=here)
                    latest = min(latest, max(here, following) + self.cap)
                end[key] = max(here, latest)
            if end == at:
                return
            yield end
            at = end

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._start()
        for end in self._rounds(self._files(), self.at):
            self.at = end
        return _nested(self.at)

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        lo, hi = _flat(start), _flat(end)
        if any(o > hi.get(k, o) for k, o in lo.items()):
            raise ValueError("offsets went back: a restarted query needs the option resume (use log_stream)")
        self.at = {k: max(o, (self.at or {}).get(k, o)) for k, o in hi.items()}
        files = self._files()
        # A replayed batch has the same rounds: its end is given, and files never change.
        ends = list(self._rounds(files, lo)) if self.rounds else []
        return [LogRange(f, lo.get(key, f.first), hi[key], [e[key] for e in ends[:-1] if key in e]) for f in files
                for key in [(f.topic, f.partition)]
                if key in hi and f.until > lo.get(key, f.first) and f.first < hi[key]]

    def read(self, partition: LogRange) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import parquet as pq

        f, (fs, _) = partition.file, _file_system(self.index.path)
        with fs.open_input_file(f.path) as data:
            source = pq.ParquetFile(data)
            at = source.schema_arrow.names.index("offset")
            stats = [source.metadata.row_group(g).column(at).statistics for g in range(source.num_row_groups)]
            groups = [g for g, s in enumerate(stats) if s.max >= partition.first and s.min < partition.until]
            for b in source.iter_batches(ROW_GROUP, groups, ["key", "value", "offset", "timestamp", "timestampType"]):
                offset = b.column("offset")
                b = b.filter(pc.and_(pc.greater_equal(offset, partition.first), pc.less(offset, partition.until)))
                if b.num_rows:
                    stamp = b.column("timestamp").cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
                    offset = b.column("offset")
                    ends = np.array(partition.ends, "int64")
                    rounds = np.searchsorted(ends, offset.to_numpy(), "right").astype("int32")
                    yield pa.RecordBatch.from_arrays(
                        [b.column("key").cast(pa.binary()), b.column("value").cast(pa.binary()),
                         pa.repeat(f.topic, b.num_rows), pa.repeat(pa.scalar(f.partition, pa.int32()), b.num_rows),
                         offset, stamp, b.column("timestampType")] + ([pa.array(rounds)] if self.rounds else []),
                        ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
                        + (["round"] if self.rounds else []))

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint holds the offsets, retention is the log's."""


class RecordLog(DataSource):
    """``spark.readStream.format("record_log")``; options: path, subscribe, startPolicy, committed, cap, rounds, resume."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        rounds = any(k.lower() == "rounds" for k in self.options)
        return f"{KAFKA_SCHEMA}, round int" if rounds else KAFKA_SCHEMA

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader({k.lower(): v for k, v in self.options.items()})


def logged_offsets(spark: SparkSession, checkpoint: str) -> str | None:
    """The offsets that the checkpoint's newest batch ends at (None: no batch yet)."""
    batches = [int(n) for n in list_files(spark, f"{checkpoint}/offsets") if n.isdigit()]
    if not batches:
        return None
    lines = spark.read.text(f"{checkpoint}/offsets/{max(batches)}", wholetext=True).first()[0]
    # Format of the offset log: version, batch metadata, one line per source.
    return lines.strip().split("\n")[2]


def log_stream(spark: SparkSession, path: str, checkpoint: str, policy: str = "resume_earliest",
               committed: DataFrame | None = None, cap: int | None = None,
               topics: tuple[str, ...] = (), rounds: int | None = None) -> DataFrame:
    """Records of the log for a query on ``checkpoint``: a new one starts by ``policy`` from the
    commits (topic, partition, committed; one row per partition), a known one goes on."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    spark.dataSource.register(RecordLog)
    commits = {} if committed is None else {(r[0], r[1]): r[2] for r in committed.select(
        "topic", "partition", "committed").where("committed is not null").collect()}
    r = spark.readStream.format("record_log").option("path", path).option("startPolicy", policy) \
        .option("committed", json.dumps(_nested(commits))).option("subscribe", ",".join(topics))
    if cap:
        r = r.option("cap", str(int(cap)))
    if rounds:
        r = r.option("rounds", str(int(rounds)))
    resume = logged_offsets(spark, checkpoint)
    return (r.option("resume", resume) if resume else r).load()


def drain(query: StreamingQuery) -> None:
    """Let a query on a processing-time trigger take all that the log holds now, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
