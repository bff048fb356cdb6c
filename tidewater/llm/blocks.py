"""Texts in blocks, and counts over the corpus of what each block holds.

Operators that must know, for each of very many hashes of a block of texts, how
often it occurs in the whole corpus ask in bulk: a block sends its distinct
hashes, sorted, cut to 40 bits and packed as differences, one row for each range
of the hash space; the ranges are counted; and each block gets back one byte
per hash in the order sent. The texts themselves stay where they are: they are
written once, bucketed by block, so that joining the answers to them moves the
answers only. Cutting hashes can make a count too high, never too low.

A hash that a third of all texts hold is one entry for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bucketed, shared_partitions

#: Rows per block: the unit of work in a task's memory.
ROWS = 512
BITS = 40


def text_blocks(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` with ``block`` and ``at``, written bucketed by block.

    Rows of a block stand together in the input; ``at`` is unique.
    """
    numbered = docs.withColumn("at", F.monotonically_increasing_id())
    return bucketed(numbered.withColumn("block", F.floor(F.col("at") / rows)), "text-blocks",
                    "block", gathered=True)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit numbers over all their bits (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def pack(hashes: np.ndarray, counts: np.ndarray, ranges: int) -> Iterator[tuple]:
    """(range, n, differences, counts over 1) of sorted distinct 64-bit hashes."""
    cut = hashes >> np.uint64(64 - BITS)
    home = (cut * np.uint64(ranges)) >> np.uint64(BITS)
    edges = np.searchsorted(home, np.arange(ranges + 1, dtype=np.uint64))
    for r in np.flatnonzero(np.diff(edges)):
        a, b = edges[r], edges[r + 1]
        diff = np.diff(cut[a:b], prepend=np.uint64(0)).astype("<u8")
        planes = np.ascontiguousarray(diff.view(np.uint8).reshape(-1, 8)[:, :5].T)
        many = np.flatnonzero(counts[a:b] > 1).astype("<u4")
        extra = np.stack([many, counts[a:b][many].astype("<u4")])
        yield int(r), int(b - a), planes.tobytes(), extra.tobytes()


def unpack(n: int, planes: bytes, extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    diff = np.zeros((n, 8), np.uint8)
    diff[:, :5] = np.frombuffer(planes, np.uint8).reshape(5, n).T
    counts = np.ones(n, np.int64)
    many = np.frombuffer(extra, "<u4").reshape(2, -1)
    counts[many[0]] = many[1]
    return np.cumsum(diff.view("<u8").ravel(), dtype=np.uint64), counts


def corpus_classes(blocks: DataFrame,
                   held: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]],
                   columns: list[str], ranges: int | None = None) -> DataFrame:
    """(block, range, classes): per hash that a block holds, floor(log2(its corpus count)).

    ``held`` gives a block's sorted distinct hashes and in how many of its texts
    each occurs; the classes, one byte each (at most 63), are in that order. One range of
    the hashes of all blocks is in a task's memory (default: 4 of them for each partition).
    """
    ranges = ranges or 4 * shared_partitions(blocks.sparkSession)

    def send(rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = held(rows)
        out = [(r, int(rows["block"].iloc[0]), n, p, e) for r, n, p, e in
               pack(hashes, counts, ranges)]
        return pd.DataFrame(out, columns=["range", "block", "n", "hashes", "extra"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        got = [unpack(n, p, e) for n, p, e in zip(rows["n"], rows["hashes"], rows["extra"])]
        keys = np.concatenate([g[0] for g in got])
        counts = np.concatenate([g[1] for g in got])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        total = np.add.reduceat(counts[order], starts)
        cls = np.empty(len(keys), np.uint8)
        cls[order] = np.repeat(np.log2(total).astype(np.uint8), np.diff(np.r_[starts, len(keys)]))
        ends = np.cumsum(rows["n"].to_numpy())
        return pd.DataFrame({"block": rows["block"], "range": rows["range"],
                             "classes": [c.tobytes() for c in np.split(cls, ends[:-1])]})

    sent = blocks.select("block", *columns).groupBy("block").applyInPandas(
        send, "range int, block bigint, n int, hashes binary, extra binary")
    return sent.groupBy("range").applyInPandas(answer, "block bigint, range int, classes binary")


def classes_of(answers: pd.DataFrame) -> np.ndarray:
    """The classes of a block's hashes, in the order of the hashes."""
    if not len(answers):
        return np.zeros(0, np.uint8)
    return np.frombuffer(b"".join(answers.sort_values("range")["classes"]), np.uint8)
