"""Suffix-array dedup: bytes of passages that earlier documents hold are removed.

Positions are ranked by distributed prefix doubling. The rank of a position for
length 2L is made of the pair of ranks for L at the position and L bytes on; a
rank is a 64-bit hash of that pair, so it is the same in every task without a
global sort of single bytes. The doubling goes 1, 2, 4, 8, 16 within a block of
texts. At 16 the corpus is asked (``blocks.corpus_classes``: Spark shuffles and
sorts the ranks) which ranks occur in several texts, and positions of unique rank
are done: they cannot start or lie in a repeat. Only the others go on, 16, 32 and
then past the threshold of 50 by the pair (rank 32 at p, rank 32 at p + 18), and
Spark brings equal positions together once more; the least document id among
them decides.

Not every position is asked about. Of the 35 positions whose 16 bytes lie in a
50-byte string, the one of least rank (the last of equal ones) stands for the
string: equal strings choose the same place, so asking for these anchors, about
one position in 18, loses nothing. An anchor that goes on carries the bytes around
it that its strings need; equal ones of a block travel once, with the least id. Where
a rank is held so often (``HOT``) that its anchors would not fit a task, the block sends
each distinct string of them by itself, by the string's own rank.

Edge cases: a null text counts as empty (0 bytes, nothing removed); repeated rows
(same id) do not remove each other; a null id comes after all others and is not
smaller than another null; overlapping repeats count, and strings are judged on
the input; an empty table gives an empty result; extra columns are ignored. Texts
are treated as bytes, so a removal may cut a character. Memory per task: one
block of texts, or one range of ranks; there are as many ranges as the bytes of the
texts need, and a range is worked through a few thousand contexts at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.blocks import classes_of, corpus_classes, mixed, text_blocks
from tidewater.llm.common import narrow, shared_partitions, written

LENGTH = 50
GRAM = 16
#: Windows of LENGTH bytes hold this many grams.
REACH = LENGTH - GRAM + 1
#: Bytes around an anchor that its strings can need: REACH - 1 before it, LENGTH from it on.
AROUND = REACH - 1 + LENGTH
LAST = (1 << 63) - 1
_BYTE_RANKS = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
#: Positions are handled in pieces of so many bytes, which a core's cache holds; the low bits of
#: a sort key hold the place.
PIECE_BITS = 16
#: Contexts are handled so many at a time.
ROWS = 4096
#: Ranks that 2**HOT anchors hold, or more, are asked about string by string.
HOT = 14
#: At most about so many anchors, or contexts, of all blocks in a range; one byte in SPARSE is an anchor.
ANCHORS, CONTEXTS, SPARSE = 1 << 19, 1 << 17, 18


def double(rank: np.ndarray, by: int, salt: int) -> np.ndarray:
    """Ranks for a longer prefix from the ranks at p and p + by (along the last axis)."""
    out = rank[..., :-by] * np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
    out += rank[..., by:]
    out ^= out >> np.uint64(31)
    return out


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all positions of a byte array for a power of two."""
    out, n = _BYTE_RANKS[data], 1
    while n < length:
        out = double(out, n, n)
        n *= 2
    return mixed(out)


class Block:
    """The texts of a block as one byte array, and its anchors."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("at")
        texts = [b"" if t is None else t.encode() for t in rows["text"]]
        self.ids = rows["doc_id"].to_numpy(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        # Where the last string of the text around each place starts.
        self._stop = np.repeat(self.ends - LENGTH, sizes)
        found = [self._anchors(a) for a in range(0, max(1, len(self.data)),
                                                 (1 << PIECE_BITS) - LENGTH + 1)]
        found = [np.concatenate(x) for x in zip(*found)]
        # A run that goes over a piece's end goes on in the next one.
        self.at, self.first, self.last, self.rank = found
        self.doc = np.searchsorted(self.ends, self.at, side="right")

    def _anchors(self, begin: int) -> tuple[np.ndarray, ...]:
        """Of the strings that start in this piece: anchor, first and last string, rank."""
        data = self.data[begin:begin + (1 << PIECE_BITS)]
        none = np.zeros(0, np.int64)
        if len(data) < LENGTH:
            return none, none, none, none.astype(np.uint64)
        rank = ranks(data, GRAM)
        low = (1 << PIECE_BITS) - 1
        place = np.arange(len(rank), dtype=np.uint64)
        key = (rank & ~np.uint64(low)) | (np.uint64(low) - place)
        least, n = key, 1
        while 2 * n <= REACH:
            least = np.minimum(least[:-n], least[n:])
            n *= 2
        rest = REACH - n
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        chosen = (np.uint64(low) - (least & np.uint64(low))).astype(np.int64)
        string = np.arange(len(chosen), dtype=np.int64)
        string = string[begin + string <= self._stop[begin:begin + len(chosen)]]
        if not len(string):
            return none, none, none, none.astype(np.uint64)
        chosen = chosen[string]
        head = np.r_[True, (chosen[1:] != chosen[:-1]) | (string[1:] != string[:-1] + 1)]
        heads = np.flatnonzero(head)
        tails = np.r_[heads[1:], len(string)] - 1
        at = chosen[heads]
        return begin + at, begin + string[heads], begin + string[tails], rank[at]

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct ranks of the anchors, and the number of anchors of each; 1 if they are
        all of one text."""
        held, texts = np.unique(_once_per_text(self.rank, self.doc), return_counts=True)
        anchors = np.unique(self.rank, return_counts=True)[1]
        return held, np.where(texts > 1, anchors, 1)

    def going_on(self, classes: np.ndarray, hot: int) -> None:
        """Keep the anchors whose rank occurs in more than one text."""
        of = classes[np.unique(self.rank, return_inverse=True)[1]]
        self.hot = of >= hot
        for name in ("at", "first", "last", "rank", "doc", "hot"):
            setattr(self, name, getattr(self, name)[of > 0])

    def contexts(self) -> tuple[np.ndarray, ...]:
        """Distinct (bytes around, offsets of the first and last string): these, their ranks and
        least ids, of each anchor its context, and whether a context is hot. Sorted by rank."""
        base = self.at - (REACH - 1)
        lo, hi = self.first - base, self.last - base
        weights = np.random.default_rng(7).integers(0, 1 << 63, AROUND + 2, dtype=np.uint64) * 2 + 1
        full = np.zeros((len(base), AROUND + 2), np.uint8)
        full[:, AROUND], full[:, AROUND + 1] = lo, hi
        h = np.empty(len(base), np.uint64)
        offset = np.arange(AROUND, dtype=np.int32)
        padded = np.concatenate([np.zeros(REACH, np.uint8), self.data, np.zeros(AROUND, np.uint8)])
        for a in range(0, len(base), ROWS):
            part = slice(a, a + ROWS)
            around = padded[base[part, None] + REACH + offset]
            around[(offset < lo[part, None]) | (offset >= hi[part, None] + LENGTH)] = 0
            full[part, :AROUND] = around
            h[part] = mixed((full[part] * weights).sum(axis=1, dtype=np.uint64))
        # Equal contexts have equal ranks: sort by rank, then by context.
        order = np.lexsort((h, self.rank))
        new = np.r_[True, (h[order][1:] != h[order][:-1])
                    | (self.rank[order][1:] != self.rank[order][:-1])] if len(h) else \
            np.zeros(0, bool)
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        pick = order[new]
        least = np.minimum.reduceat(self.ids[self.doc][order], np.flatnonzero(new)) \
            if len(pick) else np.zeros(0, np.int64)
        return full[pick], self.rank[pick], least, which, self.hot[pick]


def _once_per_text(rank: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The rank of each distinct (rank, doc)."""
    order = np.lexsort((doc, rank))
    r, d = rank[order], doc[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (d[1:] != d[:-1])] if len(r) else np.zeros(0, bool)
    return r[new]


def _string_ranks(around: np.ndarray) -> np.ndarray:
    """Ranks for LENGTH of the REACH strings in each row of bytes."""
    r = double(ranks(around, GRAM), GRAM, GRAM)
    return double(r, LENGTH - 2 * GRAM, LENGTH)


def _strings(full: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct ranks of the strings in these contexts, the least id of each; which of the
    REACH strings a context has, and of each of those its place among the ranks."""
    lo, hi = full[:, AROUND].astype(np.int64), full[:, AROUND + 1].astype(np.int64)
    offset = np.arange(REACH)
    valid = (offset >= lo[:, None]) & (offset <= hi[:, None])
    keys = np.empty(int(valid.sum()), np.uint64)
    at = 0
    for a in range(0, len(full), ROWS):         # 8 bytes a position: not all at once
        got = _string_ranks(full[a:a + ROWS, :AROUND])[valid[a:a + ROWS]]
        keys[at:at + len(got)] = got
        at += len(got)
    owner = np.repeat(ids, valid.sum(axis=1))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(owner[order], starts) if len(starts) else owner
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[starts], least, valid, place


def _least_ids(full: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per context and string the least id of any context with that string; LAST where none."""
    _, least, valid, place = _strings(full, ids)
    out = np.full(valid.shape, LAST, np.int64)
    out[valid] = least[place]
    return out


def _ask(rows: pd.DataFrame, answers: pd.DataFrame, ranges: int, hot: int) -> Iterator[tuple]:
    """(range, block, first, n, contexts, ids) of the contexts in each range; for the hot ones, in
    the ranges from ``ranges`` on, the ranks of their strings in place of the contexts."""
    block = Block(rows)
    block.going_on(classes_of(answers), hot)
    full, rank, least, _, hots = block.contexts()
    strings, ids, _, _ = _strings(full[hots], least[hots])
    for base, rank, data, least in ((0, rank[~hots], full[~hots], least[~hots]),
                                    (ranges, strings, strings.astype("<u8"), ids)):
        home = (rank >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        edges = np.searchsorted(home, np.arange(ranges + 1, dtype=np.uint64))
        for r in np.flatnonzero(np.diff(edges)):
            a, b = edges[r], edges[r + 1]
            yield (base + int(r), int(rows["block"].iloc[0]), int(a), int(b - a),
                   data[a:b].tobytes(), least[a:b].astype("<i8").tobytes())


def _pieces(full: np.ndarray) -> Iterator[np.ndarray]:
    """The places of contexts, about ROWS at a time; those of one rank come together."""
    rank = np.empty(len(full), np.uint64)
    for a in range(0, len(full), ROWS):
        rank[a:a + ROWS] = ranks(full[a:a + ROWS, REACH - 1:REACH - 1 + GRAM], GRAM)[:, 0]
    order = np.argsort(rank, kind="stable")
    rank = rank[order]
    ends = np.r_[np.flatnonzero(rank[1:] != rank[:-1]) + 1, len(rank)]
    a = 0
    while a < len(rank):
        b = ends[min(np.searchsorted(ends, a + ROWS), len(ends) - 1)]
        yield order[a:b]
        a = b


def _answer(rows: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Per block: the contexts (kind -1) whose least ids differ from the block's own, in runs, or
    the strings (kind -2) whose least id does."""
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in rows["ids"]])
    ends = np.cumsum(rows["n"].to_numpy())
    begins = ends - rows["n"].to_numpy()
    kind = -1 if rows["range"].iloc[0] < ranges else -2
    if kind == -2:
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in rows["contexts"]])
        _, which = np.unique(keys, return_inverse=True)
        order = np.argsort(which, kind="stable")
        starts = np.flatnonzero(np.diff(which[order], prepend=-1))
        least = np.minimum.reduceat(ids[order], starts)[which]
        at = np.flatnonzero(least != ids)
        col, least = np.zeros(len(at), np.uint8), least[at]
    else:
        full = np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, AROUND + 2)
                               for x in rows["contexts"]])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64))]
        for some in _pieces(full):
            part = _least_ids(full[some], ids[some])
            other = np.flatnonzero(((part != LAST) & (part != ids[some, None])).any(axis=1))
            some, part = some[other], part[other]
            change = np.concatenate([np.ones((len(part), 1), bool), part[:, 1:] != part[:, :-1]], axis=1)
            row, col = np.nonzero(change)
            found.append((some[row], col.astype(np.uint8), part[row, col]))
        at, col, least = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at, kind="stable")
        at, col, least = at[order], col[order], least[order]
    edges = np.searchsorted(at, np.r_[begins, len(ids)])
    out = []
    for block, first, begin, a, b in zip(rows["block"], rows["first"], begins, edges, edges[1:]):
        if a < b:
            out.append((kind, block, (first + at[a:b] - begin).astype("<u4").tobytes(),
                        col[a:b].tobytes(), least[a:b].astype("<i8").tobytes()))
    return pd.DataFrame(out, columns=["range", "block", "context", "offset", "id"])


def _least_of_block(full: np.ndarray, own: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
    """Least id per context and string, from the runs of the answers."""
    out = np.repeat(own[:, None], REACH, axis=1)
    for context, offset, ids in zip(answers["context"], answers["offset"], answers["id"]):
        c = np.frombuffer(context, "<u4").astype(np.int64)
        o = np.frombuffer(offset, np.uint8).astype(np.int64)
        flat = c * REACH + o
        until = np.r_[flat[1:], 0]
        # A run ends where the next one of its context begins, or with the context.
        last = np.r_[c[1:] != c[:-1], True]
        until[last] = (c[last] + 1) * REACH
        n = until - flat
        places = np.repeat(flat - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        out.ravel()[places] = np.repeat(np.frombuffer(ids, "<i8"), n)
    return out


def _least_of_strings(full: np.ndarray, own: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
    """Least id per hot context and string, from the answers to its strings."""
    _, least, valid, place = _strings(full, own)
    least = least.copy()
    for strings, ids in zip(answers["context"], answers["id"]):
        least[np.frombuffer(strings, "<u4").astype(np.int64)] = np.frombuffer(ids, "<i8")
    out = np.full(valid.shape, LAST, np.int64)
    out[valid] = least[place]
    return out


def _cut(rows: pd.DataFrame, classes: pd.DataFrame, answers: pd.DataFrame, hot: int,
         texts: bool) -> pd.DataFrame:
    block = Block(rows)
    block.going_on(classes_of(classes), hot)
    full, _, own, which, hots = block.contexts()
    least = np.empty((len(full), REACH), np.int64)
    least[~hots] = _least_of_block(full[~hots], own[~hots], answers[answers["range"] == -1])
    least[hots] = _least_of_strings(full[hots], own[hots], answers[answers["range"] == -2])
    gone = np.zeros(len(block.data) + 1, bool)
    offset = np.arange(REACH)
    for a in range(0, len(which), ROWS):
        part = slice(a, a + ROWS)
        strings = block.at[part, None] - (REACH - 1) + offset
        gone[strings[(strings >= block.first[part, None]) & (strings <= block.last[part, None])
                     & (least[which[part]] < block.ids[block.doc[part]][:, None])]] = True
    steps = np.zeros(len(block.data) + LENGTH + 1, np.int32)
    starts = np.flatnonzero(gone)
    steps[starts] += 1
    steps[starts + LENGTH] -= 1
    covered = np.cumsum(steps)[:len(block.data)] > 0
    out = []
    for i, a, b in zip(block.ids, block.starts, block.ends):
        c = covered[a:b]
        kept = block.data[a:b][~c].tobytes()
        spans = int((c & ~np.r_[False, c[:-1]]).sum()) if b > a else 0
        out.append((int(i), int(b - a), int(c.sum()), spans,
                    kept if texts else hashlib.sha256(kept).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep_bytes: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept.

    ``kept``: the remaining bytes, or without ``keep_bytes`` their SHA-256 in hex.
    """
    rows = narrow(docs, id_col, text_col).withColumn(
        "doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)))
    blocks = text_blocks(rows)
    # Ranges by the size of the corpus, so that one fits a task whatever the number of partitions.
    anchors = (blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SPARSE
    parts, hot = shared_partitions(docs.sparkSession), HOT
    ranges = max(16 * parts, anchors // CONTEXTS)
    classes = written(corpus_classes(blocks, lambda b: Block(b).held(), ["at", "doc_id", "text"],
                                     max(4 * parts, anchors // ANCHORS)), "suffix-classes")

    def ask(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        out = _ask(rows, got, ranges, hot) if len(rows) else ()
        return pd.DataFrame(list(out), columns=["range", "block", "first", "n", "contexts", "ids"])

    asked = blocks.groupBy("block").cogroup(classes.groupBy("block")).applyInPandas(
        ask, "range int, block bigint, first int, n int, contexts binary, ids binary")
    answers = asked.groupBy("range").applyInPandas(
        lambda rows: _answer(rows, ranges),
        "range int, block bigint, context binary, offset binary, id binary")
    # One table of both kinds of answers: a cogroup takes two sides.
    none = F.lit(None).cast("binary")
    both = classes.select("block", "range", "classes", none.alias("context"),
                          none.alias("offset"), none.alias("id")).unionByName(
        answers.select("block", "range", none.alias("classes"), "context", "offset", "id"))

    def cut(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
        return _cut(rows, got[got["range"] >= 0], got[got["range"] < 0], hot, keep_bytes)

    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                        T.StructField("n_removed", T.LongType()),
                        T.StructField("n_spans", T.LongType()),
                        T.StructField("kept", T.BinaryType() if keep_bytes else T.StringType())])
    done = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(cut, out)
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST)))


def oracle(length: int = LENGTH) -> str:
    """The same in SQL over every position; null ids are not covered."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS k
      FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - {length - 1}, 0))) AS i FROM d)),
m AS (SELECT k, min(doc_id) AS least FROM s GROUP BY k HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT doc_id, i + j AS i FROM s JOIN m USING (k), range({length}) AS r(j)
      WHERE least < doc_id),
b AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte
      FROM (SELECT doc_id, h, unnest(range(len(h) // 2)) AS i FROM d)),
k AS (SELECT b.doc_id, string_agg(byte, '' ORDER BY b.i) FILTER (WHERE g.i IS NULL) AS kept
      FROM b LEFT JOIN g ON g.doc_id = b.doc_id AND g.i = b.i GROUP BY b.doc_id),
r AS (SELECT doc_id, count(*) AS n_removed,
             count(*) FILTER (WHERE prev IS NULL OR i > prev + 1) AS n_spans
      FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM g) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)"""
