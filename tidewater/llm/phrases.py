"""Phrase collocations: frequent word sequences that occur together more than apart.

Per language, phrases of ``sizes`` words that occur ``least`` times or more are
candidates; the weakest of a candidate's cuts into two parts scores it by
floor(2000000 * a / (l + r)), a candidate that lies in a longer one with most of its
occurrences goes, and the first ``top`` of each language stay.

Texts are taken in blocks of one language, written once as word numbers and a word list.

1. Misra-Gries: each block sends the 48-bit hashes of its n-grams with their counts to
   ranges of the hash space. A range merges these summaries into one of k counters, k
   above its mass divided by ``least``: what all subtractions together take from a counter
   is below ``least``, so every frequent n-gram keeps one. Survivors whose counter and the
   range's error together stay below ``least`` go, and the range counts the others exactly, as it
   still holds the summaries. The number of ranges grows with the mass, so that a
   range is of bounded size; a hot n-gram is one counter per block. The hashes that are
   frequent go back to the blocks that sent them.
2. The second pass counts these by their words in each block; Spark sums the counts by
   phrase, so that no collision counts.
3. Scores, the test for longer candidates and the ranks are joins and windows over the
   frequent phrases only. Ranks are taken in two steps, so that no task sorts a whole language.

Edge cases: a null text is empty; a null language is ``und``; repeated rows count each; ties
in score and count go to the phrase first in byte order; an empty table gives an empty
result; very long texts are blocks of their own; extra columns are ignored. Sums are
64-bit, products are decimals of 38 digits. Memory per task: one Arrow batch, one block, or
one range and its counters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.blocks import mixed
from tidewater.llm.common import shared_partitions, written
from tidewater.llm.packing import Numbers, from_planes, planes

#: Words that a task holds before it closes its blocks, one per language.
BLOCK_WORDS = 3_000_000
#: Characters whose words are numbered at a time.
GROUP_CHARS = 1_000_000
#: n-gram occurrences per range of the hash space.
RANGE_MASS = 16_000_000
#: n-gram occurrences of a block whose entries are made up at a time.
SLICE_NGRAMS = 1 << 18
BITS = 48
LONGEST = 4

# Lower-cased letters, signs between pieces (as line feeds), blanks between words.
_LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t",
                           b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")


class Words:
    """The words of many texts of one language: their numbers, 0 between pieces, and the words by number."""

    def __init__(self):
        self.number, self.parts, self.waiting, self.chars = Numbers({b"\n": 0}), [], [], 0

    def add(self, text: str) -> int:
        """Take a text; the number of words that have been numbered by that."""
        self.waiting.append(text)
        self.chars += len(text)
        return self._spell() if self.chars > GROUP_CHARS else 0

    def _spell(self) -> int:
        flat = "\n".join([*self.waiting, ""]).encode().translate(_LETTERS).replace(b"\n", b" \n ")
        tokens = list(filter(None, flat.split(b" ")))
        self.parts.append(np.fromiter(map(self.number.__getitem__, tokens), np.uint32, len(tokens)))
        self.waiting, self.chars = [], 0
        return len(tokens)

    def done(self) -> tuple[np.ndarray, list[bytes]]:
        self._spell()
        return np.concatenate(self.parts), list(self.number)


def ngram_hashes(lang: str, words: list[bytes], ids: np.ndarray) -> Iterator[tuple]:
    """(size, places, hashes) of the n-grams of each size; places are their first words'."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    own = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    word, stop = own[ids], ids == 0
    h, bad = word, stop
    for size in range(1, LONGEST + 1):
        if size > 1:
            h = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[size - 1:])
            bad = bad[:-1] | stop[size - 1:]
        at = np.flatnonzero(~bad)
        yield size, at, h[at] >> np.uint64(64 - BITS)


_BLOCKS = "block long, lang string, n_words long, ids binary, words binary"


def word_blocks(docs: DataFrame) -> DataFrame:
    """(lang, text) as blocks of one language each."""
    def closed(block: int, held: dict[str, Words]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())
        for i, (lang, own) in enumerate(held.items()):
            ids, words = own.done()
            row = (block + i, lang, int((ids > 0).sum()), planes(ids), b"\n".join(words[1:]))
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                             [f.split(" ")[0] for f in _BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, n = TaskContext.get().partitionId() << 32, {}, 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                if lang not in held:
                    held[lang] = Words()
                n += held[lang].add(text.as_py())
                if n > BLOCK_WORDS:
                    yield from closed(block, held)
                    block, held, n = block + len(held), {}, 0
        yield from closed(block, held)

    return docs.select("lang", "text").mapInArrow(run, _BLOCKS)


def _block(lang: str, ids: bytes, words: bytes) -> tuple[np.ndarray, list[bytes]]:
    return from_planes(ids, "<u4"), [b"\n", *(words.split(b"\n") if words else ())]


def sent(blocks: DataFrame, ranges: int) -> DataFrame:
    """(block, range, mass, hashes, counts): each block's distinct n-grams, by range of the hash space."""
    def summaries(block: int, lang: str, ids: bytes, words: bytes) -> Iterator[list[tuple]]:
        ids, words = _block(lang, ids, words)
        each = [h for _, _, h in ngram_hashes(lang, words, ids)]
        del ids, words
        for h in each:
            h.sort()
        # Some ranges at a time: only their entries are held beside the hashes.
        slices = min(ranges, -(-sum(map(len, each)) // SLICE_NGRAMS))
        homes = [i * ranges // slices for i in range(1, slices)]
        bounds = np.array([-(-(k << BITS - 16) // ranges) for k in homes], np.uint64) << np.uint64(16)
        cuts = [np.split(h, np.searchsorted(h, bounds)) for h in each]
        for parts in zip(*cuts):
            yield list(entries(block, parts))

    def entries(block: int, parts: tuple[np.ndarray, ...]) -> Iterator[tuple]:
        found = [np.unique(h, return_counts=True) for h in parts]
        # Of two sizes, equal hashes stay two entries.
        hashes, counts = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        home = ((hashes >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(BITS - 16)
        edges = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else []
        for a, b in zip(edges, np.r_[edges[1:], len(home)] if len(home) else []):
            steps = np.diff(hashes[a:b], prepend=np.uint64(0)).astype("<u8")
            yield (block, int(home[a]), int(counts[a:b].sum()), planes(steps),
                   planes(counts[a:b].astype("<u4")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        names = ["block", "range", "mass", "hashes", "counts"]
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("block", "lang")), b.column("ids"), b.column("words")):
                for rows in summaries(*row[:2], row[2].as_py(), row[3].as_py()):
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    # By block, as the second pass takes them: one block at a time goes to Python, not all of a task.
    return blocks.groupBy("block").applyInArrow(
        run, "block long, range long, mass long, hashes binary, counts binary")


class Summary:
    """A Misra-Gries summary of ``size`` counters that merges others into itself."""

    def __init__(self, size: int):
        self.size, self.keys, self.counts = size, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        #: What has been taken from every counter: no key has occurred more often than its counter and this.
        self.error = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counters; if more than ``size`` remain, take the next highest from all and drop the empty."""
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        keys, counts = keys[first], np.add.reduceat(counts[order], first) if len(first) else counts
        if len(keys) > self.size:
            taken = int(np.partition(counts, len(counts) - self.size - 1)[len(counts) - self.size - 1])
            self.error, counts = self.error + taken, counts - taken
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts


def survivors(sent: DataFrame, least: int) -> DataFrame:
    """(block, found): of a block's hashes, those that occur ``least`` times or more; a range
    counts exactly those that keep a counter and may, by counter and error, be among them."""
    def unpacked(row) -> tuple[np.ndarray, np.ndarray]:
        return (np.cumsum(from_planes(row.hashes, "<u8"), dtype=np.uint64),
                from_planes(row.counts, "<u4").astype(np.int64))

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        own = Summary(int(rows["mass"].sum()) // least + 1)
        waiting, n = [], 0
        for row in rows.itertuples():
            waiting.append(unpacked(row))
            n += len(waiting[-1][0])
            if n > own.size:
                own.merge(*map(np.concatenate, zip(*waiting)))
                waiting, n = [], 0
        if waiting:
            own.merge(*map(np.concatenate, zip(*waiting)))
        frequent = own.keys[own.counts + own.error >= least]
        # Counted exactly: a survivor by chance would be looked up and spelt in every block.
        counts = np.zeros(len(frequent), np.int64)
        for row in rows.itertuples():
            keys, n = unpacked(row)
            known = among(keys, frequent)
            np.add.at(counts, np.searchsorted(frequent, keys[known]), n[known])
        frequent = frequent[counts >= least]
        out = []
        for row in rows.itertuples():
            keys = unpacked(row)[0]
            keys = keys[among(keys, frequent)]
            if len(keys):
                out.append((row.block, keys.astype("<u8").tobytes()))
        return pd.DataFrame(out, columns=["block", "found"])

    return sent.groupBy("range").applyInPandas(merged, "block long, found binary")


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _counted(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """(lang, phrase, n) of a block's surviving n-grams, counted by their words."""
    out = []
    if len(rows) and len(answers):
        row = rows.iloc[0]
        ids, words = _block(row["lang"], row["ids"], row["words"])
        known = np.sort(np.concatenate([np.frombuffer(f, "<u8") for f in answers["found"]]))
        for size, at, hashes in ngram_hashes(row["lang"], words, ids):
            at = at[among(hashes, known)]
            key = ids[at].astype(np.int64)
            for j in range(1, size):        # the numbers stay below words * places
                if j > 1:
                    key = np.unique(key, return_inverse=True)[1]
                key = key * len(words) + ids[at + j]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            for start, count in zip(at[first].tolist(), n.tolist()):
                phrase = b" ".join([words[i] for i in ids[start:start + size].tolist()])
                out.append((row["lang"], phrase.decode(), count))
    return pd.DataFrame(out, columns=["lang", "phrase", "n"])


def frequent_phrases(docs: DataFrame, least: int = 30, lang_col: str = "lang",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of the phrases of up to four words that occur ``least`` times or
    more; and (lang, n), the number of words of each language."""
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    blocks = written(word_blocks(rows), "word-blocks")
    sizes = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(-(-LONGEST * words // RANGE_MASS), 4 * shared_partitions(docs.sparkSession))
    answers = survivors(sent(blocks, ranges), least).select(F.col("block").alias("asker"), "found")
    counts = blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInPandas(
        _counted, "lang string, phrase string, n long")
    found = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(found.select("lang", "phrase", F.split("phrase", " ").alias("words"), "f"),
                   "frequent-phrases"), sizes


def _exact(column) -> F.Column:
    return F.col(column).cast("decimal(20,0)")


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of the phrases of two or more words, by their weakest cut."""
    cuts = found.where(F.size("words") > 1).select(
        "lang", "phrase", "words", F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")) \
        .withColumn("head", F.array_join(F.slice("words", 1, F.col("k")), " ")) \
        .withColumn("tail", F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " "))
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # Parts of a frequent phrase are frequent.
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) "
                   "div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("w")
    return both.groupBy("lang", "phrase", "words", "a").agg(weakest).select(
        "lang", "phrase", "words", "a", "w.l", "w.r", "w.score")


def without_parts(candidates: DataFrame, percent: int = 80) -> DataFrame:
    """The candidates that do not lie in a longer one with so many percent of their occurrences."""
    longer = candidates.where(F.size("words") > 2).select("lang", "words", F.col("a").alias("f"))
    spans = [(size, start) for size in range(2, LONGEST) for start in range(LONGEST - size + 1)]
    parts = F.array(*[F.when(F.size("words") >= F.lit(max(start + size, size + 1)),
                             F.array_join(F.slice("words", start + 1, size), " ")) for size, start in spans])
    within = longer.select("lang", "f", F.explode(parts).alias("phrase")).where("phrase is not null") \
        .groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    covered = F.lit(100).cast("decimal(3,0)") * _exact("f") >= F.lit(percent).cast("decimal(3,0)") * _exact("a")
    return candidates.join(within, ["lang", "phrase"], "left").where(F.col("f").isNull() | ~covered).drop("f")


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    found, sizes = frequent_phrases(docs, least, lang_col, text_col)
    kept = without_parts(scored(found), percent).drop("words")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(shared_partitions(docs.sparkSession))))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))) \
        .where(F.col("rank") <= top).drop("salt", "rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("bigint").alias("score"))


def oracle(least: int = 30, percent: int = 80, top: int = 2000) -> str:
    """The same in DuckDB SQL, counting every n-gram."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces),
found AS (
  SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size))
  GROUP BY 1, 2, 3 HAVING count(*) >= {least}),
split AS (
  SELECT lang, size, phrase, f, string_split(phrase, ' ') AS ws FROM found WHERE size > 1),
cuts AS (
  SELECT *, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM split)),
scores AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, h.f AS l, t.f AS r,
         (2000000::HUGEINT * c.f) // (h.f + t.f) AS score
  FROM cuts c JOIN found h ON h.lang = c.lang AND h.phrase = c.head
              JOIN found t ON t.lang = c.lang AND t.phrase = c.tail),
weakest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, array_to_string(ws[i:i + n - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, ws, f, n, unnest(range(1, size - n + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS n FROM split))
  GROUP BY 1, 2),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN parts p ON p.lang = w.lang AND p.phrase = w.phrase
  WHERE p.f IS NULL OR 100::HUGEINT * p.f < {percent} * w.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM worded GROUP BY lang)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= {top}"""
