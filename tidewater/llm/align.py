"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Tokenizer A (byte-level BPE, a ``tokenizers`` JSON file) reads space + text, B (a
``sentencepiece`` model, which adds that space itself) reads the text. Where tokens of
both end at the same byte, the text is cut into groups; a link is a pair of token
occurrences whose byte ranges overlap.

Equal texts are tokenised and aligned once: the documents are shuffled by their full
text, one row per distinct text carries its multiplicity, its links count that many
times, and its measures are joined back to the doc_ids by the text's SHA-256. A text
that a third of all documents share is one row per task before the shuffle, and its
doc_ids are salted in the last join.

Distinct texts are handled in blocks of ``BLOCK_CHARS`` characters. A block's texts are
cut before single spaces between words, where neither tokenizer can reach across
(checked on the two models; otherwise a text is one cut), so that a block tokenises each
distinct cut once. A block writes its distinct id pairs with their
weighted counts as rows; Spark sums them over the corpus, marks the best of each B id,
and sends a block back the sums of its own pairs.

Edge cases: texts that are null or empty, or whose joined A or B bytes differ from
space + text (B writes U+2581 as a space), have no tokens: zeros and an empty
``groups_sha256``. Rows with null or repeated ids are rows of their own; ties share
``n_best``; an empty table gives an empty result; extra columns are ignored; a very long
text is a block of its own. Memory per task: one Arrow batch and one block.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import narrow, written
from tidewater.llm.packing import Numbers, from_planes, planes
from tidewater.llm.pieces import _fields, model_bytes
from tidewater.operators.joins import hot_key_join

#: Characters of distinct texts that a task aligns at a time.
BLOCK_CHARS = 5_000_000
#: Texts with more copies have their doc_ids dealt over several tasks.
HOT_COPIES = 5_000
#: Rows of a batch that a task returns.
ROWS_OUT = 100_000
# Unicode's white space, and the pre-token pattern of byte-level BPE.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Before a single space between characters that are no white space; and what other texts hold.
CUT = re.compile(f"(?<=[^{BLANK}])(?= [^{BLANK}])")
ODD = re.compile(f" [{BLANK}]|[{BLANK}] | \\Z")


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level BPE writes for each byte, and back."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBPE:
    """Tokenizer A: ``encode`` of many texts, ``tokens`` as bytes by id, ``cuts`` if texts may be cut."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, letters = spec["model"], _byte_letters()
        self.tokens = [b""] * (1 + max(model["vocab"].values()))
        for token, i in model["vocab"].items():
            self.tokens[i] = bytes(letters[c] for c in token)
        pre = spec.get("pre_tokenizer") or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.cuts = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                     and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                     and not any(not a.get("special") for a in spec.get("added_tokens", ())))
        # Merges in the order of their ids: the ids are ranks, for which there is a faster library.
        if self.cuts and not model.get("ignore_merges") and not model.get("dropout") and all(
                model["vocab"].get(a + b) == 256 + n for n, (a, b) in enumerate(merges)):
            import tiktoken

            ranks = {t: i for i, t in enumerate(self.tokens) if t}
            fast = tiktoken.Encoding("a", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda cuts: list(map(fast.encode_ordinary, cuts))
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_str(file.decode())
            slow.encode_special_tokens = True
            self.encode = lambda cuts: [slow.encode(t, add_special_tokens=False).ids for t in cuts]


class Pieces:
    """Tokenizer B, likewise; it adds the space itself."""

    def __init__(self, file: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=file)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.tokens = [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace("▁", " ").encode()
                       for i, n in enumerate(names)]
        # No piece may reach over a space behind another character; normalising may change nothing.
        spec, trainer = (dict(_fields(dict(_fields(file)).get(n, b""))) for n in (3, 2))
        self.cuts = (not spec.get(2) and spec.get(3, 1) == 1 and spec.get(4, 1) == 0 and spec.get(5, 1) == 1
                     and not trainer.get(24) and not any(re.search("[^▁]▁", n) for n in names))
        self.encode = lambda texts: sp.encode(texts, num_threads=1) if texts else []


class Aligner:
    """Two tokenizers, and the alignment of many cuts at a time."""

    def __init__(self, file_a: bytes, file_b: bytes):
        self.a, self.b = ByteBPE(file_a), Pieces(file_b)
        self.size_a = np.array([len(t) for t in self.a.tokens], np.int64)
        self.size_b = np.array([len(t) for t in self.b.tokens], np.int64)
        self.cuts = self.a.cuts and self.b.cuts
        # What a token writes into the groups: its id and the sign behind it (at a group's end).
        self.signs = [s for n, ends in ((len(self.a.tokens), ",|"), (len(self.b.tokens), ",;"))
                      for i in range(n) for s in (f"{i}{ends[0]}", f"{i}{ends[1]}")]

    def split(self, text: str) -> list[str]:
        """The cuts of space + text; each begins with a space."""
        text = " " + text
        if not self.cuts:
            return [text]
        if ODD.search(text):
            return CUT.split(text)
        return [" " + word for word in text[1:].split(" ")]

    def tokenised(self, cuts: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of A and of B (none where the bytes differ) and whether both write the cut's bytes."""
        got_a, got_b = self.a.encode(cuts), self.b.encode([c[1:] for c in cuts])
        ok = np.ones(len(cuts), bool)
        word_a, word_b = self.a.tokens.__getitem__, self.b.tokens.__getitem__
        text = "".join(cuts).encode()
        if any(b"".join(map(word, chain.from_iterable(got))) != text
               for word, got in ((word_a, got_a), (word_b, got_b))):
            for i, (c, a, b) in enumerate(zip(cuts, got_a, got_b)):
                want = c.encode()
                if b"".join(map(word_a, a)) != want or b"".join(map(word_b, b)) != want:
                    ok[i], got_a[i], got_b[i] = False, [], []
        return got_a, got_b, ok

    def align(self, cuts: list[str]) -> dict[str, np.ndarray | list[str]]:
        """Per cut ok, n_a, n_b, n_groups, groups; per link its cut, a and b."""
        got_a, got_b, ok = self.tokenised(cuts)
        n_a, n_b = (np.fromiter(map(len, g), np.int64, len(cuts)) for g in (got_a, got_b))
        a, b = (np.fromiter(chain.from_iterable(g), np.int64, n.sum()) for g, n in ((got_a, n_a), (got_b, n_b)))
        # All cuts behind each other: both tokenizers fill the same bytes.
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(ends_a, ends_b)
        both_b = ends_a[at] == ends_b
        both_a = np.zeros(len(a), bool)
        both_a[at[both_b]] = True
        # One link ends at each byte where a token of either ends.
        ends = np.sort(np.concatenate([ends_a, ends_b[~both_b]]), kind="stable")
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        cut_of = np.repeat(np.arange(len(cuts)), n_a)
        # The tokens in writing order: of each group, those of A, then those of B.
        group_a = np.cumsum(both_a) - both_a
        group_b = np.cumsum(both_b) - both_b
        until_a = np.r_[0, np.flatnonzero(both_a) + 1]
        until_b = np.r_[0, np.flatnonzero(both_b) + 1]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + until_b[group_a]] = 2 * a + both_a
        order[np.arange(len(b)) + until_a[group_b + 1]] = 2 * (b + len(self.a.tokens)) + both_b
        signs = list(map(self.signs.__getitem__, order.tolist()))
        stop = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        return {"ok": ok, "n_a": n_a, "n_b": n_b,
                "n_groups": np.bincount(cut_of[both_a], minlength=len(cuts)),
                "groups": ["".join(signs[i:j]) for i, j in zip(stop, stop[1:])],
                "link_cut": cut_of[link_a], "link_a": a[link_a], "link_b": b[link_b]}


_ALIGNERS: dict[bytes, Aligner] = {}


def aligner(file_a: bytes, file_b: bytes) -> Aligner:
    """The aligner of two files, one in each Python worker."""
    key = hashlib.sha256(file_a).digest() + hashlib.sha256(file_b).digest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(file_a, file_b)
    return _ALIGNERS[key]


#: Three kinds of rows: a text with its cuts, a block with its links, a pair of a block.
_BLOCK_ROWS = ("block long, key binary, copies long, n_a long, n_b long, n_groups long, n_links long, "
               "groups_sha256 string, cuts binary, link_cut binary, link_pair binary, "
               "id_a int, id_b int, at int, n long")
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _rows_of(columns: dict) -> pa.RecordBatch:
    """A batch of ``_BLOCK_ROWS`` with these columns, null in all others."""
    n, out = max(map(len, columns.values())), {}
    for name, kind in (f.split(" ") for f in _BLOCK_ROWS.split(", ")):
        got = columns.get(name)
        out[name] = pa.nulls(n, _ARROW[kind]) if got is None else pa.array(got, _ARROW[kind])
    return pa.RecordBatch.from_pydict(out)


def _block_rows(own: Aligner, block: int, texts: list[str], copies: list[int]) -> Iterator[pa.RecordBatch]:
    """The rows of one block of distinct texts."""
    number = Numbers()
    cuts = [np.array([number[c] for c in own.split(t)], np.int64) for t in texts]
    got = own.align(list(number))
    weight = np.zeros(len(number), np.int64)
    n_links = np.bincount(got["link_cut"], minlength=len(number))
    ok = [bool(got["ok"][c].all()) for c in cuts]
    out = {"block": [block] * len(texts), "copies": copies,
           "key": [hashlib.sha256(t.encode()).digest() for t in texts], "groups_sha256": [], "cuts": []}
    for name, x in (("n_a", got["n_a"]), ("n_b", got["n_b"]), ("n_groups", got["n_groups"]),
                    ("n_links", n_links)):
        out[name] = [int(x[c].sum()) if good else 0 for c, good in zip(cuts, ok)]
    for c, good, m in zip(cuts, ok, copies):
        if good:
            np.add.at(weight, c, m)
            groups = "".join(map(got["groups"].__getitem__, c.tolist()))[:-1]
        out["groups_sha256"].append(hashlib.sha256(groups.encode()).hexdigest() if good else "")
        out["cuts"].append(planes((c if good else c[:0]).astype("<u4")))
    yield _rows_of(out)
    pairs, which = np.unique(got["link_a"] << 32 | got["link_b"], return_inverse=True)
    yield _rows_of({"block": [block], "link_cut": [planes(got["link_cut"].astype("<u4"))], "link_pair": [planes(which.astype("<u4"))]})
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, which, weight[got["link_cut"]])
    for i in range(0, len(pairs), ROWS_OUT):
        part = pairs[i:i + ROWS_OUT]
        yield _rows_of({"block": np.full(len(part), block), "id_a": part >> 32, "id_b": part & 0xFFFFFFFF,
                        "at": np.arange(i, i + len(part)), "n": n[i:i + ROWS_OUT]})


def aligned_blocks(texts: DataFrame, file_a: bytes, file_b: bytes) -> DataFrame:
    """(text, copies) of distinct texts as rows of ``_BLOCK_ROWS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(file_a, file_b), TaskContext.get().partitionId() << 32
        held, copies, chars = [], [], 0
        for b in batches:
            for t, m in zip(b.column(0), b.column(1).to_pylist()):
                t = t.as_py()
                if held and chars + len(t) > BLOCK_CHARS:
                    yield from _block_rows(own, block, held, copies)
                    block, held, copies, chars = block + 1, [], [], 0
                held.append(t)
                copies.append(m)
                chars += len(t)
        if held:
            yield from _block_rows(own, block, held, copies)

    return texts.select("text", "copies").mapInArrow(run, _BLOCK_ROWS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """id_a, id_b, n: links of the corpus that hold the two ids linked; best: highest of its B id."""
    counts = blocks.where("id_a is not null").groupBy("id_a", "id_b").agg(F.sum("n").alias("n"))
    # No text holds a pair that is counted 0 times.
    counts = written(counts.where("n > 0"), "pair-counts")
    # At most one row per id of B's vocabulary.
    highest = counts.groupBy("id_b").agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), "id_b").select(
        "id_a", "id_b", "n", (F.col("n") == F.col("highest")).alias("best"))


_MEASURES = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, "
             "n_best long, count_sum long, groups_sha256 string")


def _measured(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The measures of a block's texts from its rows and the sums of its pairs."""
    is_text = rows["key"].notna()
    links, texts = rows[~is_text].iloc[0], rows[is_text]
    link_cut, link_pair = from_planes(links["link_cut"], "<u4"), from_planes(links["link_pair"], "<u4")
    n, best = (np.zeros(int(link_pair.max(initial=0)) + 1, np.int64) for _ in range(2))
    n[answers["at"]], best[answers["at"]] = answers["n"], answers["best"]
    n_cuts = int(link_cut.max(initial=0)) + 1
    sums, bests = np.zeros(n_cuts, np.int64), np.zeros(n_cuts, np.int64)
    np.add.at(sums, link_cut, n[link_pair])
    np.add.at(bests, link_cut, best[link_pair])
    cuts = [from_planes(c, "<u4") for c in texts["cuts"]]
    return texts[["key", "copies", "n_a", "n_b", "n_groups", "n_links"]].assign(
        n_best=[int(bests[c].sum()) for c in cuts], count_sum=[int(sums[c].sum()) for c in cuts],
        groups_sha256=texts["groups_sha256"])


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256;
    and the id pairs of the corpus as in ``pair_counts``."""
    rows, (file_a, file_b) = narrow(docs, id_col, text_col), map(model_bytes, (path_a, path_b))
    texts = rows.where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    blocks = written(aligned_blocks(texts, file_a, file_b), "aligned-blocks")
    pairs = written(pair_counts(blocks), "pairs")
    asked = blocks.where("id_a is not null").select("block", "id_a", "id_b", "at")
    answers = asked.join(pairs, ["id_a", "id_b"]).select(F.col("block").alias("asker"), "at", "n", "best")
    own = blocks.where("id_a is null").drop("id_a", "id_b", "at", "n")
    measures = written(own.groupBy("block").cogroup(answers.groupBy("asker"))
                       .applyInPandas(_measured, _MEASURES), "alignments")
    keyed = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
    joined = hot_key_join(keyed, measures, ["key"], "copies", HOT_COPIES, ["doc_id"])
    return joined.select("doc_id", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), pairs
