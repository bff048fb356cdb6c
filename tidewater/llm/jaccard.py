"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct runs of five words; two documents link at a
Jaccard similarity of 0.75 or more. All n-grams have one global order, by the
magnitude of their number of documents and then by hash, so rare ones come first.
Two linked sets share an n-gram among the first |s| - ceil(0.75 |s|) + 1 of each;
n-grams of a single document cannot be shared and make no candidates, which
leaves few. The order is cut into fragments; for each candidate pair the overlap
is counted separately in every fragment by a join on document and fragment, and
the partial counts are summed per pair.

Documents with equal texts are one class from the start. Pairs are not formed
within a group: in rounds, the holders of an n-gram are compared with one of
them, its leader, and linked ones merge; holders in one component need no more
comparison. Once few comparisons per holder are left, or a round links hardly any
more, the holders outside the leader's component are compared with all holders of
other components, so that no link between components is lost. Of n-grams with the
same holders one is enough, so that a pair is not met again at each that it shares.
Each set has a signature: for each of 512 values, whether an odd number of its n-grams
hash to it. Common n-grams cancel in the exclusive or of two, so its bits count no more
than what the sets do not share, and pairs of holders whose signatures differ by too
much for a link are left out before they are made.

The number of documents of each n-gram is counted over the whole corpus in bulk
(``blocks.corpus_classes``); texts are written once and do not move after that.

Edge cases: a null text, an empty one and one without words have an empty set,
0 n-grams, and are their own component, also if several are equal; fewer than five
words make one n-gram of the whole sequence; rows with the same id are told apart
and link by their texts; a null id is never the least id unless all are null (then
null); an empty table gives an empty result; extra columns are ignored. Memory per
task: one block of texts, or one range of hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.blocks import classes_of, corpus_classes, mixed, text_blocks
from tidewater.llm.common import bucketed, narrow, packed, unpacked, written
from tidewater.llm.graph import components

WORDS = 5
#: Similarity as a fraction: numerator and denominator.
NUM, DEN = 75, 100
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_ODD = 0x9E3779B97F4A7C15
#: The fragments of the global order: see ``Sets.segments``.
FRAGMENTS = range(2, 10)
#: Comparisons of sizes and places that are made directly: so many in all; so many per holder of
#: an n-gram; and so many when the rounds find no more than one link for ``RARE`` texts.
AT_ONCE, SOME, FEW = 200_000, 8, 2000
RARE = 50
#: 64-bit words of a signature.
SIGN = 8
#: Words are hashed in pieces of so many bytes.
PIECE = 1 << 16
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and those of its inverse."""
    if len(_POWERS) < 2 or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.full(max(n, 2 * PIECE), base, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a lower-cased byte array."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # As many words as fit in a piece, one at least.
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE)))
        a, b = starts[at], ends[to - 1]
        up, down = _powers(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:b]] * up[:-1], out=sums[1:])
        s, e = starts[at:to] - a, ends[at:to] - a
        out[at:to] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return starts, out


class Sets:
    """The n-gram sets of a block of texts: ``doc`` and ``gram``, sorted, without repeats."""

    def __init__(self, rows: pd.DataFrame, words: int):
        rows = rows.sort_values("at")
        self.at = rows["at"].to_numpy()
        texts = [b"" if t is None else t.encode() for t in rows["text"]]
        data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts, hashes = word_hashes(data)
        of = np.searchsorted(ends, starts, side="right")
        n_words = np.bincount(of, minlength=len(texts))
        first = np.r_[0, np.cumsum(n_words)[:-1]]
        docs, grams = [], []
        for n in range(1, words + 1):
            if n < words:               # whole sequences of texts of n words
                heads = first[n_words == n]
            else:
                heads = np.arange(max(0, len(of) - words + 1))
                heads = heads[of[heads] == of[heads + words - 1]] if len(heads) else heads
            h = np.full(len(heads), n, np.uint64)
            for k in range(n):
                h = mixed(h * np.uint64(_ODD) + hashes[heads + k])
            docs.append(of[heads])
            grams.append(h)
        doc, gram = np.concatenate(docs), np.concatenate(grams)
        self.bits = np.uint64(max(1, (len(texts) - 1).bit_length()))
        order = self._by(doc, gram)
        doc, gram = doc[order], gram[order]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])] if len(doc) else \
            np.zeros(0, bool)
        self.doc, self.gram = doc[new], gram[new]
        self.size = np.bincount(self.doc, minlength=len(texts))

    def _by(self, doc: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Order by document, then by the upper bits of a 64-bit key."""
        return np.argsort((doc.astype(np.uint64) << (np.uint64(64) - self.bits))
                          | (key >> self.bits), kind="stable")

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.gram, return_counts=True)

    def segments(self, classes: np.ndarray, num: int, den: int) -> list[tuple]:
        """(at, size, fragment, grams, places, prefix, sign) of the n-grams that several texts hold.

        The fragments are cuts of the global order (class, hash). A text none of
        whose first n-grams is shared has one row without n-grams.
        """
        cls = classes[np.unique(self.gram, return_inverse=True)[1]].astype(np.int64)
        order = self._by(self.doc, (cls.astype(np.uint64) << np.uint64(58))
                         | (self.gram >> np.uint64(6)))
        doc, gram, cls = self.doc[order], self.gram[order], cls[order]
        ends = np.cumsum(self.size)
        begins = ends - self.size
        place = np.arange(len(doc)) - begins[doc]
        prefix = self.size - -(-num * self.size // den) + 1
        active = np.zeros(len(self.size), bool)
        active[doc[(cls > 0) & (place < prefix[doc])]] = True
        out = [(int(a), int(s), None, None, None, 0, None)
               for a, s, on in zip(self.at, self.size, active) if not on]
        keep = (cls > 0) & active[doc]
        doc, gram, cls, place = doc[keep], gram[keep], cls[keep], place[keep]
        fragment = 2 * np.minimum(cls, 4) + (gram >> np.uint64(63)).astype(np.int64)
        # Within a text the order is by class and hash, so fragments are runs.
        cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (fragment[1:] != fragment[:-1])]
                             if len(doc) else np.zeros(0, bool))
        signed, signs = gram.view(np.int64), signatures(doc, gram, len(self.size))
        for a, b in zip(cut, np.r_[cut[1:], len(doc)]):
            d = doc[a]
            out.append((int(self.at[d]), int(self.size[d]), int(fragment[a]), signed[a:b],
                        place[a:b].astype(np.int32), int(prefix[d]), signs[d]))
        return out


def signatures(doc: np.ndarray, gram: np.ndarray, docs: int) -> np.ndarray:
    """Per document the number of its n-grams, then the ``SIGN`` words of its signature."""
    bits = 64 * SIGN
    value = doc * bits + (gram % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(value, minlength=docs * bits) & 1).astype(np.uint8).reshape(docs, bits)
    return np.c_[np.bincount(doc, minlength=docs), np.packbits(odd, axis=1).view(np.int64)]


def _may_link(sa: Column, pa: Column, sb: Column, pb: Column, num: int, den: int) -> Column:
    """Whether sizes and the places of the first shared n-gram leave room for enough overlap."""
    need = F.ceil(F.lit(num) * (sa + sb) / F.lit(num + den))
    return (den * F.least(sa, sb) >= num * F.greatest(sa, sb)) \
        & (F.least(sa - pa, sb - pb) >= need)


def _signs_may_link(sa: Column, a: Column, sb: Column, b: Column, num: int, den: int) -> Column:
    """Whether signatures leave room for enough overlap: n-grams of both sets cancel out, so that
    each bit that differs is an n-gram of only one of the sets."""
    need = F.ceil(F.lit(num) * (sa + sb) / F.lit(num + den))
    apart = [F.bit_count(a[f"s{i}"].bitwiseXOR(b[f"s{i}"])) for i in range(1, SIGN + 1)]
    return a["s0"] + b["s0"] - sum(apart[1:], apart[0]) >= 2 * need


def _may_meet(num: int, den: int) -> Column:
    """Whether by size, place and sign a row's holder may link with the one beside it."""
    beside = [F.col(c) for c in ("size", "place", "size2", "place2")]
    signed = [F.col(c) for c in ("size", "sign", "size2", "sign2")]
    return _may_link(*beside, num, den) & _signs_may_link(*signed, num, den)


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, sa, sb, inter): partial overlaps per fragment, summed per pair."""
    each = pairs.select("*", F.explode(F.array(*[F.lit(f) for f in FRAGMENTS])).alias("fragment"))
    a = segments.select(F.col("at").alias("a"), "fragment", F.col("grams").alias("ga"))
    b = segments.select(F.col("at").alias("b"), "fragment", F.col("grams").alias("gb"))
    partial = each.join(a, ["a", "fragment"]).join(b, ["b", "fragment"]).select(
        "a", "b", "sa", "sb", F.size(F.array_intersect("ga", "gb")).alias("n"))
    return partial.groupBy("a", "b", "sa", "sb").agg(F.sum("n").alias("inter"))


def _links(pairs: DataFrame, segments: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of those pairs that are similar enough."""
    found = overlaps(written(pairs, "jaccard-pairs"), segments)
    similar = den * F.col("inter") >= num * (F.col("sa") + F.col("sb") - F.col("inter"))
    return written(found.where(similar).select("a", "b"), "jaccard-links")


def _ordered(met: DataFrame) -> DataFrame:
    """(a, b, sa, sb) of (at, size, at2, size2), the lesser one first."""
    low = F.col("at") < F.col("at2")
    pick = lambda x, y: F.when(low, F.col(x)).otherwise(F.col(y))
    return met.select(pick("at", "at2").alias("a"), pick("at2", "at").alias("b"),
                      pick("size", "size2").alias("sa"), pick("size2", "size").alias("sb"))


def _pairs(x: DataFrame, y: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs of holders of one n-gram in different components that may link."""
    y = y.toDF("gram2", "at2", "size2", "place2", "root2", "sign2")
    met = x.join(y, (F.col("gram") == F.col("gram2")) & (F.col("root") != F.col("root2"))
                 & _may_meet(num, den))
    return _ordered(met).distinct()


def _told_apart(rows: DataFrame) -> DataFrame:
    """Of the n-grams with the same holders only the first in the global order.

    Two texts that link pass ``_may_link`` at the first n-gram that they share, which is the
    first of those with its holders; at the others the same pairs would only be met again.
    """
    who = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("at"))).alias(f"who{seed}") for seed in (1, 2)]
    # Places in one and the same holder follow the global order.
    per = rows.groupBy("gram").agg(F.count("*").alias("n"), *who,
                                   F.min(F.struct("at", "place")).alias("least"))
    first = per.groupBy("n", "who1", "who2").agg(
        F.min(F.struct("least.place", "gram")).alias("first")).select("first.gram")
    return rows.join(first, "gram")


def _held(rows: DataFrame, labels: DataFrame, signs: DataFrame, turn: int) -> DataFrame:
    """(gram, at, size, place, root, sign, lead, sign2) of the n-grams whose holders are not all
    in one component; ``lead``, of signature ``sign2``, is one of the holders: at first the first in the input, which of a
    group of copies is often the one that the others were made from, then one of the component
    with the most holders, drawn anew for each n-gram."""
    named = rows.join(labels.withColumnRenamed("node", "at"), "at", "left") \
        .withColumn("root", F.coalesce("root", "at"))
    draw = (F.xxhash64(F.lit(turn), "gram", "at") if turn else -F.col("at")).alias("draw")
    each = named.groupBy("gram", "root").agg(
        F.count("*").alias("n"), F.max(F.struct(draw, "at", "size", "place", "root")).alias("lead"))
    per = each.groupBy("gram").agg(F.count("*").alias("roots"),
                                   F.max(F.struct("n", "lead")).alias("most"))
    per = per.where("roots > 1").select("gram", F.col("most.lead").alias("lead"))
    signed = per.join(signs.toDF("at2", "sign2"), F.col("lead.at") == F.col("at2")).drop("at2")
    return written(named.join(signed, "gram").join(signs, "at"), "jaccard-held")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: only the roots that these connect are labelled anew."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(labels.toDF(end, f"root_{end}"), end, "left").withColumn(
            f"root_{end}", F.coalesce(f"root_{end}", end))
    more = components(ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    moved = labels.join(more.toDF("root", "new"), "root", "left").select(
        "node", F.coalesce("new", "root").alias("root"))
    return written(moved.unionByName(more.join(labels, "node", "left_anti")), "jaccard-labels")


def similar_components(rows: DataFrame, segments: DataFrame, signs: DataFrame,
                       num: int, den: int) -> DataFrame:
    """(node, root): components of the links among the texts of ``segments``.

    rows: (gram, at, size, place) of the first n-grams that several texts hold;
    signs: (at, sign), the signature of each text.
    """
    spark = rows.sparkSession
    labels = spark.createDataFrame([], "node bigint, root bigint")
    rows = bucketed(_told_apart(rows), "jaccard-holders", "gram")
    own = ["gram", "at", "size", "place", "root", "sign"]
    turn, worth = 0, True
    while True:
        held = _held(rows, labels, signs, turn)
        apart = F.col("root") != F.col("lead.root")
        per = held.groupBy("gram").agg(F.count("*").alias("n"),
                                       F.count_if(apart).alias("apart"))
        left = per.agg(F.sum(F.col("n") * F.col("apart")).alias("pairs"),
                       F.sum("n").alias("holders")).first()
        if not left["holders"]:
            return labels
        if turn and left["pairs"] <= max(AT_ONCE, (SOME if worth else FEW) * left["holders"]):
            break
        lead = held.select(*own, "sign2", "lead.*").toDF(
            *own, "sign2", "draw", "at2", "size2", "place2", "root2")
        met = lead.where((F.col("root") != F.col("root2")) & _may_meet(num, den))
        fresh = _links(_ordered(met).distinct(), segments, num, den)
        turn += 1
        n = fresh.count()
        if not n:
            break
        worth = RARE * n > held.agg(F.count_distinct("at")).first()[0]
        labels = _merged(labels, fresh)
    last = _links(_pairs(held.where(apart).select(*own), held.select(*own), num, den),
                  segments, num, den)
    return _merged(labels, last)


def _joined(blocks: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, block, at, leads) of the rows of ``blocks``."""
    texts = written(blocks.select("block", "at", "doc_id",
                                  F.md5(F.coalesce("text", F.lit(""))).alias("digest")),
                    "jaccard-texts")
    classes = texts.groupBy("digest").agg(F.min("at").alias("rep"))
    named = written(texts.join(classes, "digest").select("block", "at", "doc_id", "rep"),
                    "jaccard-classes")
    # Only the first of equal texts takes part; the others are left out of their blocks.
    copies = named.where("at <> rep").groupBy("block").agg(F.collect_set("at").alias("copies"))
    once = blocks.select("block", "at", "text").join(copies, "block", "left").where(
        F.col("copies").isNull() | ~F.array_contains("copies", F.col("at"))) \
        .select("block", "at", "text")
    counted = corpus_classes(once, lambda b: Sets(b, words).held(), ["at", "text"])

    def cut(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["at", "size", "fragment", "grams", "places", "prefix", "sign"]
        if not len(rows):
            return pd.DataFrame(columns=columns)
        out = Sets(rows, words).segments(classes_of(answers), num, den)
        return pd.DataFrame(out, columns=columns).astype({"fragment": "Int32"})

    cut_up = written(once.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(
        cut, "at bigint, size bigint, fragment int, grams array<bigint>, places array<int>, "
             "prefix bigint, sign array<bigint>"), "jaccard-sets")
    shared = cut_up.where("fragment is not null")
    segments = bucketed(shared.select("at", "fragment", "grams"), "jaccard-segments",
                        "at", "fragment")
    first = shared.select("at", "size", "prefix", F.explode(F.arrays_zip("grams", "places"))
                          .alias("g")).where("g.places < prefix").select(
        F.col("g.grams").alias("gram"), "at", "size", F.col("g.places").alias("place"))
    # Each fragment of a text has its whole signature.
    signs = bucketed(shared.groupBy("at").agg(F.first("sign").alias("sign")).select(
        "at", F.struct(*[F.col("sign")[i].alias(f"s{i}") for i in range(SIGN + 1)]).alias("sign")),
        "jaccard-signs", "at")
    labels = similar_components(bucketed(first, "jaccard-prefixes", "gram"), segments, signs,
                                num, den)
    sizes = cut_up.groupBy(F.col("at").alias("rep")).agg(F.max("size").alias("n_shingles"))
    every = named.join(sizes, "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    # An empty set links with nothing, not even with its copies.
    every = written(every.select("block", "at", "doc_id", "n_shingles", F.when(
        F.col("n_shingles") == 0, F.col("at")).otherwise(F.coalesce("root", "rep")).alias("root")),
        "jaccard-roots")
    least = every.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    lead = every.join(least, "root").where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("root").agg(F.min("at").alias("lead"))
    return every.join(least, "root").join(lead, "root").select(
        "doc_id", "n_shingles", "component_id", "block", "at",
        (F.col("at") == F.col("lead")).alias("leads"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least id reachable by links),
    and leads, true for the one row of each component that stands for it."""
    blocks = text_blocks(narrow(docs, id_col, text_col))
    return _joined(blocks, words, num, den).select("doc_id", "n_shingles", "component_id", "leads")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of ``docs`` that stand for their components, with all their columns."""
    blocks = text_blocks(packed(docs, id_col, text_col))
    leads = _joined(blocks, words, num, den).where("leads").groupBy("block").agg(
        F.collect_set("at").alias("leads"))
    kept = blocks.join(leads, "block").where(F.array_contains("leads", F.col("at")))
    return unpacked(kept, docs.columns, text_col)




def oracle(words: int = WORDS, num: int = NUM, den: int = DEN) -> str:
    """The same in SQL: all pairs of documents that share an n-gram; ids must be unique."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(ws, i, i + {words - 1}), ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {words - 2}, 2))) AS i
            FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b
      ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE {den} * x >= {num} * (na.n + nb.n - x)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, least) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT u.b, r.least FROM r JOIN u ON u.a = r.doc_id WHERE r.least < u.b)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(least) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""
