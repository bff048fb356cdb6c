"""Document fingerprints: SimHash, and search within a Hamming radius.

A text's terms are its runs of ``shingle`` successive words (the whole sequence
of a shorter text). Each term has ``halves`` 64-bit hashes and a weight, the
number of its characters up to ``MAX_WEIGHT``; for each bit the weights of the
terms vote for or against, and the fingerprint has the bits that won (ties lose).
Votes are ordinary sums of a grouped aggregate; two bits share one sum, in its
lower and upper 32 bits, which holds for texts of up to 2**30 characters.

Search: near copies, that is texts with a Jaccard similarity of 0.75 or more on
five-word shingles, differ in up to about 28 of the 128 bits (measured), texts that have
nothing in common in 36 or more; the radius lies between. The fingerprint is cut
into ``blocks`` blocks, each with a radius of its own, such that these radii plus
one sum to ``radius`` + 1: two fingerprints within ``radius`` bits are then within
the block's radius in at least one block. Each block has a table of the
fingerprints by its bits, and a query asks there for every value within the
block's radius, so the search is exact. Fingerprints of one value are packed into
arrays of about ``PACK`` and compared inside them: no row is made per pair, and a
large group of near copies is a few arrays of each value. Equal fingerprints are
one class before that, so copies make no comparisons.

All DataFrame and SQL functions. Edge cases: a null or empty text has no terms
and the fingerprint of all zeros; rows with the same id, or with a null one
(which come last), are ordered by their text; a single document is its own
successor; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import narrow, words, written

SHINGLE = 2
HALVES = 2                  # fingerprints of 128 bits
MAX_WEIGHT = 24
RADIUS, BLOCKS = 30, 8
#: Fingerprints in one array of a block's value.
PACK = 1024
#: Ids that agree but for their last GROUP_BITS form the groups in which successors are found.
GROUP_BITS = 10


def _terms(texts: DataFrame, keys: list[str], shingle: int) -> DataFrame:
    """(*keys, t, n) of (*keys, text): arrays of the hash and the characters of each term."""
    out = texts.select(*keys, words(F.col("text")).alias("ws")).select(
        *keys, F.transform("ws", lambda w: F.xxhash64(w)).alias("h"),
        F.transform("ws", lambda w: F.char_length(w)).alias("l"))
    out = out.withColumn("t", F.col("h")).withColumn("n", F.col("l"))
    for by in range(1, shingle):
        # Each term takes in the word ``by`` places on; the last ones get none.
        rest = [F.slice(c, F.lit(by + 1), F.size("h")) for c in ("h", "l")]
        out = out.withColumn("t", F.zip_with("t", rest[0], lambda a, b: F.xxhash64(a, b))) \
                 .withColumn("n", F.zip_with("n", rest[1], lambda a, b: a + F.coalesce(b, F.lit(0))))
    whole = F.greatest(F.size("t") - (shingle - 1), F.least(F.size("t"), F.lit(1)))
    return out.select(*keys, F.slice("t", F.lit(1), whole).alias("t"), "n")


def fingerprints(texts: DataFrame, keys: list[str], shingle: int = SHINGLE,
                 halves: int = HALVES) -> DataFrame:
    """(*keys, f) of (*keys, text): f, an array of ``halves`` bigints. Keys must be unique."""
    terms = _terms(texts, keys, shingle)
    each = terms.select(*keys, "n", F.posexplode_outer("t").alias("i", "t")).select(
        *keys, F.col("t").alias("h0"),
        F.least(F.coalesce(F.get("n", F.col("i")), F.lit(0)), F.lit(MAX_WEIGHT)).cast("bigint")
         .alias("w"))
    each = each.select(*keys, "w", F.coalesce("h0", F.lit(0)).alias("h0"),
                       *[F.xxhash64("h0", F.lit(k)).alias(f"h{k}") for k in range(1, halves)])
    two = F.lit((1 << 32) + 1)
    votes = each.groupBy(*keys).agg(F.sum("w").alias("w"), *[
        F.sum(F.shiftrightunsigned(f"h{k}", j).bitwiseAND(two) * F.col("w")).alias(f"v{k}_{j}")
        for k in range(halves) for j in range(32)])

    def bits(k: int) -> Column:
        f = F.lit(0).cast("bigint")
        for j in range(32):
            v = F.col(f"v{k}_{j}")
            for at, count in ((j, v.bitwiseAND(F.lit((1 << 32) - 1))),
                              (j + 32, F.shiftrightunsigned(v, 32))):
                f = f.bitwiseOR(F.shiftleft((2 * count > F.col("w")).cast("bigint"), at))
        return f

    return votes.select(*keys, F.array(*[bits(k) for k in range(halves)]).alias("f"))


def hamming(a: Column, b: Column, halves: int = HALVES) -> Column:
    """Bits in which two fingerprints differ."""
    return sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
                for k in range(halves)), F.lit(0))


def as_hex(f: Column, halves: int = HALVES) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(F.get(f, F.lit(k))), 16, "0") for k in range(halves)]))


def _edges(blocks: int, halves: int) -> list[tuple[int, int]]:
    """First bit and end of each block."""
    edges = [64 * halves * b // blocks for b in range(blocks + 1)]
    return list(zip(edges, edges[1:]))


def _radii(radius: int, blocks: int) -> list[int]:
    """The radius of each block, -1 for one that is not asked; these plus one sum to radius + 1."""
    whole, over = divmod(radius + 1, blocks)
    return [whole - 1 + (b < over) for b in range(blocks)]


def _signed(m: int) -> int:
    return m - (1 << 64) if m >= 1 << 63 else m


def _blocks(f: Column, blocks: int, halves: int) -> list[Column]:
    """The bits of each of ``blocks`` blocks of the fingerprint, of 64 bits at most."""
    out = []
    for lo, hi in _edges(blocks, halves):
        value = F.lit(0).cast("bigint")
        for k in range(lo // 64, (hi - 1) // 64 + 1):
            at, end = max(lo, 64 * k), min(hi, 64 * (k + 1))
            bits = F.shiftrightunsigned(F.get(f, F.lit(k)), at - 64 * k).bitwiseAND(
                F.lit(_signed((1 << (end - at)) - 1)))
            value = value.bitwiseOR(F.shiftleft(bits, at - lo))
        out.append(value)
    return out


def _flips(width: int, radius: int) -> str:
    """All masks of ``width`` bits with up to ``radius`` ones."""
    return ",".join(str(_signed(sum(1 << b for b in bits))) for n in range(radius + 1)
                    for bits in combinations(range(width), n))


def _asked(queries: DataFrame, classes: DataFrame, radius: int, blocks: int,
           halves: int) -> DataFrame:
    """(q, t, members): for each f of ``queries`` the arrays of rows of ``classes``, as structs,
    that share a block's value within its radius."""
    radii = _radii(radius, blocks)

    def keyed(df: DataFrame, *columns: Column) -> DataFrame:
        return df.select(*columns, F.posexplode(F.array(*_blocks(F.col("f"), blocks, halves)))
                         .alias("t", "key"))

    flips = F.array(*[F.split(F.lit(_flips(hi - lo, r)), ",").cast("array<bigint>")
                      if r >= 0 else F.array().cast("array<bigint>")
                      for (lo, hi), r in zip(_edges(blocks, halves), radii)])
    probes = keyed(queries, F.col("f").alias("q")).select(
        "q", "t", F.explode(F.transform(F.get(flips, F.col("t")),
                                        lambda m: F.col("key").bitwiseXOR(m))).alias("key"))
    rows = keyed(classes, F.struct(*classes.columns).alias("c"))
    # A value of many fingerprints has several arrays, so that no array is long.
    many = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > PACK)
    dealt = rows.join(many, ["t", "key"], "left").withColumn(
        "part", F.pmod(F.xxhash64("c.f"), F.coalesce(F.ceil(F.col("n") / PACK), F.lit(1))))
    packed = written(dealt.groupBy("t", "key", "part").agg(F.collect_list("c").alias("members")),
                     "simhash-packs")
    # Spark sizes an explode as the table before it: probes, thousands for each query, look small
    # enough to broadcast when they are not.
    return probes.join(packed.hint("merge"), ["t", "key"]).select("q", "t", "members")


def _met(q: Column, t: Column, f: Column, radius: int, blocks: int, halves: int) -> Column:
    """Whether f is within the radius of q, and t the first block that shows it."""
    qb, fb = _blocks(q, blocks, halves), _blocks(f, blocks, halves)
    first = F.coalesce(*[F.when(F.bit_count(a.bitwiseXOR(b)) <= r, F.lit(k)) for k, (a, b, r)
                         in enumerate(zip(qb, fb, _radii(radius, blocks)))])
    return F.when(hamming(q, f, halves) <= radius, first == t).otherwise(F.lit(False))


def within_radius(queries: DataFrame, classes: DataFrame, radius: int = RADIUS,
                  blocks: int = BLOCKS, halves: int = HALVES) -> DataFrame:
    """(q, f, distance): every f of ``classes`` within ``radius`` bits of each q of ``queries``.

    queries: (f), classes: (f); both with distinct rows. A pair comes out of the first
    block only that is within its radius.
    """
    found = _asked(queries, classes, radius, blocks, halves)
    hits = F.filter("members", lambda c: _met(F.col("q"), F.col("t"), c["f"], radius, blocks, halves))
    return found.select("q", F.explode(hits).alias("c")).select(
        "q", F.col("c.f").alias("f"), hamming(F.col("q"), F.col("c.f"), halves).alias("distance"))


def _groups(docs: DataFrame) -> DataFrame:
    """(g, first_id, next_g, next_id) of each group of ids that has rows.

    One row for 2**GROUP_BITS ids is put in order as a whole; the texts are not.
    """
    firsts = docs.groupBy("g").agg(F.min("doc_id").alias("first_id"))
    up = Window.orderBy("g")
    every = Window.partitionBy(F.lit(0))
    firsts = firsts.withColumn("pair", F.struct("g", "first_id"))
    nxt = F.coalesce(F.lead("pair").over(up), F.min("pair").over(every))
    return firsts.select("g", nxt.alias("next")).select(
        "g", F.col("next.g").alias("next_g"), F.col("next.first_id").alias("next_id"))


def with_successor(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, at, doc_id, text, next_text) of (doc_id, text), and the groups; (g, at) is unique.

    Each group of ids is ordered on its own; a guard row, the first one of the
    next group, stands behind its last row.
    """
    far = (1 << 62)         # the group of null ids, after all others
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumn(
        "g", F.coalesce(F.shiftright("doc_id", GROUP_BITS), F.lit(far)))
    groups = written(_groups(rows.select("g", "doc_id")), "simhash-groups")
    ends = groups.select(F.col("g").alias("prev_g"), F.col("next_g").alias("g"),
                         F.col("next_id").alias("first_id"))
    firsts = rows.alias("r").join(
        ends.alias("e"), (F.col("r.g") == F.col("e.g"))
        & F.col("r.doc_id").eqNullSafe(F.col("e.first_id")))
    # Several rows with the first id: the first by text.
    guards = firsts.groupBy("prev_g").agg(F.min(F.struct("r.text")).alias("m")) \
        .select(F.col("prev_g").alias("g"), F.lit(None).cast("bigint").alias("doc_id"),
                F.col("m.text").alias("text"), F.lit(1).alias("guard"))
    every = rows.withColumn("guard", F.lit(0)).unionByName(guards)
    order = Window.partitionBy("g").orderBy("guard", F.col("doc_id").asc_nulls_last(), "text")
    ordered = every.select("g", F.row_number().over(order).alias("at"), "doc_id", "text", "guard",
                           F.lead("text").over(order).alias("next_text"))
    return ordered.where("guard = 0").drop("guard"), groups


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle: int = SHINGLE, halves: int = HALVES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, f, edited_f, next_f.

    The edited text is the text with its last quarter replaced by as much of the
    beginning of the next document.
    """
    rows = narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    ordered, groups = with_successor(rows)
    cut = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - cut),
                      F.substring("next_text", F.lit(1), cut))
    both = ordered.select("g", "at", "doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
                          "text", edited.alias("edited"))
    keys = ["g", "at", "doc_id", "n_chars", "edited_sha256"]
    texts = both.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *keys, F.explode(F.array(F.struct(F.lit(0).alias("edit"), F.col("text").alias("text")),
                                 F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text"))))
        .alias("s")) \
        .select(*keys, "s.edit", "s.text")
    prints = written(fingerprints(texts, [*keys, "edit"], shingle, halves), "simhash-prints")
    of = prints.where("edit = 0").drop("edit")
    ed = prints.where("edit = 1").select("g", "at", F.col("f").alias("edited_f"))
    step = Window.partitionBy("g").orderBy("at")
    of = of.withColumn("lead_f", F.lead("f").over(step))
    heads = prints.where("edit = 0 and at = 1").select(F.col("g").alias("next_g"),
                                                      F.col("f").alias("head_f"))
    heads = groups.select("g", "next_g").join(heads, "next_g").select("g", "head_f")
    return of.join(ed, ["g", "at"]).join(heads, "g").select(
        "doc_id", "n_chars", "edited_sha256", "f", "edited_f",
        F.coalesce("lead_f", "head_f").alias("next_f"))


def count_near(prints: DataFrame, every: int = 50, radius: int = RADIUS, blocks: int = BLOCKS,
               halves: int = HALVES) -> DataFrame:
    """(q, n_near): rows within ``radius`` of each fingerprint of the rows with id divisible
    by ``every``, themselves included. prints: (doc_id, f)."""
    classes = prints.groupBy("f").agg(
        F.count("*").alias("n"),
        F.max(F.coalesce(F.col("doc_id") % every == 0, F.lit(False))).alias("asked"))
    classes = written(classes, "simhash-classes")
    found = _asked(classes.where("asked").select("f"), classes.select("f", "n"), radius, blocks,
                   halves)
    near = F.aggregate("members", F.lit(0).cast("bigint"), lambda s, c: s + F.when(
        _met(F.col("q"), F.col("t"), c["f"], radius, blocks, halves), c["n"]).otherwise(F.lit(0)))
    return found.select("q", near.alias("n_near")).groupBy("q").agg(F.sum("n_near").alias("n_near"))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       every: int = 50) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_near (other rows within the radius, for ids divisible by ``every``)."""
    prints = written(fingerprint_documents(docs, id_col, text_col), "simhash-report")
    near = count_near(prints.select("doc_id", "f"), every)
    like = lambda other: 1.0 - hamming(F.col("f"), F.col(other)) / F.lit(64.0 * HALVES)
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    out = prints.withColumn("q", F.when(asked, F.col("f"))).join(near, "q", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("f")).alias("fingerprint"),
        as_hex(F.col("edited_f")).alias("edited_fingerprint"),
        like("edited_f").alias("near_edited"), like("next_f").alias("near_next"),
        F.when(asked, F.col("n_near") - 1).alias("n_near"))
