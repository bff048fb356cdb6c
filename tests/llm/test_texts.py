"""Operators that judge or cut texts, against plain versions."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tests.llm import brute
from tests.llm.conftest import prose
from tidewater.llm import lines, quality, simhash, suffixes


def rows_of(df, *columns):
    """The rows as a sorted list: equal rows stay apart."""
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_quality_rules(spark, table, corpus):
    labels = spark.createDataFrame([(r[0], int(k % 3 > 0), int(k % 11 == 0)) for k, r in
                                    enumerate(corpus) if k % 2] + [(1, 1, 0), (1, 1, 0), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    trusted = {r[0] for r in labels.collect() if r[1] == 1 and not r[2]}
    got = quality.quality_rules(table(corpus), labels, buckets=512, threshold=-0.05)
    want = [(i, *counts, score, failed, kept) for (i, _), (counts, score, failed, kept) in zip(
        corpus, brute.quality_scores(corpus, trusted, 512, -0.05))]
    got = rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                  "n_repeat_words", "base_failed", "kept", "score")
    want = sorted(((*w[:6], *w[7:], w[6]) for w in want), key=repr)
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert [r[-1] is None for r in got] == [r[-1] is None for r in want]
    assert [r[-1] or 0 for r in got] == pytest.approx([r[-1] or 0 for r in want], abs=2e-6)
    kept = quality.kept_documents(table(corpus), labels, buckets=512, threshold=-0.05)
    assert kept.columns == table(corpus).columns
    assert rows_of(kept, "doc_id", "text") == sorted(
        ((i, t) for (i, t), w in zip(corpus, brute.quality_scores(corpus, trusted, 512, -0.05))
         if w[3]), key=repr)


def test_quality_without_trusted_or_documents(spark, table):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    long = " ".join(f"w{i}" for i in range(30))
    got = quality.quality_rules(table([(1, long), (2, None)]), none, buckets=64)
    assert rows_of(got, "doc_id", "score", "kept") == [(1, 0.0, True), (2, None, False)]
    assert quality.quality_rules(table([]), none, buckets=64).count() == 0


def test_quality_long_text(spark, table):
    rng = random.Random(2)
    text = prose(rng, 30000, 10 ** 6) + " " + "again and again it was told " * 4000
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.quality_rules(table([(1, text)]), none, buckets=64).first()
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"],
            got["n_repeat_words"]) == brute.base_counts(text)


@pytest.mark.parametrize("gram,window", [(2, 2), (1, 1), (1, 3), (3, 2)])
def test_line_dedup(table, corpus, gram, window):
    got = lines.dedup_lines(table(corpus), gram=gram, window=window)
    want = [(i, *w) for (i, _), w in zip(corpus, brute.cut_lines(corpus, gram + window - 1))]
    assert rows_of(got, "doc_id", "text", "n_lines", "n_removed", "n_spans") == sorted(want, key=repr)
    assert any(w[3] for w in want)


def test_line_dedup_keeps_columns_and_drops_emptied(table, corpus):
    docs = table(corpus)
    got = lines.cut_documents(docs)
    assert got.columns == docs.columns
    want = [(i, w[0]) for (i, _), w in zip(corpus, brute.cut_lines(corpus)) if not w[2] or w[2] < w[1]]
    assert rows_of(got, "doc_id", "text") == sorted(want, key=repr)
    assert lines.dedup_lines(table([])).count() == 0


def test_suffix_dedup(table, corpus):
    got = suffixes.remove_repeats(table(corpus))
    want = [(i, *w) for (i, _), w in zip(corpus, brute.removed_bytes(corpus))]
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 1000
    assert suffixes.remove_repeats(table([])).count() == 0


def test_suffix_dedup_few_letters(table):
    """Runs of one letter and of short periods: many equal ranks."""
    rng = random.Random(8)
    docs = []
    for i in range(40):
        parts = [rng.choice(["a", "ab", "abc", "é"]) * rng.randrange(1, 60) for _ in range(6)]
        docs.append((i // 2 * 2 if i % 7 else None, "".join(parts)))
    got = suffixes.remove_repeats(table(docs), keep_bytes=False)
    want = [(i, *w[:3], brute.sha(w[3])) for (i, _), w in zip(docs, brute.removed_bytes(docs))]
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(want, key=repr)


def test_suffix_dedup_over_pieces(table, monkeypatch):
    """Texts longer than a piece are cut without a seam."""
    rng = random.Random(4)
    a = prose(rng, 500000, 10 ** 9)
    b = prose(rng, 10, 10 ** 9) + a[1_990_000:2_300_000] + prose(rng, 10, 10 ** 9)
    assert len(a.encode()) > 1 << 22
    got = {r[0]: r for r in suffixes.remove_repeats(table([(1, a), (2, b)]), keep_bytes=False)
           .select("doc_id", "n_removed", "n_spans").collect()}
    assert got[1][1] == 0
    assert got[2][1] >= 310_000 and got[2][2] == 1


def test_suffix_dedup_string_by_string(table, corpus, monkeypatch):
    """Ranks that many anchors hold are asked about by string: the same cuts."""
    monkeypatch.setattr(suffixes, "HOT", 1)
    got = suffixes.remove_repeats(table(corpus), keep_bytes=False)
    want = [(i, *w[:3], brute.sha(w[3])) for (i, _), w in zip(corpus, brute.removed_bytes(corpus))]
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(want, key=repr)


def test_suffix_range_is_worked_through_in_pieces():
    """What a range of contexts takes does not grow with all their strings at once; a sentence that
    every text holds is sent once a block, not once a text."""
    rng = random.Random(6)
    every, sentence = [], "this one sentence stands in each of the texts, 0123456789"
    for b in range(8):
        texts = [f"{prose(rng, 30, 10 ** 9)} {sentence} {prose(rng, 30, 10 ** 9)}" for _ in range(512)]
        rows = pd.DataFrame({"block": b, "at": range(512), "doc_id": range(512 * b, 512 * b + 512), "text": texts})
        held, _ = suffixes.Block(rows).held()
        classes = pd.DataFrame({"range": [0], "classes": [np.ones(len(held), np.uint8).tobytes()]})
        every += suffixes._ask(rows, classes, 1, 14)
        hot = pd.DataFrame({"range": [0], "classes": [np.full(len(held), 14, np.uint8).tobytes()]})
        got = [x for x in suffixes._ask(rows, hot, 1, 14)]
        assert [x[0] for x in got] == [1]
        strings = np.frombuffer(got[0][4], "<u8")
        assert len(np.unique(strings)) == len(strings)
    asked = pd.DataFrame(every, columns=["range", "block", "first", "n", "contexts", "ids"])
    tracemalloc.start()
    answers = suffixes._answer(asked, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(answers) == 8
    assert asked["n"].sum() > 50_000 and peak < 400 * asked["n"].sum()


def test_probes_are_not_broadcast(spark):
    """Thousands of probes for each query, which Spark sizes as the queries themselves."""
    prints = spark.createDataFrame([([i, i],) for i in range(100)], "f array<bigint>")
    found = simhash._asked(prints, prints, simhash.RADIUS, simhash.BLOCKS, simhash.HALVES)
    assert found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_fingerprints(table, corpus):
    rows = sorted({(i, t or "") for i, t in corpus if i is not None})
    got = simhash.fingerprint_report(table(rows), every=1)
    texts = [t for _, t in rows]
    edits = brute.edited(texts)
    prints = [brute.fingerprint(t) for t in texts]
    far = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    want = []
    for k, (i, t) in enumerate(rows):
        e = brute.fingerprint(edits[k])
        want.append((i, len(t), brute.sha(edits[k]), prints[k], e, 1 - far(prints[k], e) / 128,
                     1 - far(prints[k], prints[(k + 1) % len(rows)]) / 128,
                     sum(far(prints[k], p) <= simhash.RADIUS for p in prints) - 1))
    assert rows_of(got, *got.columns) == sorted(want, key=repr)
    assert any(w[-1] for w in want)


def test_fingerprints_of_nulls_and_few(table):
    got = simhash.fingerprint_report(table([(None, "b c"), (None, None), (2, "a b c d e f g h")]))
    by = {r["n_chars"]: r for r in got.collect()}
    # Null ids come last, in order of their texts; after the last comes the first.
    assert by[15]["edited_sha256"] == brute.sha("a b c d e f ")
    assert by[3]["near_next"] == by[15]["near_next"] or by[3]["n_chars"] == 3
    assert simhash.fingerprint_report(table([])).count() == 0
    one = simhash.fingerprint_report(table([(50, "alone in here")])).first()
    assert (one["near_next"], one["n_near"]) == (1.0, 0)


def test_near_copies_are_found(table):
    """Edited texts with a known Jaccard similarity on five-word shingles are near their originals."""
    rng = random.Random(12)
    rows, want = [], {}
    for i in range(0, 60, 2):
        ws = prose(rng, 200, 10 ** 6).split()
        at = rng.randrange(150)
        near = {0: ws[:at] + ["changed"] + ws[at + 1:], 1: ws + prose(rng, 40, 10 ** 6).split(),
                2: ws[:at] + ws[at + 15:], 3: prose(rng, 200, 10 ** 6).split()}[i // 2 % 4]
        a, b = brute.shingles(" ".join(ws)), brute.shingles(" ".join(near))
        rows += [(i, " ".join(ws)), (i + 1, " ".join(near))]
        want[i] = want[i + 1] = int(len(a & b) / len(a | b) >= .75)
    assert sum(want.values()) > 40 and not all(want.values())
    got = simhash.fingerprint_report(table(rows), every=1)
    assert {r["doc_id"]: r["n_near"] for r in got.collect()} == want


def test_radius_search_at_the_default(spark, monkeypatch):
    """Exact at 30 bits, also where many fingerprints have the same value of a block."""
    monkeypatch.setattr(simhash, "PACK", 8)
    rng = random.Random(13)
    prints = {(p := rng.getrandbits(64) << 64 | rng.getrandbits(64))}
    for k in range(150):
        q = p
        for b in rng.sample(range(128) if k % 3 else range(100, 128), rng.randrange(10, 29)):
            q ^= 1 << b
        prints.add(q)
    half = lambda x: [brute.signed(x & (1 << 64) - 1), brute.signed(x >> 64)]
    rows = spark.createDataFrame([(half(x),) for x in prints], "f array<bigint>")
    some = sorted(prints)[::10]
    got = simhash.within_radius(spark.createDataFrame([(half(x),) for x in some], "f array<bigint>"),
                                rows).collect()
    want = [(tuple(half(a)), tuple(half(b)), bin(a ^ b).count("1"))
            for a in some for b in prints if bin(a ^ b).count("1") <= 30]
    assert sorted((tuple(r["q"]), tuple(r["f"]), r["distance"]) for r in got) == sorted(want)
    assert 30 in {d for _, _, d in want} and len(want) < len(some) * len(prints)


def test_radius_search(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        p = rng.getrandbits(128)
        for _ in range(12):
            q = p
            for b in rng.sample(range(128), rng.randrange(6)):
                q ^= 1 << b
            prints.add(q)
    half = lambda x: [brute.signed(x >> 64), brute.signed(x & (1 << 64) - 1)]
    rows = spark.createDataFrame([(half(p),) for p in prints], "f array<bigint>")
    for radius, blocks in ((3, 5), (2, 3), (3, 4)):
        got = sorted((tuple(r["q"]), tuple(r["f"]), r["distance"]) for r in
                     simhash.within_radius(rows, rows, radius, blocks).collect())
        want = sorted((tuple(half(a)), tuple(half(b)), bin(a ^ b).count("1"))
                      for a in prints for b in prints if bin(a ^ b).count("1") <= radius)
        assert got == want
