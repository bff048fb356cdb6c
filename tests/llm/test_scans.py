"""Licence scans, tokens of two tokenizers and phrases, against plain versions and libraries."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import prose
from tidewater.llm import align, licenses, phrases
from tidewater.llm.common import written
from tidewater.llm.pieces import model_bytes

BYTES, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- licences

LICENCED = [
    (801, "Licensed under the Apache License, Version 2.0 (the x)"), (802, "the apache-license. APACHE LICENSE"),
    (803, "gnu general public LICENSE gnu general public license"), (804, "CC BY-NC 4.0 and cc  by"),
    (805, "Permission is hereby granted, free of charge, to every person who gets a copy of this software and"
          " associated documentation files, to deal in the Software without restriction, including without"
          " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense and/or sell copies"
          " of the Software"),
    (806, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal"
          " in it with some restriction"),
    (807, "MITé License mit\x00license mit7license"), (808, "general gnu public license apache the license cc nc by"),
    (809, "released under the MIT license " * 30), (810, "gnu " * 5000 + "gnu general public license" + " gnu" * 5000)]


def test_base_phrases_and_notices(table, corpus):
    rows = corpus + LICENCED + [LICENCED[0], (None, LICENCED[2][1])]
    matches = licenses.license_matches(table(rows))
    got = licenses.license_digests(matches)
    want = sorted(((i, *brute.base_licences(t)) for i, t in rows), key=repr)
    assert rows_of(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    labels = {r.doc_id: (set(r.labels.split(",")) - {""}, r.score) for r in got.collect()}
    assert labels[801] == ({"apache", "apache-2.0"}, 1.0)
    assert labels[805][0] == {"mit-notice"} and .7 <= labels[805][1] < 1
    assert labels[806] == (set(), 0.0)          # without its mandatory phrase
    assert labels[804][0] == {"cc-by", "cc-by-nc"} and labels[808] == (set(), 0.0)
    spans = [m for m in matches.where("doc_id = 809").first().matches if m.label == "mit-line"]
    assert [(m.start, m.end) for m in spans] == [(5 * k, 5 * k + 5) for k in range(30)]
    assert licenses.license_digests(licenses.license_matches(table([]))).count() == 0


def test_index_misses_no_match(spark, table):
    """Every place of every template is tried by the plain version."""
    rng = random.Random(4)
    templates = [licenses.Template("one", "alpha beta gamma delta beta", ("beta gamma",), .6, 1),
                 licenses.Template("two", "gamma omega the the alpha", (), .5, 2),
                 licenses.Template("three", "the omega", ("the omega",), 1.0, 0)]
    words = ["alpha", "beta", "gamma", "delta", "omega", "the", "x", "the", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 14)))) for i in range(150)]
    got = {r.doc_id: {} for r in table(rows).collect()}
    for r in licenses.license_matches(table(rows), templates).collect():
        for m in r.matches:
            if not m.base:
                got[r.doc_id][m.label] = max(m.share, got[r.doc_id].get(m.label, 0))
    scanned = licenses.licence_places(table(rows).select("doc_id", "text"), [*licenses.BASE, *templates])
    number = licenses.vocabulary([*licenses.BASE, *templates])
    weights = licenses.idf_weights(scanned, len(number))
    idf = {w.decode(): weights[i] for w, i in number.items()}
    for i, text in rows:
        assert got[i] == pytest.approx(brute.licence_labels(text, templates, idf)), text


# --- alignment

@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    letters = align._byte_letters()
    vocab = json.load(open(BYTES))["model"]["vocab"]
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    return (a, {i: bytes(letters[c] for c in t) for t, i in vocab.items()}, b,
            [bytes([int(n[3:5], 16)]) if b.is_byte(i) else n.replace("▁", " ").encode()
             for i, n in enumerate(names)])


ODD = ["a▁b", " ", "  x", "x  ", "a\n b\n\n c\t d", "<|endoftext|> <s> <unk>", "\x00", "日本 語", "don't  stop's",
       "　 a　 b\x85 c\x1c d", "𝔘 " * 50, "é" * 300, "word\r\n\r\n next"]


def test_alignment_equals_plain_version(table, corpus, libraries):
    rows = corpus + [(700 + i, t) for i, t in enumerate(ODD)] + [(901, "copy me"), (902, "copy me"), (902, "copy me")]
    got, pairs = align.align_tokenizers(table(rows), BYTES, PIECES)
    want, counts = brute.alignments(rows, *libraries)
    assert rows_of(got, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                   "groups_sha256") == sorted(want, key=repr)
    assert {(r.id_a, r.id_b): r.n for r in pairs.collect()} == counts
    assert align.align_tokenizers(table([]), BYTES, PIECES)[0].count() == 0


def test_cuts_change_nothing(libraries):
    own = align.aligner(model_bytes(BYTES), model_bytes(PIECES))
    assert own.cuts
    rng = random.Random(6)
    for _ in range(4000):
        t = "".join(rng.choice("ab 1  \n\t \x1c\x85　.,'s é𝔘<>") for _ in range(rng.randrange(1, 15)))
        cuts = own.split(t)
        assert "".join(cuts) == " " + t
        assert sum(own.a.encode(cuts), []) == libraries[0].encode(" " + t, add_special_tokens=False).ids
        assert sum(own.b.encode([c[1:] for c in cuts]), []) == libraries[2].encode(t)


def test_other_merge_orders_use_the_library(tmp_path, libraries):
    spec = json.load(open(BYTES))
    spec["model"]["merges"] = spec["model"]["merges"][:900] + spec["model"]["merges"][901:]
    own = align.ByteBPE(json.dumps(spec).encode())
    other = Tokenizer.from_str(json.dumps(spec))
    text = " the rest of the story, which nobody knows"
    assert own.encode([text]) == [other.encode(text, add_special_tokens=False).ids]


# --- phrases

def test_collocations_equal_plain_version(table, corpus):
    rng = random.Random(7)
    words = ["New", "york", "city", "of", "the", "x-1", "l'été", "a"]
    more = [(None, " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(60)))
            for _ in range(40)]
    rows = corpus + more + [(None, "far too long " * 3000), (None, "\t a  b\x0bc\x0cd\r;e: a b!")]
    langs = ["en", None, "und", "", "fr"]
    docs = table([(n, t) for n, (_, t) in enumerate(rows)]).withColumn(
        "lang", F.element_at(F.array(*map(F.lit, langs)), (F.col("doc_id") % 5 + 1).cast("int")))
    kinds = [(langs[n % 5], t) for n, (_, t) in enumerate(rows)]
    for least, percent, top in ((3, 80, 2000), (2, 50, 25)):
        got = phrases.collocations(docs, least, percent, top)
        assert rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score") == sorted(
            brute.collocations(kinds, least, percent, top), key=repr)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_summary_keeps_every_frequent_key():
    rng = np.random.default_rng(8)
    for least in (3, 30):
        stream = rng.zipf(1.3, 60000).astype(np.uint64) % np.uint64(1 << 20)
        own = phrases.Summary(len(stream) // least + 1)
        for part in np.array_split(stream, 17):
            own.merge(*np.unique(part, return_counts=True))
            assert len(own.keys) <= own.size and (own.counts > 0).all() and own.error < least
        keys, counts = np.unique(stream, return_counts=True)
        assert np.isin(keys[counts >= least], own.keys[own.counts + own.error >= least]).all()
        true = dict(zip(keys.tolist(), counts.tolist()))
        assert all(c <= true[k] <= c + own.error for k, c in zip(own.keys.tolist(), own.counts.tolist()))


def test_no_survivor_by_chance(spark):
    rng = random.Random(9)
    rows = [("en", " ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(200))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    sent = written(phrases.sent(phrases.word_blocks(docs), 2), "sent")
    counts = {}
    for r in sent.collect():
        hashes = np.cumsum(phrases.from_planes(bytes(r["hashes"]), "<u8"), dtype=np.uint64).tolist()
        for h, n in zip(hashes, phrases.from_planes(bytes(r["counts"]), "<u4").tolist()):
            counts[h] = counts.get(h, 0) + n
    found = [np.frombuffer(bytes(r["found"]), "<u8") for r in phrases.survivors(sent, 5).collect()]
    assert set(np.concatenate(found).tolist()) == {h for h, n in counts.items() if n >= 5}


def test_entries_of_a_block_are_sent_in_slices(table, monkeypatch):
    """No batch holds a block's entries whole; together they are the same, each range in one row."""
    rng = random.Random(8)
    docs = table([(i, prose(rng, 60, 400)) for i in range(50)]).select(F.lit("en").alias("lang"), "text")
    blocks = phrases.word_blocks(docs).where("n_words > 0").toArrow()

    class Kept:
        def __getattr__(self, name):
            return lambda *a: self if name in ("select", "groupBy") else a[0]

    def batches(most):
        monkeypatch.setattr(phrases, "SLICE_NGRAMS", most, raising=False)
        return [b for block in blocks.to_batches(1) for b in phrases.sent(Kept(), 64)(iter([block]))]

    whole, cut = batches(1 << 40), batches(500)
    rows = lambda bs: sorted(str(r) for b in bs for r in b.to_pylist())
    assert rows(cut) == rows(whole)
    mass = [sum(b.column("mass").to_pylist()) for b in cut]
    assert sum(mass) > 5000 and max(mass) < 2000


def test_products_beyond_64_bits(spark):
    big = 10 ** 16
    found = spark.createDataFrame([("en", "a b", ["a", "b"], big - 1), ("en", "a", ["a"], big), ("en", "b", ["b"], big)],
                                  "lang string, phrase string, words array<string>, f long")
    got = phrases.scored(found).first()
    assert got.score == 2000000 * (big - 1) // (2 * big)
