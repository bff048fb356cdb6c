"""SentencePiece coding and token counts, against the sentencepiece library."""

import random
import struct

import public_tokenizers
import pytest
import sentencepiece

from tests.llm import brute
from tidewater.llm import counts, pieces
from tidewater.llm.pieces import CharMap, Codec, _fields

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = ' ▁  abtheinЖé\n\t\x00𝔘日本<0x41>"​﻿'


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes(PATH)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def odd_texts(n, longest=120):
    rng = random.Random(1)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_codec_equals_library(model, library, corpus):
    codec = Codec(model)
    texts = odd_texts(1500) + [t or "" for _, t in corpus] + ["the" * 3000, "\U0001f600" * 500, " " * 99]
    for t in texts:
        ids, starts, ends = codec.encode(t)
        assert ids == library.encode(t)
        assert codec.decode(ids) == library.decode(ids)
        if t:       # the spans cover the source without gaps
            assert starts[0] == 0 and ends[-1] == len(t.encode()) and list(starts[1:]) == list(ends[:-1])
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(32000) if rng.random() < .5 else rng.randrange(262) for _ in range(9)]
        assert codec.decode(ids) == library.decode(ids)


def test_spans_of_pieces(model):
    codec = Codec(model)
    text = "Hello  wörld\n\U0001d518x"
    ids, starts, ends = codec.encode(text)
    got = [(codec.pieces[i], text.encode()[s:e]) for i, s, e in zip(ids, starts, ends)]
    assert got[0] == ("▁Hello", b"Hello")
    assert ("<0x0A>", b"\n") in got and ("<0x9D>", b"\x9d") in got
    assert b"".join(p for _, p in got) == text.encode()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nfkc"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_normaliser_equals_library(model, rule, squeeze):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True,
                                                remove_extra_whitespaces=squeeze,
                                                escape_whitespaces=True)
    spec = next(v for f, v in _fields(lib.serialized_model_proto()) if f == 3)
    codec = Codec(model)
    codec.map, codec.squeeze = CharMap(dict(_fields(spec))[2]), squeeze
    rng = random.Random(3)
    letters = 'ＡＢＣ ½ﬁ　x  éÅ①ｶﾞ\n\tß▁Ж…㍿​'
    for _ in range(600):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(20)))
        norm, align = codec.normalise(t)
        want, offsets = lib.normalize(t, with_offsets=True)
        at, mine = 0, []
        for c in norm:
            mine.append(int(align[at]))
            at += len(c.encode())
        assert (norm, [*mine, int(align[at])]) == (want, [len(t[:o].encode()) for o in offsets])


def test_encode_decode_and_digests(table, corpus, library):
    docs = table(corpus + [(901, "z" * 100000), (902, t := "tall order " * 20000)])
    coded = pieces.encode_documents(docs, PATH)
    got = sorted(((r[0], list(r[1])) for r in coded.select("doc_id", "ids").collect()), key=repr)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert got == sorted(((i, library.encode(t)) for i, t in rows), key=repr)
    back = pieces.decode_documents(coded, PATH)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        ((i, library.decode(library.encode(t))) for i, t in rows), key=repr)
    digests = pieces.code_digests(docs, PATH)
    want = [(i, len(ids := library.encode(t)), brute.sha(",".join(map(str, ids))),
             brute.sha(library.decode(ids)), len(t.encode())) for i, t in rows]
    assert sorted(map(tuple, digests.collect()), key=repr) == sorted(want, key=repr)
    assert pieces.code_digests(table([]), PATH).count() == 0


def test_cache_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 30)
    monkeypatch.setattr(pieces, "GROUP_CHARS", 100)
    codec = Codec(model)
    texts = odd_texts(200) + ["pq" * 300]
    for t, (ids, _, _) in zip(texts, list(codec.encode_many(texts))):
        assert ids == library.encode(t)
        assert len(codec.older) <= 30 + 120
    assert not any(len(c) > 2 * pieces.SHORT for c in codec.cuts)


def test_merging_side_by_side_and_by_heap(model):
    codec = Codec(model)
    cuts = sorted({c for t in odd_texts(300) for c in codec.split(codec.normalised(t))
                   if len(c) <= pieces.SHORT})
    assert codec._merge_many(cuts) == [codec._merge_heap(list(c)) for c in cuts]


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number, value):
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def unigram(model, scores):
    """The model file with these scores, to be read as a unigram model."""
    out = b""
    for f, v in _fields(model):
        if f == 1:
            d = dict(_fields(v))
            score = struct.pack("<f", scores.get(d[1].decode(), 0.0) if d.get(3, 1) == 1 else 0.0)
            v = _field(1, d[1]) + _varint(2 << 3 | 5) + score + _field(3, d.get(3, 1))
        elif f == 2:
            v = b"".join(_field(3, 1) if g == 3 else
                         _varint(g << 3 | 5) + x if g in (10, 15, 51) else _field(g, x)
                         for g, x in _fields(v))
        out += _field(f, v)
    return out


def test_counts_equal_library(table, corpus, model):
    own = counts.TrieCounts(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram(model, own.scores))
    # Small whole numbers are exact in the library's floats: texts of moderate length.
    texts = odd_texts(1500) + [t or "" for _, t in corpus]
    assert [n for _, n in own.count(texts)] == [len(library.encode(t)) for t in texts]
    got = counts.count_tokens(table(corpus), PATH)
    want = [(i, len(own.codec.split(own.codec.normalised(t or ""))), len(library.encode(t or "")))
            for i, t in corpus]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert counts.count_tokens(table([]), PATH).count() == 0


def test_counts_store_is_bounded(model, monkeypatch):
    monkeypatch.setattr(counts, "STORED", 10)
    small, full = counts.TrieCounts(model), counts.TrieCounts(model)
    long = "abc" * 5000
    for t in odd_texts(60) + [long, long]:
        assert small.count([t]) == full.count([t])
    assert not any(len(w) > counts.LONG for w in full.stored)


def test_shared_prefixes_are_computed_once(model):
    own, asked = counts.TrieCounts(model), []
    own.scores = type("Asked", (dict,), {"get": lambda self, k, d=None: (
        asked.append(k), dict.get(self, k, d))[1]})(own.scores)
    list(own._walk(sorted(["▁interest", "▁interested", "▁interesting"])))
    assert asked.count("▁inter") == 1
