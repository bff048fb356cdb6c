"""Operators over many documents: Jaccard join, mixing, the pipeline; and SQL for what has it."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import prose
from tidewater.llm import graph, jaccard, mixing, queries, quality
from tidewater.sources.tables import TABLES
from tools.check_oracle import digest


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(queries.ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[:3] == digest(
        rel.columns, rel.fetchall())[:3]


def check_components(df, rows):
    got = sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    want = []
    for (i, _), (n, group) in zip(rows, brute.components(rows)):
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        want.append((i, n, min(ids) if ids else None))
    assert got == sorted(want, key=repr)
    return want


def test_jaccard_join(table, corpus):
    rows = corpus + [(2000, corpus[0][1].upper()), (2001, "a b c d e a b c d e a b c d e")]
    want = check_components(jaccard.jaccard_join(table(rows)), rows)
    assert sum(i != c for i, _, c in want) > 20
    assert jaccard.jaccard_join(table([])).count() == 0


def test_jaccard_chains_and_large_groups(table):
    """Groups in which most pairs are not similar enough, but chains of links go through all."""
    rng = random.Random(6)
    rows = []
    for _ in range(6):
        ws = prose(rng, 60, 10 ** 6).split()
        for _ in range(40):
            rows.append((rng.randrange(10 ** 6), " ".join(ws)))
            k = rng.randrange(len(ws))
            ws[k:k + 1] = [prose(rng, 1, 10 ** 6)] * rng.randrange(3)
    common = prose(rng, 40, 10 ** 6)
    rows += [(rng.randrange(10 ** 6), f"{prose(rng, rng.randrange(4, 30), 10 ** 6)} {common}")
             for _ in range(60)]
    rng.shuffle(rows)
    want = check_components(jaccard.jaccard_join(table(rows)), rows)
    assert len({c for _, _, c in want}) < len(rows) / 2


def test_jaccard_pairs_are_met_once(table, monkeypatch):
    """Pairs that share many n-grams are not met again at each of them."""
    rng = random.Random(9)
    rows, held, own = [], [], jaccard._held
    for _ in range(30):
        ws = prose(rng, 80, 10 ** 6).split()
        rows += [(len(rows), " ".join(ws)), (len(rows) + 1, " ".join([*ws[:-12], prose(rng, 12, 10 ** 6)]))]
    monkeypatch.setattr(jaccard, "_held", lambda *a: held.append(own(*a)) or held[-1])
    check_components(jaccard.jaccard_join(table(rows)), rows)
    assert 0 < held[0].count() <= len(rows)


def test_jaccard_texts_far_apart_make_no_pairs(table, monkeypatch):
    """Texts that share many n-grams and do not link are not compared pair by pair."""
    rng = random.Random(12)
    pool = [prose(rng, 12, 10 ** 6) for _ in range(30)]
    rows = [(i, " ".join(pool[k] for k in sorted(rng.sample(range(30), 15)))) for i in range(40)]
    rows += [(i + 100, text.rsplit(" ", 3)[0]) for i, text in rows[:5]]
    made, own = [], jaccard.overlaps
    monkeypatch.setattr(jaccard, "overlaps", lambda pairs, s: made.append(pairs) or own(pairs, s))
    check_components(jaccard.jaccard_join(table(rows)), rows)
    assert 0 < sum(p.count() for p in made) <= len(rows)


def test_signatures_count_no_less_than_is_shared():
    """What two signatures leave room for is the overlap at least, whatever the sizes."""
    rng = np.random.default_rng(3)
    for n in (1, 20, 300, 5000):
        both, one, two = (rng.integers(0, 1 << 63, size, dtype=np.uint64) for size in (n, n // 3, n // 2))
        doc = np.repeat([0, 2], [len(both) + len(one), len(both) + len(two)])
        a, none, b = jaccard.signatures(doc, np.r_[both, one, both, two], 3)
        assert a.shape == (1 + jaccard.SIGN,) and not none.any()
        odd = sum(int(x).bit_count() for x in (a[1:] ^ b[1:]).view(np.uint64))
        assert n <= (a[0] + b[0] - odd) / 2
        assert n > 300 or (a[0] + b[0] - odd) / 2 <= n + n / 4


def test_jaccard_rounds_lose_no_link(table, monkeypatch):
    """With hardly anything compared directly, rounds and the last comparison find all groups."""
    monkeypatch.setattr(jaccard, "AT_ONCE", 0)
    rng = random.Random(4)
    ws, rows = prose(rng, 60, 10 ** 6).split(), []
    for i in range(60):
        rows.append((i, " ".join(ws)))
        ws[rng.randrange(len(ws))] = prose(rng, 1, 10 ** 6)
    rng.shuffle(rows)
    check_components(jaccard.jaccard_join(table(rows)), rows)


def test_one_of_each_group_stays(table, corpus):
    docs = table(corpus)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {tuple(g) for _, g in brute.components(corpus)}
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert len(rows) == len(groups)
    for g in groups:
        assert sum(rows.count(r) for r in {tuple(corpus[k]) for k in g}) >= 1


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(510, 540)] + [(7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    root = {x: x for e in links for x in e}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def mixable(n=700, seed=3):
    rng = random.Random(seed)
    sources = ["big"] * 12 + ["a", "b", "c", None, "Ä"]
    rows = [(i, prose(rng, min(400, int(rng.paretovariate(.9) * 4))), rng.choice(sources))
            for i in range(n)]
    return rows + [(3, None, "a"), (4, "", "void"), (5, " \n", "void"), rows[9], rows[9],
                   (rows[8][0], "another text of the same id", "b"), (None, "null id here", "c")]


@pytest.mark.parametrize("fan_in", [4, 128])
def test_mixing(table, fan_in):
    rows = mixable()
    got = mixing.mix_sources(table(rows), fan_in=fan_in).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    goal = brute.targets(size)
    want = brute.mix(rows, fan_in)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert r["copies"] == want[r["doc_id"], r["row"]]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    for s, g in goal.items():
        taken = sum(r["taken"] for r in got if r["source"] == s)
        biggest = max(r["size"] for r in got if r["source"] == s)
        assert abs(taken - g) <= max(.2 * g, 2 * biggest)


def test_mixing_limits_and_empties(table):
    rows = [(i, "w " * 10, "small") for i in range(5)] + [(i, "w " * 300, "large") for i in range(9, 30)]
    got = mixing.mix_sources(table(rows)).collect()
    # "large" weighs 1 and "small" 2, which stops at three times its size.
    assert {r["target"] for r in got if r["source"] == "small"} == {150.0}
    assert all(r["copies"] == 3 for r in got if r["source"] == "small")
    assert mixing.mix_sources(table([])).count() == 0
    assert [r["taken"] for r in mixing.mix_sources(table([(1, None), (2, "")])).collect()] == [0, 0]
    docs = table(mixable(60))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in mixing.mix_sources(docs).collect())


def test_mixing_of_rows_that_stand_in_two_sources(table):
    """The same ids and texts in each source are rows of their own."""
    texts = [(i, "w " * (3 + i % 4)) for i in range(30)]
    rows = [(i, t, s) for i, t in texts for s in ("A", "B", None)] + [(90 + i, "x " * 50, "C") for i in range(20)]
    docs = table(rows)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    for s in ("A", "B", None, "C"):
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * max(r["size"] for r in own)
    mixed = {(r["doc_id"], r["source"]): r["n"] for r in
             mixing.mixed_documents(docs).groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    assert mixed == {(r["doc_id"], r["source"]): r["copies"] for r in got if r["copies"]}


def test_mixing_is_fair_and_repeats(table):
    """Over seeds each document is taken as often as its share says."""
    rows = [(i, prose(random.Random(i), 5 + i % 9), "xyz"[i % 3]) for i in range(60)]
    total = {}
    for seed in range(40):
        for k, n in brute.mix(rows, 8, seed).items():
            total[k] = total.get(k, 0) + n
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    goal = brute.targets(size)
    for i, t, s in rows:
        assert abs(total[i, brute.xx(t)] / 40 - goal[s] / size[s]) < .35
    once = mixing.mix_sources(table(rows)).orderBy("doc_id").collect()
    assert once == mixing.mix_sources(table(rows[::-1]).repartition(5)).orderBy("doc_id").collect()


def test_pipeline_equals_plain_version(spark):
    con = duckdb.connect()
    docs = con.sql(f"SELECT doc_id, text, source FROM read_parquet('{SF_SMALL}/documents.parquet')"
                   " ORDER BY doc_id").fetchall()
    labels = con.sql(f"SELECT doc_id FROM read_parquet('{SF_SMALL}/labels.parquet')"
                     " WHERE quality = 1 AND toxic = 0").fetchall()
    judged = brute.quality_scores([d[:2] for d in docs], {x[0] for x in labels}, quality.BUCKETS,
                                  quality.THRESHOLD)
    docs = [d for d, j in zip(docs, judged) if j[-1]]
    cut = brute.cut_lines([d[:2] for d in docs])
    docs = [(i, c[0], s) for (i, _, s), c in zip(docs, cut) if not c[2] or c[2] < c[1]]
    groups = {min(docs[k][0] for k in g) for _, g in brute.components([d[:2] for d in docs])}
    docs = [d for d in docs if d[0] in groups]
    copies = brute.mix(docs)
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary(queries.PIECES))
    want = []
    for i, t, _ in docs:
        ids = lib.encode(t)
        want += [(i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(lib.decode(ids)),
                  len(t.encode()))] * copies[i, brute.xx(t)]
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_take_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs.where("false"), SF_SMALL)
        assert out.count() == 0
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
