import random

import pytest

#: Names that the operators use inside, and a source.
CLASHING = {"row": 1, "block": 2, "at": 3, "rest": "r", "words": "w", "h1": 4, "g": 5, "n": 6, "th": 7,
            "id": 8, "key": 9, "body": "b", "kept": True, "size": 10}


@pytest.fixture()
def table(spark):
    """Documents of [(doc_id, text)] or [(doc_id, text, source)], with clashing extra columns."""
    def make(rows):
        out = [(r[0], r[1], r[2] if len(r) > 2 else "s", *CLASHING.values()) for r in rows]
        types = {int: "bigint", str: "string", bool: "boolean"}
        schema = "doc_id bigint, text string, source string, " + ", ".join(
            f"{k} {types[type(v)]}" for k, v in CLASHING.items())
        return spark.createDataFrame(out, schema)
    return make


def prose(rng, n, vocabulary=60):
    return " ".join(rng.choice(["la", "ki", "mo", "Te", "sun,", "über", "x"]) +
                    str(rng.randrange(vocabulary)) for _ in range(n))


@pytest.fixture()
def corpus():
    """[(doc_id, text)]: prose, copies, near copies, repeats, and every edge case."""
    rng = random.Random(5)
    docs = [prose(rng, rng.randrange(5, 90)) for _ in range(30)]
    lines = ["\n".join(prose(rng, 6, 1000) for _ in range(rng.randrange(2, 9))) for _ in range(20)]
    shared = [prose(rng, 7, 1000) for _ in range(6)]
    for i in range(0, 20, 2):
        parts = lines[i].split("\n")
        cut = rng.randrange(len(parts))
        lines[i] = "\n".join(parts[:cut] + shared[rng.randrange(2):4 + rng.randrange(3)]
                             + ["", "  "] + parts[cut:])
    near = []
    for t in docs[:8]:
        ws = t.split(" ")
        for _ in range(4):
            k = rng.randrange(len(ws))
            near.append(" ".join(ws[:k] + ["changed"] + ws[k + 1:]))
    edge = ["", None, " \n\t ", "one", "two words", "Two Words", "a b c d e", "a b c d", None, "",
            "rep eat " * 40, "x" * 70, "\n".join(["same line here"] * 9), "###  $$ | <a>"]
    every = docs + lines + near + docs[:5] + edge
    rng.shuffle(every)
    rows = [(3 * i + 1, t) for i, t in enumerate(every)]
    return rows + [rows[4], (rows[4][0], "other text with the same id"), (None, docs[3]),
                   (None, docs[3]), (None, None), (-7, docs[9])]
