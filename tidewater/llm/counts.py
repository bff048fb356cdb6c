"""Token counts under a unigram model by one dynamic programme over a trie.

The pre-tokens of a batch of documents (runs of spaces and the word after
them, as the model's normaliser writes them) are made distinct and walked in
sorted order, which is the depth-first walk of their trie: the path to the
previous pre-token is kept, and only the nodes below the shared prefix are
computed. A node holds the best forward score of the text that leads to it, and
the number of tokens of that segmentation; the number at a terminal node is the
pre-token's count. A document's count is the sum over its pre-tokens, so no text
leaves its task and nothing is shuffled.

Scores come from the order of the pieces in the model file by Zipf's law
(-ln(rank + 2), in thousandths, as whole numbers): sums are exact, and equal
scores go to the longer last piece. A character that is no piece costs 10 more
than the rarest piece and counts as its UTF-8 bytes (or as one without byte
pieces in the model).

Edge cases: a null or empty text has 0 pre-tokens and 0 tokens; rows are counted
one by one, so repeated rows and extra columns need no rule; an empty table
gives an empty result; a very long pre-token takes time in proportion to its
length and is not stored. Memory per task: one Arrow batch, the path, and at most
``STORED`` counts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.llm.common import narrow
from tidewater.llm.pieces import Codec, grouped, model_bytes

STORED = 1_000_000
SCALE = 1000
#: Longer pre-tokens are counted each time.
LONG = 64


class TrieCounts:
    """Counts of pre-tokens under one model; keeps what it has counted."""

    def __init__(self, model: bytes):
        self.codec = Codec(model)
        self.scores = {p: -round(SCALE * math.log(r + 2))
                       for r, p in enumerate(sorted(self.codec.ids, key=self.codec.ids.get))}
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0) - 10 * SCALE
        self.stored: dict[str, int] = {}

    def _walk(self, pretokens: Iterable[str]) -> Iterator[tuple[str, int]]:
        """(pre-token, count) of distinct pre-tokens in sorted order."""
        get, longest = self.scores.get, self.longest
        path, score, count = "", [0], [0]
        for word in pretokens:
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del score[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                best = at = None
                for start in range(max(0, end - longest), end):
                    s = get(word[start:end])
                    if s is not None and (best is None or score[start] + s > best):
                        best, at = score[start] + s, start
                more = 1
                if at != end - 1 and get(word[end - 1]) is None:
                    unknown = score[end - 1] + self.unknown
                    if best is None or unknown > best:
                        best, at = unknown, end - 1
                        more = len(word[end - 1].encode()) if self.codec.fallback else 1
                score.append(best)
                count.append(count[at] + more)
            path = word
            yield word, count[-1]

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        out = []
        for group in grouped(texts):
            split = [self.codec.split(self.codec.normalised(t)) for t in group]
            if len(self.stored) > STORED:
                self.stored.clear()
            stored = self.stored
            fresh = dict(self._walk(sorted(set().union(*split).difference(stored))))
            stored.update(fresh)
            out += [(len(ws), sum(map(stored.__getitem__, ws))) for ws in split]
            for w in fresh:
                if len(w) > LONG:
                    del stored[w]
        return out


_COUNTERS: dict[bytes, TrieCounts] = {}


def counter(model: bytes) -> TrieCounts:
    """The counter of a model, one in each Python worker."""
    key = hashlib.sha256(model).digest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TrieCounts(model)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_pretokens, n_tokens."""
    rows, model = narrow(docs, id_col, text_col), model_bytes(model_path)
    out = T.StructType([rows.schema["doc_id"], T.StructField("n_pretokens", T.LongType()),
                        T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(model)
        for b in batches:
            got = c.count([t or "" for t in b["text"]])
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_pretokens": [g[0] for g in got],
                                "n_tokens": [g[1] for g in got]})

    return rows.mapInPandas(run, out)
