"""License scans with a positional index of rare licence words.

Licence notices are templates: a label, its words in order, and mandatory key phrases.
One scan reduces each text to the places of licence words (words of any template); their
document frequencies over the whole corpus give IDF weights, which decide what the index
holds: of each template the words of highest IDF, as many as any match must share one
with (the others weigh less than the least share).

A file's occurrences of indexed words are looked up. Each posting (template, position)
fixes where the template may start; from each such start the postings of all its words are
intersected with the file's places, ``slip`` words apart at most, and the weight of the words
found is the match's share. A match of ``share`` or more counts if every key phrase stands in it word
by word. No start that could match is left out. Base phrases are templates of share 1 and slip 0, so that the same look-up gives
all their places.

What a task knows of the corpus is one count per licence word, bounded by the templates. A
file is looked up where it is, so nothing is shuffled but those counts.

Edge cases: a null or empty text has no words, no labels and score 0; rows are scanned one by
one, so repeated rows, null ids and extra columns need no rule; of overlapping matches of a
template the one of higher share stays, then the one with words less moved, then the first; an
empty table gives an empty result; a very long text takes time in proportion to its words
and its look-ups. Memory per task: one Arrow batch.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import narrow, written


class Template(NamedTuple):
    """A licence notice: what it is called, its words, the phrases that must stand in it."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    share: float = 0.7
    slip: int = 3


# The phrases of the base rule and their labels.
BASE = (Template("gpl", "gnu general public license", share=1.0, slip=0),
        Template("apache", "apache license", share=1.0, slip=0),
        Template("cc-by", "cc by", share=1.0, slip=0),
        Template("mit", "mit license", share=1.0, slip=0))

# Wording of public licence notices.
NOTICES = (
    Template("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
             " software and associated documentation files, to deal in the Software without restriction,"
             " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
             " sublicense, and/or sell copies of the Software",
             ("permission is hereby granted", "without restriction")),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template("apache-notice", "you may not use this file except in compliance with the License. You may obtain a"
             " copy of the License at", ("in compliance with the license",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
             ("general public license version 3",)),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the"
             " terms of the GNU General Public License as published by the Free Software Foundation",
             ("you can redistribute it", "general public license")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("affero general public license",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are"
             " permitted provided that the following conditions are met",
             ("source and binary forms", "conditions are met")),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be"
             " used to endorse or promote products derived from this software", ("endorse or promote products",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
             " without fee is hereby granted", ("with or without fee",)),
    Template("zlib", "In no event will the authors be held liable for any damages arising from the use of this"
             " software", ("authors be held liable",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("unencumbered software",)),
    Template("mit-line", "Released under the MIT License", ("the mit license",)),
    Template("cc-by-nc", "CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nd", "CC BY-ND 4.0", ("cc by nd",)),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution",)),
    Template("cc0", "CC0 1.0 Universal Public Domain Dedication", ("public domain dedication",)),
)

# Digits, letters (lower-cased) and all bytes beyond ASCII are of words.
_LETTERS = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b > 0x7F
                 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LETTERS).split()


def vocabulary(templates: Iterable[Template]) -> dict[bytes, int]:
    """The licence words, numbered in byte order."""
    every = {w for t in templates for part in (t.text, *t.keys) for w in words_of(part)}
    return {w: i for i, w in enumerate(sorted(every))}


def licence_places(docs: DataFrame, templates: Iterable[Template]) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_words, and its licence words with their places."""
    number = vocabulary(templates)
    out = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                        T.StructField("words", T.ArrayType(T.IntegerType())),
                        T.StructField("places", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, words, places = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for text in b.column("text"):
                tokens = words_of(text.as_py())
                ids = np.fromiter(map(number.get, tokens, repeat(-1)), np.int32, len(tokens))
                at = np.flatnonzero(ids >= 0)
                sizes.append(len(tokens))
                words.append(ids[at])
                places.append(at.astype(np.int32))
            stops = pa.array(np.cumsum([len(w) for w in words]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()),
                 *(pa.ListArray.from_arrays(stops, pa.array(np.concatenate(x))) for x in (words, places))],
                ["doc_id", "n_words", "words", "places"])

    return docs.select("doc_id", "text").mapInArrow(run, out)


def idf_weights(scanned: DataFrame, n_words: int) -> np.ndarray:
    """IDF of each licence word over all rows; at most one row per licence word comes to the driver."""
    seen = scanned.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    df = np.ones(n_words)
    for word, n in seen.collect():
        df[word] = n
    return np.log1p(scanned.count() / df)


class Index:
    """The positional index of the templates under IDF weights."""

    def __init__(self, templates: list[Template], idf: np.ndarray):
        number = vocabulary(templates)
        self.templates = templates
        self.words = [np.array([number[w] for w in words_of(t.text)]) for t in templates]
        self.keys = [[np.array([number[w] for w in words_of(k)]) for k in t.keys] for t in templates]
        self.weights = [idf[w] for w in self.words]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for n, (t, words, weight) in enumerate(zip(templates, self.words, self.weights)):
            held = 0.0
            for at in np.lexsort((words, -weight)):     # rarest first
                self.postings.setdefault(int(words[at]), []).append((n, int(at)))
                held += weight[at]
                if held > (1 - t.share) * weight.sum() + 1e-9:
                    break
        self.rare = np.zeros(len(number), bool)
        self.rare[list(self.postings)] = True

    def _match(self, n: int, start: int, words: np.ndarray, places: np.ndarray) -> tuple | None:
        """(-share, words moved by, start, end) of template n put at ``start`` of a file, if it is one."""
        t, own = self.templates[n], self.words[n]
        lo, hi = np.searchsorted(places, (start - t.slip, start + len(own) + t.slip))
        words, places = words[lo:hi], places[lo:hi]
        moved = np.abs(places[:, None] - start - np.arange(len(own)))
        moved[words[:, None] != own] = t.slip + 1
        nearest = moved.argmin(0)
        moved = moved[nearest, np.arange(len(own))]
        found = moved <= t.slip
        share = float(self.weights[n][found].sum() / self.weights[n].sum())
        if share < t.share - 1e-9:
            return None
        for key in self.keys[n]:
            at = np.flatnonzero(words == key[0])
            at = at[at + len(key) <= len(words)]
            run = at[:, None] + np.arange(len(key))
            if not ((words[run] == key) & (places[run] == places[at][:, None] + np.arange(len(key)))).all(1).any():
                return None
        used = places[nearest[found]]
        return -min(share, 1.0), int(moved[found].sum()), int(used.min()), int(used.max()) + 1

    def find(self, words: np.ndarray, places: np.ndarray) -> list[tuple[str, int, int, float, bool]]:
        """(label, start, end, share, base) of a file's matches by label and start."""
        starts: dict[int, set[int]] = {}
        for at in np.flatnonzero(self.rare[words]).tolist():
            for n, offset in self.postings[int(words[at])]:
                start, slip = int(places[at]) - offset, self.templates[n].slip
                starts.setdefault(n, set()).update(range(start - slip, start + slip + 1))
        out = []
        for n, some in starts.items():
            taken: list[tuple[int, int]] = []
            for share, _, start, end in sorted(filter(None, (self._match(n, s, words, places) for s in some))):
                at = bisect.bisect(taken, (start, end))
                if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
                    continue
                taken.insert(at, (start, end))
                out.append((self.templates[n].label, start, end, -share, n < len(BASE)))
        return sorted(out)


_MATCH = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("share", T.DoubleType()),
    T.StructField("base", T.BooleanType())]))


def license_matches(docs: DataFrame, notices: Iterable[Template] = NOTICES, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, matches (label, start, end in words, share, base)."""
    templates = [*BASE, *notices]
    scanned = written(licence_places(narrow(docs, id_col, text_col), templates), "licence-places")
    index = Index(templates, idf_weights(scanned, len(vocabulary(templates))))
    out = T.StructType([scanned.schema["doc_id"], T.StructField("n_words", T.LongType()),
                        T.StructField("matches", _MATCH)])
    names = _MATCH.elementType.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[dict(zip(names, m)) for m in index.find(w, p)] if len(w) else []
                     for w, p in zip(b["words"], b["places"])]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_words": b["n_words"], "matches": found})

    return scanned.mapInPandas(run, out)


def license_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of ``license_matches``."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    shares = F.transform("matches", lambda m: m["share"])
    return found.select("doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
                        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"))
