"""Plain versions of the operators, text by text and pair by pair."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

from tidewater.llm import lines, mixing, quality, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def xx(*values, seed: int = 42) -> int:
    """Spark's xxhash64 of ints (4 bytes, as ("i", n)), longs, strings; nulls change nothing."""
    h = seed
    for v in values:
        if v is None:
            continue
        if isinstance(v, tuple):
            data = v[1].to_bytes(4, "little", signed=True)
        elif isinstance(v, int):
            data = v.to_bytes(8, "little", signed=True)
        else:
            data = v.encode()
        h = xxhash.xxh64_intdigest(data, h & ((1 << 64) - 1))
    return signed(h)


def words(text):
    return WORD.findall(text or "")


# --- quality rules

def base_counts(text):
    ws = words(text)
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    wins = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    hit = {i + k for i in range(len(ws) - 7) if wins[tuple(ws[i:i + 8])] > 1 for k in range(8)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(hit))


def grams(text):
    h = [xx(w) for w in words(text)]
    return h + [xx(a, b) for a, b in zip(h, h[1:])]


def quality_scores(docs, trusted, buckets, threshold):
    """{position: (counts, score, kept)} of [(id, text)]."""
    raw, target = Counter(), Counter()
    for i, t in docs:
        g = [h % buckets for h in grams(t)]
        raw.update(g)
        if i is not None and i in trusted:
            target.update(g)
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def weight(b):
        if not n_target:
            return 0
        x = math.log((target[b] + 1) / (n_target + buckets)) - math.log(
            (raw[b] + 1) / (n_raw + buckets))
        return math.floor(abs(x) * quality.SCALE + 0.5) * (1 if x >= 0 else -1)

    out = []
    for _, t in docs:
        counts = base_counts(t)
        g = grams(t)
        score = round(sum(weight(h % buckets) for h in g) / quality.SCALE / len(g), 9) if g else None
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        out.append((counts, score, failed, not failed and score >= threshold))
    return out


# --- line dedup

def cut_lines(docs, t=lines.GRAM + lines.WINDOW - 1):
    """[(text, n_lines, n_removed, n_spans)] of [(id, text)], equal rows alike."""
    order = sorted(set((i is None, i or 0, xx(x), x) for i, x in docs), key=lambda r: r[:3])
    first, gone = {}, {}
    split = {r: [x for x in (r[3] or "").split("\n") if WORD.search(x)] for r in order}
    for r in order:
        ls = split[r]
        for s in range(len(ls) - t + 1):
            first.setdefault(tuple(ls[s:s + t]), (r[:3], s))
    for r in order:
        ls = split[r]
        gone[r] = {s + k for s in range(len(ls) - t + 1) for k in range(t)
                   if first[tuple(ls[s:s + t])] < (r[:3], s)}
    out = []
    for i, x in docs:
        g = gone[(i is None, i or 0, xx(x), x)]
        kept, at, dead = [], -1, False
        for line in (x or "").split("\n"):
            if WORD.search(line):
                at += 1
                dead = at in g
            if not dead:
                kept.append(line)
        text = x if not g else "\n".join(kept)
        out.append((text, at + 1, len(g), sum(1 for j in g if j - 1 not in g)))
    return out


# --- Jaccard

def shingles(text, n=5):
    ws = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if not ws:
        return set()
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))}


def components(docs, num=75, den=100):
    """[(n_shingles, component's positions)] of [(id, text)]."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            x = len(a & sets[j])
            if a and sets[j] and den * x >= num * (len(a) + len(sets[j]) - x):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(i)
    return [(len(s), groups[find(i)]) for i, s in enumerate(sets)]


# --- suffixes

def removed_bytes(docs, length=50):
    """[(n_bytes, n_removed, n_spans, kept)] of [(id, text)]."""
    least = {}
    order = lambda i: (i is None, i or 0)
    data = [(x or "").encode() for _, x in docs]
    for (i, _), b in zip(docs, data):
        for s in range(len(b) - length + 1):
            k = b[s:s + length]
            least[k] = min(least.get(k, order(i)), order(i))
    out = []
    for (i, _), b in zip(docs, data):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if least[b[s:s + length]] < order(i):
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


# --- SimHash

def fingerprint(text):
    ws = words(text)
    h, n = [xx(w) for w in ws], [len(w) for w in ws]
    terms = [(xx(h[i], h[i + 1]), n[i] + n[i + 1]) for i in range(len(h) - 1)]
    if len(ws) == 1:
        terms = [(xx(h[0]), n[0])]
    votes = [0] * 128
    for t, w in terms:
        w = min(w, simhash.MAX_WEIGHT)
        for k, x in enumerate((t, xx(t, ("i", 1)))):
            for j in range(64):
                votes[64 * k + j] += w if x >> j & 1 else -w
    halves = [sum(1 << j for j in range(64) if votes[64 * k + j] > 0) for k in range(2)]
    return "".join(f"{x:016x}" for x in halves)


def edited(texts):
    """Each text with its last quarter replaced by the beginning of the next."""
    out = []
    for i, t in enumerate(texts):
        c = len(t) // 4
        out.append(t[:len(t) - c] + texts[(i + 1) % len(texts)][:c])
    return out


# --- mixing

def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} of {source: size}, by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        w = sum(weight[s] for s in order if s not in stopped)
        out = {s: most * sizes[s] if s in stopped else left * weight[s] / w for s in order}
        above = {s for s in order if s not in stopped and out[s] > most * sizes[s]}
        if not above:
            return out
        stopped |= above


def mix(docs, fan_in=mixing.FAN_IN, seed=mixing.SEED):
    """{(id, row): copies} of [(id, text, source)]: the same tree, one unit after the other."""
    rows = [(i, xx(t), s, len(words(t))) for i, t, s in docs]
    size = Counter()
    for _, _, s, n in rows:
        size[s] += n
    goal = targets(size)
    copies, units = {}, defaultdict(dict)
    for i, r, s, n in rows:
        per = goal[s] / size[s] if size[s] else 0.0
        whole = round(per) if abs(per - round(per)) < 1e-9 else math.floor(per)
        p = max(per - whole, 0.0)
        copies[i, r] = whole if n else min(1, whole)
        if n and p >= 1e-9:
            units[s][i, r] = (n, p)

    def draw(level, k):
        h = xx(("i", seed), ("i", level), *k)
        return (h % (1 << 52) + 0.5) / (1 << 52)

    for s, todo in units.items():
        level = 0
        while True:
            blocks, classes = defaultdict(list), Counter()
            cls = {k: 0 if level or len(todo) <= fan_in else
                   math.floor(math.log2(n + 1) * 2) for k, (n, _) in todo.items()}
            classes.update(cls.values())
            for k, (n, p) in todo.items():
                b = xx(("i", seed + 1), ("i", level), *k) % math.ceil(classes[cls[k]] / fan_in)
                blocks[cls[k], b].append((n, draw(level, k), k, p))
            todo = {}
            for us in blocks.values():
                us.sort()
                n0, _, k0, p0 = us[0]
                for n1, u, k1, p1 in us[1:]:
                    both = p0 + p1
                    if both < 1:
                        if not u * both < p0:
                            n0, k0 = n1, k1
                        p0 = both
                    elif u * (2 - both) < 1 - p1:
                        copies[k0] += 1
                        n0, k0, p0 = n1, k1, max(both - 1, 0.0)
                    else:
                        copies[k1] += 1
                        p0 = max(both - 1, 0.0)
                if p0 > 0:
                    todo[k0] = (n0, p0)
            level += 1
            if len(todo) <= 1:
                break
        for k, (_, p) in todo.items():
            copies[k] += draw(-1, k) < p
    return copies


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- licence scans

LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
                "mit license": "mit"}
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def base_licences(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    ws = LICENCE_WORD.findall((text or "").translate(ASCII_LOWER))
    hits = [(k, label) for phrase, label in BASE_PHRASES.items() for p in [phrase.split()]
            for k in range(len(ws) - len(p) + 1) if ws[k:k + len(p)] == p]
    starts = [k for k, _ in hits]
    return (len(ws), len(hits), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in hits})))


def licence_labels(text, templates, idf):
    """{label: share} of every template put at every place of the text."""
    ws = LICENCE_WORD.findall((text or "").translate(ASCII_LOWER))
    out = {}
    for t in templates:
        own = LICENCE_WORD.findall(t.text.translate(ASCII_LOWER))
        total = sum(idf[w] for w in own)
        for start in range(-len(own) - t.slip, len(ws) + 1):
            near = {i: [p for p in range(max(0, start + i - t.slip), min(len(ws), start + i + t.slip + 1))
                        if ws[p] == w] for i, w in enumerate(own)}
            share = sum(idf[own[i]] for i, p in near.items() if p) / total
            span = ws[max(0, start - t.slip):max(0, start + len(own) + t.slip)]
            held = all(any(span[k:k + len(p)] == p for k in range(len(span))) for p in map(str.split, t.keys))
            if share >= t.share - 1e-9 and held:
                out[t.label] = max(share, out.get(t.label, 0))
    return out


# --- tokens of two tokenizers

def alignment(text, library_a, tokens_a, library_b, tokens_b):
    """(ids of A, ids of B, groups, links), or None without tokens; byte by byte."""
    if not text:
        return None
    a, b = library_a.encode(" " + text, add_special_tokens=False).ids, library_b.encode(text)
    want = (" " + text).encode()
    if b"".join(tokens_a[i] for i in a) != want or b"".join(tokens_b[i] for i in b) != want:
        return None
    at_a = [n for n, i in enumerate(a) for _ in tokens_a[i]]
    at_b = [n for n, i in enumerate(b) for _ in tokens_b[i]]
    links = sorted(set(zip(at_a, at_b)))
    groups, first = [], 0
    for k in range(len(want)):
        if k + 1 == len(want) or (at_a[k] != at_a[k + 1] and at_b[k] != at_b[k + 1]):
            ids = [",".join(str(ids[n]) for n in range(at[first], at[k] + 1)) for ids, at in ((a, at_a), (b, at_b))]
            groups.append("|".join(ids))
            first = k + 1
    return a, b, groups, [(a[i], b[j]) for i, j in links]


def alignments(rows, *libraries):
    """[(doc_id, text)]: the measures of op12, and the pair counts."""
    each = [alignment(t, *libraries) for _, t in rows]
    counts = Counter(link for x in each if x for link in x[3])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (i, _), x in zip(rows, each):
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = x
            out.append((i, len(a), len(b), len(groups), len(links),
                        sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links),
                        sha(";".join(groups))))
    return out, counts


# --- phrases

def collocations(rows, least, percent, top):
    """[(lang, text)]: the rows of op13."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for size in range(1, 5):
                f[lang].update(tuple(ws[i:i + size]) for i in range(len(ws) - size + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(100 * b >= percent * a and len(q) > len(p) and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items()):
                continue
            score, _, left, right = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]])
                                        for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out
