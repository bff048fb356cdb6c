"""SentencePiece encoding with source spans, and decoding.

The model file is read once on the driver (its path is a parameter) and shipped
to the tasks, which each rebuild the tables: the pieces with their scores and
the compiled character map. A text is normalised by the longest prefix that the
map knows at each place, recording for each normalised byte the source byte it
comes from; it is cut where no piece can reach across, the distinct cuts are merged by
falling piece scores, and the pieces are projected through the recorded alignment
to byte spans of the source.

Edge cases: a null text encodes as the empty text (no ids, decoded ""); rows
are coded one by one, so repeated rows, ties and extra columns need no rule;
an empty table gives an empty result; very long cuts are merged with a heap in
O(n log n). Memory per task: one Arrow batch, and two tables of at most
``CACHE_ENTRIES`` distinct cuts, the older of which goes when the newer is full.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.llm.common import narrow

# Fixed values of the model format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_ENTRIES = 250_000
NEVER = 1 << 30
#: Cuts of up to so many symbols are merged many at a time, longer ones with a heap.
SHORT = 32
#: Texts are handled in groups of about so many characters.
GROUP_CHARS = 2_000_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            c = data[at]
            at += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + n]
            at += n


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 and its replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(source length, replacement) of the longest known prefix of data[at:]."""
        units = self.units
        if not units:
            return None
        found = None
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(b"\0", found[1])]


def grouped(texts: list[str]) -> Iterator[list[str]]:
    """Successive texts of about GROUP_CHARS characters in all, so that their cuts fit in memory."""
    group, chars = [], 0
    for t in texts:
        if group and chars + len(t) > GROUP_CHARS:
            yield group
            group, chars = [], 0
        group.append(t)
        chars += len(t)
    if group:
        yield group


class Codec:
    """Tables of one model; ``encode`` and ``decode`` single texts."""

    def __init__(self, model: bytes):
        spec: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        self.pieces, scores, self.kinds = [], [], []
        for field, value in _fields(model):
            if field == 1:
                d = dict(_fields(value))
                self.pieces.append(d.get(1, b"").decode())
                scores.append(struct.unpack("<f", d.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(d.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                spec = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only BPE models are supported")
        if trainer.get(24, 0) or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("space suffixes, user-defined and unused pieces are not supported")
        self.map = CharMap(spec.get(2, b""))
        self.dummy, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))
        self.fallback = bool(trainer.get(35, 0))
        self.unk_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.unk = self.kinds.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in
                         enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.order = {p: -scores[i] for p, i in self.ids.items()}
        self.known = {p: (i, len(p.encode()), str(i), struct.pack("<H", len(p.encode())))
                      for p, i in self.ids.items()}
        # No piece has a space after another character: cuts before runs of spaces are safe.
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that span several words are not supported")
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.cuts: dict[str, tuple[str, bytes, str]] = {}
        self.older: dict[str, tuple[str, bytes, str]] = {}
        self._pair_tables()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, per byte of it and for its end, the source byte offset."""
        data = text.encode()
        if self.identity:
            # Only spaces change, from 1 byte to the 3 of the space symbol.
            src = np.frombuffer(data, np.uint8)
            align = np.repeat(np.arange(len(data)), np.where(src == 32, 3, 1))
            lead = [0] * 3 if self.dummy and data else []
            return (self.normalised(text),
                    np.concatenate([lead, align, [len(data)]]).astype(np.int64))
        space = SPACE.encode() if self.escape else b" "
        out, align, at = bytearray(), [], 0

        def put(part: bytes, source: int) -> None:
            for b in part:
                new = space if b == 32 else bytes((b,))
                out.extend(new)
                align.extend([source] * len(new))

        steps = []
        while at < len(data):
            n, new = self.map.longest(data, at) or (
                (w := 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)),
                data[at:at + w])
            steps.append((at, n, new))
            at += n
        if self.squeeze:
            while steps and not steps[0][2].strip(b" "):
                steps.pop(0)
        if not steps:
            return "", np.zeros(1, np.int64)
        if self.dummy:
            put(b" ", steps[0][0])
        end = len(data)
        spaced = self.squeeze
        for source, n, new in steps:
            if self.squeeze and spaced:
                new = new.lstrip(b" ")
            put(new, source)
            if new:
                spaced = self.squeeze and new.endswith(b" ")
            elif not self.squeeze:
                spaced = False
        if self.squeeze:
            while out.endswith(space):
                end = align[-len(space)]
                del out[-len(space):], align[-len(space):]
        return out.decode(), np.array([*align, end], np.int64)

    @property
    def identity(self) -> bool:
        return not self.map.units and not self.squeeze and self.escape

    def normalised(self, text: str) -> str:
        """The normalised text alone."""
        if not self.identity:
            return self.normalise(text)[0]
        return (SPACE if self.dummy and text else "") + text.replace(" ", SPACE)

    def split(self, norm: str) -> list[str]:
        """The cuts of a normalised text: runs of spaces with what follows up to the next."""
        if norm.startswith(SPACE) and SPACE + SPACE not in norm:
            return [SPACE + p for p in norm[1:].split(SPACE)]
        return self.cut.findall(norm)

    def _pair_tables(self) -> None:
        """For merging in bulk: numbers of symbols, and of each mergeable pair its order and sum."""
        self.symbols = list(self.ids) + sorted({c for p in self.ids for c in p} - set(self.ids))
        number = {p: i for i, p in enumerate(self.symbols)}
        # Characters in no piece have numbers behind all others, and no pairs.
        self.of_char = np.arange(0x110000, dtype=np.int64) + len(self.symbols)
        chars = [p for p in self.symbols if len(p) == 1]
        self.of_char[[ord(c) for c in chars]] = [number[c] for c in chars]
        rank = dict(zip(self.ids, np.unique([self.order[p] for p in self.ids],
                                            return_inverse=True)[1].tolist()))
        pairs = sorted(((number[p[:k]] << 32) + number[p[k:]], rank[p], number[p])
                       for p in self.ids for k in range(1, len(p))
                       if p[:k] in number and p[k:] in number)
        table = np.array(pairs or [(-1, 0, 0)], np.int64)
        self.pair_key, self.pair_rank, self.pair_sum = (np.ascontiguousarray(table[:, k])
                                                        for k in range(3))

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order and merged symbol of pairs of symbols; the order is NEVER where none is."""
        key = (a.astype(np.int64) << 32) + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        ok = (self.pair_key[at] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self.pair_rank[at], NEVER), self.pair_sum[at]

    def _merge_many(self, cuts: list[str]) -> list[list[str]]:
        """The symbols of cuts of at most SHORT characters, merged side by side."""
        size = np.array([len(c) for c in cuts])
        codes = np.frombuffer("".join(cuts).encode("utf-32-le"), "<u4")
        n, wide = len(cuts), int(size.max())
        sym = np.full((n, wide + 1), -1, np.int32)
        inside = np.arange(wide) < size[:, None]
        sym[:, :wide][inside] = self.of_char[codes]
        rank, total = self._pair(sym[:, :-1], sym[:, 1:])
        rank, total = rank.astype(np.int32), total.astype(np.int32)
        rows, place = np.arange(n), np.arange(wide)
        while len(rows):
            r = rank[rows]
            at = r.argmin(axis=1)
            live = r[np.arange(len(rows)), at] < NEVER
            rows, at = rows[live], at[live]
            if not len(rows):
                break
            s, r, t = sym[rows], rank[rows], total[rows]
            line = np.arange(len(rows))
            # The merged symbol takes the first one's place, what follows moves up.
            s[line, at] = t[line, at]
            move = np.minimum(place + (place > at[:, None]), wide)
            s = np.concatenate([np.take_along_axis(s, move, 1), np.full((len(s), 1), -1, np.int32)], 1)
            move = np.minimum(place + (place >= at[:, None]), wide - 1)
            r, t = np.take_along_axis(r, move, 1), np.take_along_axis(t, move, 1)
            r[:, -1] = NEVER
            for k in (at, at - 1):
                ok = k >= 0
                i, k = line[ok], k[ok]
                r[i, k], t[i, k] = self._pair(s[i, k], s[i, k + 1])
            sym[rows], rank[rows], total[rows] = s, r, t
        names, known = self.symbols, len(self.symbols)
        left = (sym >= 0).sum(axis=1)
        return [[names[x] if x < known else chr(x - known) for x in row[:k]]
                for row, k in zip(sym.tolist(), left.tolist())]

    def learn(self, cuts: set[str]) -> list[str]:
        """Code these cuts; returns those that are too long to be kept for other texts."""
        if len(self.cuts) > CACHE_ENTRIES:
            self.older, self.cuts = self.cuts, {}
        get, new = self.older.get, []
        for c in cuts.difference(self.cuts):
            known = get(c)
            if known is not None:
                self.cuts[c] = known
            else:
                new.append(c)
        new.sort(key=len)
        short = bisect.bisect_right(new, SHORT, key=len)
        for a in range(0, short, 20_000):
            part = new[a:min(short, a + 20_000)]
            for c, syms in zip(part, self._merge_many(part)):
                self.cuts[c] = self._coded(syms)
        for c in new[short:]:
            self.cuts[c] = self._coded(self._merge_heap(list(c)))
        return new[bisect.bisect_right(new, 2 * SHORT, key=len):]

    def _merge_heap(self, syms: list[str]) -> list[str]:
        n = len(syms)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, syms[i] + syms[i + 1]) for i in range(n - 1)
                if (r := self.order.get(syms[i] + syms[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i] if syms[i] else n
            if j >= n or syms[i] + syms[j] != piece:
                continue                            # a later merge has changed this pair
            syms[i], syms[j] = piece, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (r := self.order.get(syms[a] + syms[b])) is not None:
                    heapq.heappush(heap, (r, a, syms[a] + syms[b]))
        return [s for s in syms if s]

    def _ids(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        """Ids, and the number of normalised bytes that each stands for."""
        known = self.known
        ids, widths, unknown = [], [], False
        for p in pieces:
            if p in known:
                ids.append(known[p][0])
                widths.append(known[p][1])
            elif self.fallback:
                ids.extend(self.byte_ids[b] for b in p.encode())
                widths.extend([1] * len(p.encode()))
            elif unknown:
                widths[-1] += len(p.encode())
            else:
                ids.append(self.unk)
                widths.append(len(p.encode()))
            unknown = p not in known
        return ids, widths

    def _coded(self, pieces: list[str]) -> tuple[str, bytes, str]:
        """Of a cut's pieces: the ids as text, their widths as 16-bit numbers, the decoding."""
        try:
            got = [self.known[p] for p in pieces]
            return (",".join([g[2] for g in got]), b"".join([g[3] for g in got]),
                    "".join(pieces).replace(SPACE, " "))
        except KeyError:
            ids, widths = self._ids(pieces)
            return ",".join(map(str, ids)), np.array(widths, "<u2").tobytes(), self._join(ids)

    def _join(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            kind = self.kinds[i]
            out.append(self.unk_text if kind == UNKNOWN else "" if kind == CONTROL
                       else self.pieces[i].replace(SPACE, " "))
        return "".join(out) + _utf8(run)

    def encode_cuts(self, texts: list[str]
                    ) -> Iterator[tuple[list[tuple[str, bytes, str]], np.ndarray]]:
        """Per text its coded cuts, and the alignment of its normalised bytes."""
        for group in grouped(texts):
            # Without byte pieces a run of unknown characters is one id, across cuts.
            parts = [(self.split(norm) if self.fallback else [norm] if norm else [])
                     for norm in map(self.normalised, group)]
            long = self.learn(set().union(*parts))
            cuts = self.cuts
            for text, part in zip(group, parts):
                yield [cuts[p] for p in part], self.normalise(text)[1]
            for p in long:
                del cuts[p]

    def encode(self, text: str | None) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids, and the start and end of each in the UTF-8 bytes of the text."""
        return next(self.encode_many([text]))

    def encode_many(self, texts: list[str | None]
                    ) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        for cuts, align in self.encode_cuts([t or "" for t in texts]):
            yield ([int(i) for c in cuts for i in c[0].split(",") if i], *spans(cuts, align))

    def decode(self, ids: list[int]) -> str:
        text = self._join(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        drop = (self.dummy or self.squeeze) and first is not None \
            and self.pieces[first].startswith(SPACE)
        return text[1:] if drop else text


def _utf8(run: bytearray) -> str:
    """Decoded bytes; each byte that is not part of a character becomes U+FFFD."""
    out = []
    while run:
        try:
            return "".join(out) + run.decode()
        except UnicodeDecodeError as e:
            out.append(run[:e.start].decode() + "\ufffd")
            del run[:e.start + 1]
    return "".join(out)


def spans(cuts: list[tuple[str, bytes, str]], align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Source byte spans: the normalised offsets of the pieces through the alignment.

    A piece without source of its own, such as the space put in front, is empty.
    """
    at = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join([c[1] for c in cuts]), "<u2"),
                                        dtype=np.int64)])
    at = align[at]
    return at[:-1], at[1:]


_CODECS: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """The tables of a model, built once in each Python worker."""
    key = hashlib.sha256(model).digest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids, starts, ends (byte spans of the pieces in the source)."""
    rows, model = narrow(docs, id_col, text_col), model_bytes(model_path)
    many = T.ArrayType(T.IntegerType())
    out = T.StructType([rows.schema["doc_id"], T.StructField("ids", many),
                        T.StructField("starts", many), T.StructField("ends", many)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for b in batches:
            got = list(c.encode_many(b["text"]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [g[0] for g in got],
                                "starts": [g[1] for g in got], "ends": [g[2] for g in got]})

    return rows.mapInPandas(run, out)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """Per row of (doc_id, ids): doc_id and the decoded text; null ids decode to ""."""
    rows, model = encoded.select("doc_id", "ids"), model_bytes(model_path)
    out = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"],
                                "text": [c.decode([] if i is None else [int(x) for x in i])
                                         for i in b["ids"]]})

    return rows.mapInPandas(run, out)


def code_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, n_source_bytes.

    Encodes and decodes as the two functions above without moving the ids out of
    the task; ``n_source_bytes`` sums the spans of all pieces.
    """
    rows, model = narrow(docs, id_col, text_col), model_bytes(model_path)
    out = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType()),
                        T.StructField("n_source_bytes", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)

        def one(cuts: list[tuple[str, bytes, str]], align: np.ndarray) -> tuple[int, str, str, int]:
            ids = ",".join([x[0] for x in cuts])
            start, end = spans(cuts, align)
            # Cuts never split a character, so their decodings only need joining;
            # the first space goes as in decode().
            plain = "".join([x[2] for x in cuts])
            if cuts and (c.dummy or c.squeeze) and plain.startswith(" "):
                plain = plain[1:]
            return (len(start), hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(plain.encode()).hexdigest(), int((end - start).sum()))

        for b in batches:
            got = [one(*x) for x in c.encode_cuts([t or "" for t in b["text"]])]
            yield pd.DataFrame({"doc_id": b["doc_id"]} | {
                f.name: [g[i] for g in got] for i, f in enumerate(out.fields[1:])})

    return rows.mapInPandas(run, out)
