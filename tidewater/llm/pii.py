"""PII surrogates: keyed, type-consistent replacements of detected entities.

Entities are found in each text, made distinct over the whole corpus, and given
surrogates by a keyed hash: digits for digits, letters for letters of the same
script and case, a family or given name for one of the same script and gender,
a check digit where the original has a valid one. The table of distinct entities
is checked for collisions: a surrogate that two entities share, or that is
itself an entity of the corpus, is drawn again with the next attempt until all
are distinct. The surrogates are then joined back to the mentions, so the same
entity gets the same surrogate in every document and two entities never the same
one; names are replaced word by word, which keeps "Mr. Smith" and "Mr. John
Smith" together. The words of a titled name are names wherever they stand
capitalised in the same text. All names share one space: a word has one surrogate
whether it is a family or a given name, and behind any title.

Mentions are keyed by the digest of their text: copies are scanned and
rewritten alike, and only texts that may hold an entity are shuffled.

Edge cases: a null text stays null with 0 entities, an empty one empty; repeated
rows get the same result; null ids are kept; overlapping finds go to the first,
then the longest; an empty table gives an empty result; extra columns are
ignored. Texts without finds are returned as they are.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import narrow, written

# Patterns of the entity types, in order of precedence.
PATTERNS = {
    "email": r"(?<![\w.+-])[\w][\w.+%-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
             r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\w.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\w-])",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.+(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}"
             r"(?![\w-])|(?<![\w.+(])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
}
# Titles by gender, in front of capitalised names.
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"],
          "n": ["Dr", "Prof"]}
# Given names by script and gender, and syllables of family names by script.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan",
                     "Jonas", "Leo", "Martin", "Oscar", "Paul", "Robert", "Simon"],
    ("latin", "f"): ["Anna", "Berta", "Clara", "Diana", "Elsa", "Flora", "Greta", "Helena", "Irma",
                     "Julia", "Laura", "Maria", "Nora", "Olga", "Rosa", "Sofia"],
    ("latin", "n"): ["Alex", "Andrea", "Charlie", "Dominique", "Jules", "Kim", "Robin", "Sascha"],
    ("cyrillic", "m"): ["Алексей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Олег"],
    ("cyrillic", "f"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"],
    ("cyrillic", "n"): ["Женя", "Саша", "Слава", "Валя"],
    ("greek", "m"): ["Αλέξης", "Γιάννης", "Κώστας", "Νίκος", "Πέτρος", "Στέφανος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ζωή", "Κατερίνα", "Μαρία", "Σοφία"],
    ("greek", "n"): ["Χάρις", "Φώτη"],
}
SYLLABLES = {"latin": "ba be bi bo bu da de di do du fa fe fi fo ga ge gi go ka ke ki ko la le li "
                      "lo ma me mi mo na ne ni no pa pe pi po ra re ri ro sa se si so ta te ti to "
                      "va ve vi vo".split(),
             "cyrillic": "ба бе би бо да де ди до га ги го ка ке ки ко ла ле ли ло ма ме ми мо на "
                         "не ни но па пе пи по ра ре ри ро са се си со та те ти то".split(),
             "greek": "βα βε βι βο γα γε γι γο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να "
                      "νε νι νο πα πε πι πο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split()}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
           "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_TITLES = {g: "|".join(x for t in ts for x in (t, t.upper())) for g, ts in TITLES.items()}
_TITLE = "|".join(f"(?P<{g}>{ts})" for g, ts in _TITLES.items())
WORD = r"[^\W\d_a-zа-яα-ω][^\W\d_]+(?!\w)"
LATER = re.compile(rf"(?<!\w){WORD}")
NAME = re.compile(rf"\b(?:{_TITLE})\.?(?P<words>(?: {WORD}){{1,3}})")
ENTITY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in
                             ((k, p.replace(r"\1", r"(?P=gap)").replace("([ -]?)", "(?P<gap>[ -]?)"))
                              for k, p in PATTERNS.items())))
#: What every find contains; texts without it need no scan (checked by Spark itself).
#: Its digits are those of the patterns, of all scripts.
#: One test of a character comes first: most places can begin none of the many alternatives.
_BEGIN = "".join(sorted({t[0] for ts in TITLES.values() for t in ts}))
MAY_HOLD = rf"(?=[\p{{Nd}}+@A-Z{_BEGIN}])(?:\p{{Nd}}{{3}}|\p{{Nd}}\.\p{{Nd}}|\+\p{{Nd}}|[A-Z]{{2}}\p{{Nd}}{{2}}|@|" \
    + "|".join(_TITLES.values()) + ")"


def script(s: str) -> str:
    for c in s:
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
    return "latin"


def _luhn(digits: str) -> int:
    """0 for a number whose last digit checks."""
    odd = [int(d) for d in digits[-1::-2]]
    even = [2 * int(d) for d in digits[-2::-2]]
    return (sum(odd) + sum(d - 9 * (d > 9) for d in even)) % 10


def canonical(kind: str, mention: str) -> str:
    """What makes two mentions the same entity."""
    if kind == "email":
        return mention.lower()
    if kind == "phone":
        return ("+" if mention[0] == "+" else "") + re.sub(r"\D", "", mention)
    if kind in ("card", "ssn", "iban"):
        return re.sub(r"[ -]", "", mention)
    return mention.casefold() if kind.startswith(("given", "family")) else mention


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the entities, in order and without overlaps."""
    spans = [(m.lastgroup if m.lastgroup != "gap" else "card", m.start(), m.end())
             for m in ENTITY.finditer(text)]
    known, at = {}, set()
    for m in NAME.finditer(text):
        gender = "m" if m["m"] else "f" if m["f"] else "n"
        names = [(m.start("words") + w.start(), m.start("words") + w.end())
                 for w in re.finditer(r"\S+", m["words"])]
        for i, (s, e) in enumerate(names):
            kind = "family" if i == len(names) - 1 else f"given_{gender}"
            spans.append((kind, s, e))
            known.setdefault(text[s:e].casefold(), kind)
            at.add(s)
    if known:
        # Further mentions; a title in front of a name stays a title.
        spans += [(known[m[0].casefold()], m.start(), m.end()) for m in LATER.finditer(text)
                  if m.start() not in at and m[0].casefold() in known and not NAME.match(text, m.start())]
    out, end = [], -1
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            out.append((kind, s, e))
            end = e
    return out


class Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: str):
        self.seed, self.n = hmac.new(key, "\x1f".join(what).encode(), hashlib.sha256).digest(), 0

    def below(self, n: int) -> int:
        self.n += 1
        h = hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
        return int.from_bytes(h[:8], "big") % n


def _like(draw: Draw, s: str) -> str:
    """Letters and digits drawn anew, script, case and the rest kept."""
    out = []
    for c in s:
        if c.isdecimal():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letters = LETTERS[script(c)]
            new = letters[draw.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The surrogate of a canonical value, itself a canonical value of the same kind."""
    draw = Draw(key, kind, value, str(attempt))
    if kind == "email":
        user, host = value.rsplit("@", 1)
        labels = host.split(".")
        return f"{_like(draw, user)}@{'.'.join(_like(draw, x) for x in labels[:-1])}.{labels[-1]}"
    if kind == "phone":
        # The country code and the first digit stay as they are.
        keep = len(value) - 10 + 1 if value[0] == "+" and len(value) > 10 else 1
        return value[:keep] + _like(draw, value[keep:])
    if kind == "card":
        body = value[0] + _like(draw, value[1:-1])
        if _luhn(value):
            return body + str(draw.below(10))
        return next(body + str(d) for d in range(10) if not _luhn(body + str(d)))
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "iban":
        return value[:2] + _like(draw, value[2:])
    if kind == "ssn":
        return _like(draw, value)
    letters = script(value)
    if kind.startswith("given"):
        names = GIVEN[letters, kind[-1]]
        # The listed names first, then longer ones without end.
        extra = "".join(SYLLABLES[letters][draw.below(len(SYLLABLES[letters]))]
                        for _ in range(attempt // 4))
        return (names[draw.below(len(names))] + extra).casefold()
    return "".join(SYLLABLES[letters][draw.below(len(SYLLABLES[letters]))]
                   for _ in range(3 + attempt // 8)).casefold()


def render(kind: str, mention: str, new: str) -> str:
    """A canonical surrogate in the format of the mention."""
    if kind == "email":
        if mention.isupper():
            return new.upper()
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new)) \
            if len(mention) == len(new) else new
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(new.removeprefix("+"))
        return "".join(next(chars) if c.isalnum() else c for c in mention)
    if kind.startswith(("given", "family")):
        return new.upper() if mention.isupper() and len(mention) > 1 else new[:1].upper() + new[1:]
    return new


_MENTION = "key binary, kind string, value string, start bigint, end bigint"


def mentions(texts: DataFrame) -> DataFrame:
    """(key, kind, value, start, end) of the entities in (key, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, kind, canonical(kind, t[s:e]), s, e)
                    for k, t in zip(b["key"], b["text"]) for kind, s, e in find(t)]
            yield pd.DataFrame(rows, columns=["key", "kind", "value", "start", "end"])

    return texts.mapInPandas(run, _MENTION)


def _space(kind: Column) -> Column:
    """Entities of one space have distinct surrogates; all names are one."""
    return F.when(kind.rlike("^(given|family)"), F.lit("name")).otherwise(kind)


def _merged(entities: DataFrame) -> DataFrame:
    """(kind, value), one row for each value of a space; a given name that is m and f is n."""
    def some(kind: str) -> Column:
        return F.max((F.col("kind") == kind).cast("int")) == 1

    m, f, n = some("given_m"), some("given_f"), some("given_n")
    kind = F.when(m & ~f, F.lit("given_m")).when(f & ~m, F.lit("given_f")).when(
        m | f | n, F.lit("given_n")).otherwise(F.min("kind"))
    return entities.groupBy(_space(F.col("kind")).alias("space"), "value").agg(
        kind.alias("kind")).select("kind", "value")


def surrogates(entities: DataFrame, secret: bytes) -> DataFrame:
    """(space, value, new) of the (kind, value): distinct ``new`` within each space.

    Names share one space, however they are used; every other kind is its own.
    """
    entities = written(_merged(entities), "pii-entities")

    def drawn(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                b["new"] = [surrogate(secret, k, v, a)
                            for k, v, a in zip(b["kind"], b["value"], b["attempt"])]
                yield b[["kind", "value", "attempt", "new"]]
        return df.mapInPandas(run, "kind string, value string, attempt int, new string")

    # An entity's own value is never handed out: it takes part as a claim that comes first.
    space = _space(F.col("kind")).alias("space")
    real = entities.select(space, F.col("value").alias("new"), F.lit(0).alias("turn"),
                           F.col("value").alias("value"))
    settled, todo, turn = None, entities.withColumn("attempt", F.lit(0)), 0
    while True:
        turn += 1
        fresh = written(drawn(todo.select("kind", "value", "attempt")), f"pii-draw-{turn}")
        claims = real.unionByName(fresh.select(space, "new", F.lit(turn).alias("turn"), "value"))
        if settled is not None:
            claims = claims.unionByName(
                settled.select("space", "new", F.lit(1).alias("turn"), "value"))
        # The earliest claim holds; within a turn the smallest value.
        first = claims.groupBy(F.col("space").alias("k"), F.col("new").alias("n")).agg(
            F.min(F.struct("turn", "value")).alias("first"))
        judged = fresh.join(first, (_space(F.col("kind")) == F.col("k")) & (F.col("new") == F.col("n"))) \
            .withColumn("wins", (F.col("first.turn") == turn)
                        & (F.col("first.value") == F.col("value"))) \
            .select("kind", "value", "attempt", "new", "wins")
        judged = written(judged, f"pii-judged-{turn}")
        good = judged.where("wins").select(space, "value", "new")
        settled = good if settled is None else settled.unionByName(good)
        todo = judged.where(~F.col("wins")).withColumn("attempt", F.col("attempt") + 1)
        if todo.isEmpty():
            return settled


def pseudonymise(docs: DataFrame, secret: bytes, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text with surrogates, n_entities."""
    rows = narrow(docs, id_col, text_col)
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    some = rows.where(may).withColumn("key", F.unhex(F.md5("text")))
    found = written(mentions(some.select("key", "text")).distinct(), "pii-mentions")
    new = written(surrogates(found.select("kind", "value").distinct(), secret), "pii-surrogates")
    edits = found.withColumn("space", _space(F.col("kind"))).join(new, ["space", "value"]).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind", "new"))).alias("edits"))
    edited = some.join(edits, "key", "left").select("doc_id", "text", "edits")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, counts = [], []
            for text, todo in zip(b["text"], b["edits"]):
                out, at = [], 0
                for e in (todo if todo is not None else ()):
                    out += [text[at:e["start"]],
                            render(e["kind"], text[e["start"]:e["end"]], e["new"])]
                    at = e["end"]
                texts.append("".join(out) + text[at:])
                counts.append(len(todo) if todo is not None else 0)
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": texts, "n_entities": counts})

    out = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType()),
                        T.StructField("n_entities", T.LongType())])
    plain = rows.where(~may).withColumn("n_entities", F.lit(0).cast("bigint"))
    return plain.unionByName(edited.mapInPandas(run, out))
