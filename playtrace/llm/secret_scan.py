"""Secret scans: pattern spans, and credential values that a password-guess model finds expensive.

The cost of a value is the least, over all ways to cut it into words, dates, repeats, keyboard walks and brute-force
spans, of the decades (powers of ten) of guesses those pieces take, found by dynamic programming over its positions. Its words
are a short list that guessing starts with, the words of a tokenizer's vocabulary where one is given, so that ordinary words are known
whatever the table, and then the ``LISTED`` most frequent words of the documents themselves.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import bounded_batches, stored

# The base patterns. The runs of the last two have their least length in the pattern: a run that is too
# short is skipped whole either way.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

#: Wider contexts: a credential's name, then a sign, then a quoted or bare value. Names that end ordinary words ('compass') stand
#: after no letter, but for a capital after a small one; the others may be glued to what comes before ('dbpwd').
CONTEXT = re.compile(
    r"""(?:(?:(?u:(?<![^\W\d_]))|(?-i:(?<=[a-z])(?=[A-Z])))(?:(?:db|my|user|root|admin)?pass|o?auth|bearer)"""
    r"""|pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|(?:api|access|private|auth|signing)[_-]?key)"""
    r"""["']?[\x20\t]*(?:[:=]|=>|\x20is\x20)[\x20\t]*(?:"([^"\s]+)"|'([^'\s]+)'|([^\s"'<>,;]+))""",
    re.IGNORECASE | re.ASCII)

_NAMES = ("pass", "pwd", "secret", "token", "credential", "key", "bearer", "auth")

#: A value that takes at least 10 to this many guesses, and has at least this many characters, is a secret.
DECADES = 8.0
LEAST = 8
#: Costs stop growing here: a value whose every start costs this much is not read further.
CEILING = 40.0

# Words that guessing starts with, most likely first.
WORDS = (
    "password passwd pass secret admin login user root test guest demo example sample default changeme change letmein welcome "
    "hello master dragon monkey shadow sunshine princess football baseball superman batman iloveyou love trustno computer "
    "internet server database access public private token key api auth code your my the this here enter insert value string "
    "placeholder dummy fake temp temporary none null true false xxxx foo bar baz qux name email phone number house home work "
    "summer winter spring autumn monday friday january june july august october november december black white red blue green "
    "yellow orange purple silver golden happy lucky money freedom forever family mother father brother sister friend angel "
    "baby tiger lion eagle horse dog cat fish star moon earth fire water wind storm light dark night magic wizard king queen "
    "prince knight soldier hunter ranger killer player gamer music guitar piano soccer hockey tennis summer correct battery "
    "staple apple banana cherry cookie coffee pepper ginger chocolate flower cheese chicken pizza").split()
_RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
#: Corpus words after these: at most so many, each in at least so many documents, of so many letters at most.
LISTED = 1 << 16
LEAST_DOCS = 3
LONGEST = 24
#: Letters of the shortest words that are taken from a vocabulary; shorter entries are mostly parts of words.
LEAST_VOCABULARY = 4
_LETTERS = re.compile(r"[^\W\d_]+")
_LEET = str.maketrans("@4831!05$7", "aabeiiosst")
# The rows of a keyboard, and the alphabet as one more row.
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
PERIODS = 16


def _neighbours() -> dict[tuple[str, str], int]:
    """Direction from key to key: along a row, to the row above or below (shifted half a key), along the alphabet."""
    at = {c: (r, i) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
    steps: dict[tuple[str, str], int] = {}
    for a, b in zip(ALPHABET, ALPHABET[1:]):
        steps[a, b], steps[b, a] = 7, 8
    for a, (r, i) in at.items():
        for d, (dr, di) in enumerate(((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1))):
            if 0 <= r + dr < len(ROWS) and 0 <= i + di < len(ROWS[r + dr]):
                steps[a, ROWS[r + dr][i + di]] = d
    return steps


_STEP = _neighbours()
_WALK_START, _WALK_STEP, _WALK_TURN = math.log10(73), math.log10(1.5), math.log10(8)
_DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d"
    r"|(?:19|20)\d\d")
_DATE_COST = {True: math.log10(200 * 365 * 4), False: math.log10(200)}  # a day with separators, a year


def _brute(c: str) -> float:
    """Decades for one character that nothing explains."""
    return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() and c.isascii() else math.log10(33) if c.isascii() else 2.0


def vocabulary_words(path: str) -> list[str]:
    """The words of a byte-level vocabulary file in its order, which is about that of their frequency: its entries that begin with a
    space and are letters a-z, ``LEAST_VOCABULARY`` or more, in small letters."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = (t[1:].lower() for t in sorted(vocab, key=vocab.get) if t[0] == "\u0120")
    return list(dict.fromkeys(w for w in words if len(w) >= LEAST_VOCABULARY and w.isascii() and w.isalpha()))


def word_ranks(docs: DataFrame, text: str = "text", most: int = LISTED, vocabulary: str | None = None) -> dict[str, int]:
    """Rank of each word that guessing tries: ``WORDS``, those of a ``vocabulary`` file, then the words of ``docs`` by the number of
    documents they stand in.

    Values in credential contexts are not counted, so that a secret is no word because copies repeat it. The list is cut where the
    counts fall below a step of a logarithmic scale, so that it has at most ``most`` corpus words.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for x in batch.column(0):
                own = _outside(x.as_py() or "").lower()
                counts.update({w for w in set(_LETTERS.findall(own)) if 2 <= len(w) <= LONGEST})
                if len(counts) >= 500_000:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    counts = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts.where(F.col("n") >= LEAST_DOCS), "secret-words")
    step = F.floor(F.log2("n") * 8)
    steps = sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("v")).collect(), reverse=True)  # < 512 rows
    least, listed = math.inf, 0
    for row in steps:
        if listed + row["v"] > most:
            break
        least, listed = row["s"], listed + row["v"]
    top = counts.where(step >= F.lit(float(least))).collect()  # at most ``most`` rows
    ranks = dict(_RANK)
    for word in vocabulary_words(vocabulary) if vocabulary else ():
        ranks.setdefault(word, len(ranks) + 1)
    for row in sorted(top, key=lambda r: (-r["n"], r["word"])):
        ranks.setdefault(row["word"], len(ranks) + 1)
    return ranks


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _outside(text: str) -> str:
    """``text`` without the values in credential contexts."""
    if not _named(text):
        return text
    out, at = [], 0
    for a, b in sorted([m.span(2) for m in ASSIGN.finditer(text)] + [m.span(m.lastindex) for m in CONTEXT.finditer(text)]):
        out.append(text[at:max(a, at)])
        at = max(at, b)
    return " ".join([*out, text[at:]])


def _named(text: str) -> bool:
    """Whether a credential's name may stand in ``text``: without one neither pattern with a name can match."""
    low = text.lower()
    return any(name in low for name in _NAMES)


def guess_cost(value: str, ranks: Mapping[str, int] = _RANK) -> float:
    """Decades of guesses for the cheapest segmentation of ``value``, at most ``CEILING``. The empty value costs 0.

    A repeat is a block of up to ``PERIODS`` characters, priced by its own cheapest segmentation, followed by as many copies of itself
    as there are; longer blocks are priced piece by piece each time. Words have at most ``LONGEST`` letters, longer ones are made of
    shorter ones. The states are positions, so the work grows with the length of the value, not its square.
    """
    n, low = len(value), value.lower()
    if len(low) != n:
        low = value
    plain = low.translate(_LEET)
    best = [math.inf] * (n + 1)
    walk: dict[int, float] = {}  # direction of the last step -> cost of a walk that has come as far as this character
    best[0] = 0.0
    last = 0  # the furthest position that costs less than the ceiling
    same = [0] * (PERIODS + 1)  # by period: up to where each character equals the one a period later
    blocks: dict[str, float] = {}

    def block(i: int, p: int) -> float:
        own = value[i:i + p]
        if own not in blocks:
            blocks[own] = guess_cost(own, ranks)  # at most ``PERIODS`` characters, repeats in it at most half as many
        return blocks[own]

    def lower(at: int, cost: float) -> None:
        nonlocal last
        if cost < best[at]:
            best[at] = cost
            if cost < CEILING:
                last = max(last, at)

    for i in range(n):
        here = best[i]
        if here >= CEILING and min(walk.values(), default=CEILING) >= CEILING:
            if i > last:
                return CEILING
            walk = {}
            continue
        c = value[i]
        lower(i + 1, here + _brute(c) + (0.3 if c.isupper() else 0.0))
        for size in range(2, min(LONGEST, n - i) + 1):
            exact, spelt = low[i:i + size], plain[i:i + size]
            rank = ranks.get(exact) or ranks.get(spelt)
            if rank:
                twist = (0.3 if value[i:i + size] != exact else 0.0) + (0.6 if exact not in ranks else 0.0)
                lower(i + size, here + math.log10(rank + 1) + twist)
        if c.isdigit():
            found = _DATE.match(value, i)
            if found:
                lower(found.end(), here + _DATE_COST[found.end() - i > 4])
                if found.end() - i > 4:
                    lower(i + 4, here + _DATE_COST[False] if value[i:i + 2] in ("19", "20") else math.inf)
        for p in range(1, min(PERIODS, (n - i) // 2) + 1):
            if same[p] <= i:
                at = i
                while at + p < n and value[at] == value[at + p]:
                    at += 1
                same[p] = at
            times = (same[p] - i) // p + 1
            if times > 1:
                lower(i + p * times, here + block(i, p) + math.log10(times))
        # walks: go on, turn, or start at this character
        step = _STEP.get((low[i - 1], low[i])) if i else None
        on: dict[int, float] = {}
        if step is not None and walk:
            turned = min(walk.values()) + _WALK_TURN
            on[step] = min(turned, walk.get(step, math.inf) + _WALK_STEP)
            lower(i + 1, on[step])
        on[-1] = here + _WALK_START
        walk = on
    return min(best[n], CEILING)


def spans(text: str, ranks: Mapping[str, int] = _RANK) -> list[tuple[int, int, str]]:
    """``(start, kind number, end)`` of all secrets, sorted; kinds as in ``KINDS``.

    A ``guess`` span is a credential's value, where no base span already covers it.
    """
    named = _named(text)
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if named else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    covered = sorted((a, b) for a, _, b in found)
    for m in CONTEXT.finditer(text) if named else ():
        a, b = m.span(m.lastindex)
        if b - a >= LEAST and not any(x <= a and b <= y for x, y in covered) and guess_cost(text[a:b], ranks) >= DECADES:
            found.append((a, 3, b))
    return sorted(found)


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, counts per kind, digest of the base spans, and all spans (code points).

    A null text is empty and has no spans; the digest of no spans is that of the empty string.
    """
    bounded_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text, vocabulary=vocabulary))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        own.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
        T.StructField("n_guess", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(1):
                found = spans(x.as_py() or "", ranks.value)
                kinds = [k for _, k, _ in found]
                base = _joined([s for s in found if s[1] < 3])
                rows.append((
                    *[kinds.count(k) for k in range(3)], hashlib.sha256(base.encode()).hexdigest(), _joined(found),
                    kinds.count(3)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.string() if i in (3, 4) else pa.int64()) for i, c in enumerate(columns)]],
                names=schema.names)

    return own.mapInArrow(run, schema)


MASK = "[secret]"


def mask(text: str, ranks: Mapping[str, int] = _RANK) -> str:
    """``text`` with every secret replaced; overlapping spans are one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, _, b in spans(text, ranks):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], MASK]
        at = b
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[secret]``; all rows and columns stay, repeated ones too, and null and empty
    texts stay as they are.

    ``length``, where the table has such a column, holds the new number of code points of each changed text.
    """
    bounded_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text, vocabulary=vocabulary))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            old = batch.column(at).to_pylist()
            new = [x and mask(x, ranks.value) for x in old]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            size = batch.schema.get_field_index(length) if length else -1
            if size >= 0:
                sizes = batch.column(size).to_pylist()
                sizes = [len(b) if a != b else s for a, b, s in zip(old, new, sizes)]
                batch = batch.set_column(size, batch.schema.field(size), pa.array(sizes, batch.schema.field(size).type))
            yield batch

    return docs.mapInArrow(run, schema)
