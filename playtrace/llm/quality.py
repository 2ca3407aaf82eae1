"""Quality rules as a short-circuit cascade: rules run by rejections per second, as measured on a sample, and each rule
sees only the texts that all earlier ones let pass."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import as_bytes, bounded_batches, mix64, windows, word_hashes

#: Documents on which costs and rejections are estimated; they only set the order, never a verdict.
SAMPLE = 2_000

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL, _WORD_CHAR, _UPPER, _LOWER = 1, 2, 4, 8
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in "#*$%&|<>"]] |= _SYMBOL
_KIND[[b for b in range(256) if b not in (9, 10, 11, 12, 13, 32) and b & 0xC0 != 0x80]] |= _WORD_CHAR
_KIND[ord("A"):ord("Z") + 1] |= _UPPER
_KIND[ord("a"):ord("z") + 1] |= _LOWER
_KIND_GROUP = 1 << 22


class Texts:
    """The texts of a batch with measures that are computed when first asked for, and survive ``take``."""

    def __init__(self, texts: list[bytes], known: dict[str, np.ndarray] | None = None):
        self.texts = texts
        self.known = known or {}

    def __len__(self) -> int:
        return len(self.texts)

    def take(self, at: np.ndarray) -> Texts:
        return Texts([self.texts[i] for i in at], {k: v[at] for k, v in self.known.items()})

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.known:
            self.known |= _MEASURED_BY[name](self.texts)
        return self.known[name]


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _KIND_GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _characters(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Symbols, code points in words, and capital and small letters A-Z."""
    out: dict[str, list[np.ndarray]] = {"n_symbols": [], "word_chars": [], "n_upper": [], "n_lower": []}
    for group in _groups(texts):
        kind = _KIND[np.frombuffer(b" ".join(group) + b" ", np.uint8)]
        starts = np.cumsum([0, *(len(x) + 1 for x in group[:-1])])
        for name, bit in (("n_symbols", _SYMBOL), ("word_chars", _WORD_CHAR), ("n_upper", _UPPER), ("n_lower", _LOWER)):
            out[name].append(np.add.reduceat((kind & bit != 0).astype(np.int64), starts))
    return {k: np.concatenate([np.empty(0, np.int64), *v]) for k, v in out.items()}


def _lines(texts: list[bytes]) -> dict[str, np.ndarray]:
    lines, repeated = [], []
    for text in texts:
        own = [x for x in text.split(b"\n") if x.strip()]
        lines.append(len(own))
        repeated.append(len(own) - len(set(own)))
    return {"n_lines": np.array(lines, np.int64), "n_dup_lines": np.array(repeated, np.int64)}


def _word_count(texts: list[bytes]) -> dict[str, np.ndarray]:
    return {"n_words": np.array([len(x.split()) for x in texts], np.int64)}


def _repeats(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Words that lie in a 5-word window found twice or more in their text."""
    n_words, n_repeat = [], []
    for group in _groups(texts):
        hashes, counts = word_hashes(group)
        owner = np.repeat(np.arange(len(group)), counts)
        window, at = windows(hashes, counts)
        key = window ^ mix64(owner[at].astype(np.uint64) + np.uint64(1))  # one sort for all texts
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        twice = np.zeros(len(key), bool)
        twice[order[same]] = twice[order[same + 1]] = True
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + 5, -1)
        covered = np.cumsum(cover)[:-1] > 0
        n_words.append(counts)
        n_repeat.append(np.bincount(owner[covered], minlength=len(group)).astype(np.int64))
    empty = np.empty(0, np.int64)
    return {"n_words": np.concatenate([empty, *n_words]), "n_repeat_words": np.concatenate([empty, *n_repeat])}


_MEASURED_BY: dict[str, Callable[[list[bytes]], dict[str, np.ndarray]]] = {
    "n_words": _word_count, "n_repeat_words": _repeats, "n_lines": _lines, "n_dup_lines": _lines,
    "n_symbols": _characters, "word_chars": _characters, "n_upper": _characters, "n_lower": _characters,
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts], np.ndarray]


#: ``few_words`` and ``repeats`` are the base rules.
RULES = (
    Rule("few_words", lambda t: t["n_words"] < 10),
    Rule("repeats", lambda t: 100 * t["n_repeat_words"] > 20 * t["n_words"]),
    Rule("symbols", lambda t: 25 * t["n_symbols"] > t["word_chars"]),
    Rule("dup_lines", lambda t: 2 * t["n_dup_lines"] > t["n_lines"]),
    Rule("shouting", lambda t: t["n_upper"] > t["n_lower"]),
    Rule("word_length", lambda t: (t["word_chars"] < 2 * t["n_words"]) | (t["word_chars"] > 20 * t["n_words"])),
)
BASE = ("few_words", "repeats")


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample: int = SAMPLE, seed: int = 8) -> DataFrame:
    """``rule, seconds, rejected, n`` over a sample of about ``sample`` rows of ``docs``, each rule on every sampled text."""
    rows = docs.count()
    own = docs.select(F.col(text).alias("text")).sample(min(1.0, sample / max(rows, 1)), seed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(0))
            found = []
            for rule in rules:
                began = time.perf_counter()
                rejected = int(rule.rejects(Texts(texts)).sum())
                found.append((rule.name, time.perf_counter() - began, rejected, len(texts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*found)], names=["rule", "seconds", "rejected", "n"])

    measured = own.mapInArrow(measure, "rule string, seconds double, rejected long, n long")
    return measured.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "n")])


def ordered(rules: Sequence[Rule], estimates: DataFrame) -> list[Rule]:
    """The rules by rejections per second, most first; without figures as they stand."""
    rate = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in estimates.collect()}  # one row per rule
    return sorted(rules, key=lambda r: -rate.get(r.name, 0.0))


def passed(texts: Texts, rules: Sequence[Rule]) -> np.ndarray:
    """Which texts no rule rejects; a rule sees only what the rules before it let pass."""
    alive, left = np.arange(len(texts)), texts
    for rule in rules:
        if not len(alive):
            break
        keep = np.flatnonzero(~rule.rejects(left))
        alive, left = alive[keep], left.take(keep)
    verdict = np.zeros(len(texts), bool)
    verdict[alive] = True
    return verdict


def filter_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. Null texts count as empty, so the base rules reject them."""
    bounded_batches(docs.sparkSession)
    order = ordered(rules, estimate(docs, rules, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            yield batch.filter(pa.array(passed(Texts(as_bytes(batch.column(at))), order)))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the measures, ``base_failed`` and ``kept``.

    The verdict comes from the cascade; the measures of rejected texts that it skipped are added after it, for the report.
    Rows that repeat an id stay rows of their own; a null text counts as empty; ids may be null.
    """
    bounded_batches(docs.sparkSession)
    order = ordered(rules, estimate(docs, rules, text))
    base = [r for r in rules if r.name in BASE]
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        own.schema["doc_id"], *[T.StructField(m, T.LongType()) for m in MEASURES],
        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(as_bytes(batch.column(1)))
            kept = passed(texts, order)
            failed = np.logical_or.reduce([r.rejects(texts) for r in base]) if base else np.zeros(len(texts), bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(texts[m]) for m in MEASURES], pa.array(failed), pa.array(kept & ~failed)],
                names=schema.names)

    return own.mapInArrow(run, schema)
