"""Target-distribution importance resampling: gains per hashed word, drawn by Gumbel keys, ranked by a distributed radix sort.

The sort is least significant digit first. Rows stand in parts of bounded size, in the order of their places. A pass counts the
digits of each part, turns the counts into offsets (those of smaller digits anywhere, and of the same digit in earlier parts), and
deals each row to its new place; equal digits keep their order. After the last digit a row's place is its rank. The digits
are those of the composite key (score downwards, id upwards), as many as the ranges found in the data need.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import CHUNK, SPACE, as_bytes, bounded_batches, stored

BUCKETS = 10_000
#: Bits of a digit: a pass counts at most so many digits in a part, and collects as many totals.
BITS = 13
#: Rows of a part: a share of all rows between these bounds.
PART_ROWS, SHARE = (1 << 12, 1 << 18), 256
#: Words whose bucket a worker remembers; beyond that it starts afresh.
KEPT = 500_000

# Everything but digits, letters and bytes above ASCII parts words; A-Z become small.
_TABLE = bytes(
    ord(c.lower()) if (c := chr(b)).isascii() and c.isalnum() else b if b > 0x7F else 32 for b in range(256))


@dataclass(frozen=True)
class Draw:
    """``share`` of the documents with ``least_words`` or more are drawn."""

    seed: int = 2024
    least_words: int = 20
    percent: int = 10


class _Buckets(dict):
    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        self[word] = found = zlib.crc32(word) % self.buckets
        return found


def _pieces(text: bytes) -> Iterator[bytes]:
    """Bounded pieces of a text, cut where a word cannot be."""
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end < len(text) and not SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def features(text: bytes, known: _Buckets) -> Iterator[np.ndarray]:
    """The buckets of all words of a text, a bounded piece at a time."""
    for piece in _pieces(text):
        words = piece.translate(_TABLE).split()
        yield np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Words per bucket over all rows of the one column of ``texts``; tasks add up before they hand on."""
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), _Buckets(buckets)
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                for own in features(text, known):
                    total += np.bincount(own, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm by which each bucket is more frequent in the target, both smoothed by one."""
    n, (all_s, all_t) = len(source), (int(source.sum()), int(target.sum()))
    ratios = [((t + 1) * (all_s + n)) / ((s + 1) * (all_t + n)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths from the SHA-256 of seed and id; a null id counts as the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, draw: Draw = Draw(), doc_id: str | Column = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score`` of each row; a null or empty text has no features and weight 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    table = spark.sparkContext.broadcast(gain)
    own = docs.select((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType.fromDDL("doc_id long, n_features long, weight long, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, by_bucket = _Buckets(len(table.value)), table.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [[(len(x), int(by_bucket[x].sum())) for x in features(t, known)] for t in as_bytes(batch.column(1))]
            n = np.array([sum(a for a, _ in x) for x in found], np.int64)
            weight = np.array([sum(b for _, b in x) for x in found], np.int64)
            score = weight + np.array([noise(i, draw.seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight), pa.array(score)], names=schema.names)

    return own.mapInArrow(run, schema)


def _part_rows(rows: int) -> int:
    return min(max(rows // SHARE, PART_ROWS[0]), PART_ROWS[1])


def _digits(low: int, high: int) -> list[int]:
    """The shifts of the digits that numbers from 0 to ``high - low`` need, lowest first."""
    return list(range(0, max((high - low).bit_length(), 1), BITS))


def _pass(rows: DataFrame, digit: Column, size: int, label: str) -> DataFrame:
    """One stable counting sort of ``rows`` (``place`` and others) by ``digit``: ``place`` becomes that in the new order."""
    dealt = rows.withColumn("_part", F.floor(F.col("place") / size)).withColumn("_digit", digit.cast("int"))
    counts = stored(dealt.groupBy("_part", "_digit").count(), f"{label}-counts")
    totals = {r["_digit"]: r["n"] for r in counts.groupBy("_digit").agg(F.sum("count").alias("n")).collect()}  # one row per digit
    starts = np.zeros((1 << BITS) + 1, np.int64)
    for d, n in totals.items():
        starts[d + 1] = n
    starts = np.cumsum(starts)
    before = rows.sparkSession.sparkContext.broadcast(starts)
    earlier = "sum(count) OVER (PARTITION BY _digit ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = counts.select("_part", "_digit", F.coalesce(F.expr(earlier), F.lit(0)).alias("_earlier"))
    names = rows.columns

    def deal(own: pa.Table, offset: pa.Table) -> pa.Table:
        own = own.sort_by("place")
        digits = own.column("_digit").to_numpy()
        order = np.argsort(digits, kind="stable")
        sorted_digits = digits[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_digits[1:] != sorted_digits[:-1])))
        nth = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
        earlier = np.zeros(1 << BITS, np.int64)
        earlier[offset.column("_digit").to_numpy()] = offset.column("_earlier").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = before.value[sorted_digits] + earlier[sorted_digits] + nth
        own = own.select(names)
        return own.set_column(names.index("place"), "place", pa.array(place))

    return stored(dealt.groupBy("_part").cogroup(offsets.groupBy("_part")).applyInArrow(deal, rows.schema), label)


def ranked(rows: DataFrame, score: str = "score", doc_id: str = "doc_id") -> DataFrame:
    """``rows`` with ``place`` from 0: highest score first, equal scores by smaller id, null ids last.

    Rows that agree in both follow one another in any order. Both columns are long; no rows: no rows.
    """
    first = stored(rows.withColumn("place", F.monotonically_increasing_id()), "radix-0")
    low, high, least, most, n, nulls = first.agg(
        F.min(score), F.max(score), F.min(doc_id), F.max(doc_id), F.count("*"), F.count_if(F.col(doc_id).isNull())).first()
    if not n:
        return first
    size = _part_rows(n)
    own = F.coalesce(F.col(doc_id), F.lit(least or 0))
    if least is not None and most - least >= 1 << 63:  # the sign bit turned, so that the order is that of unsigned numbers
        own, least, most = own.bitwiseXOR(F.lit(-(1 << 63))), 0, (1 << 64) - 1
    else:
        own, least, most = own - F.lit(least or 0), 0, (most or 0) - (least or 0)
    keys = [(own, s) for s in _digits(least, most)]
    if nulls:
        keys.append((F.col(doc_id).isNull().cast("long"), 0))
    keys += [(F.lit(high) - F.col(score), s) for s in _digits(low, high)]
    out = first
    for k, (key, shift) in enumerate(keys, 1):
        out = _pass(out, F.shiftrightunsigned(key, shift).bitwiseAND((1 << BITS) - 1), size, f"radix-{k}")
    return out


def resample(
        docs: DataFrame, target: DataFrame, draw: Draw = Draw(), doc_id: str = "doc_id", text: str = "text",
        target_text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_features, weight, score, rank``; rank is null where the row is not drawn.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) highest scores are drawn. Without target texts the
    gains follow from the documents alone. Rows that repeat an id have the same noise; equal scores go to smaller ids.
    """
    gain = gains(bucket_counts(docs.select(text), buckets), bucket_counts(target.select(target_text), buckets))
    scored = stored(weigh(docs, gain, draw, doc_id, text), "importance")
    able = F.col("n_features") >= draw.least_words
    sorted_rows = ranked(scored.where(able))
    drawn = draw.percent * scored.where(able).count() // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return sorted_rows.withColumn("rank", rank).drop("place").unionByName(rest)
