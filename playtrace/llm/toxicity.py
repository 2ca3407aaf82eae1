"""Toxicity by non-negative positive-unlabelled learning: numpy classifiers from confirmed toxic texts and unlabelled ones.

Features are words and beginnings of words, as hashes; a feature's value is log(1 + count) / log(10 + words of the text). Those kept
are the ones whose mean value over the confirmed texts lies furthest above that over all training texts, in standard errors.

The risk of a linear classifier under the sigmoid loss l is pi * E_P l(z) + max(0, E_U l(-z) - pi * E_P l(-z)), where pi is the share of
toxic rows among the labelled ones and U all training texts whatever their labels. Where the second term turns negative, its own
gradient is climbed instead. U is dealt into parts of bounded size; a classifier is fitted to each part and all confirmed texts,
and the classifiers are averaged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import BYTE_HASH, CHUNK, SPACE, as_bytes, bounded_batches, mix64, powers, stored

#: Confirmed toxic rows that a fit takes at most: those with the smallest hashes.
MOST_POSITIVE = 8_192
#: Texts of a part of U, about; each part makes a classifier.
PART = 16_384
#: Features that are compared: the most frequent ones in confirmed texts, each in this share of them or more.
MOST_CANDIDATES, LEAST_SHARE = 1 << 15, 0.005
#: Features of the model, and how many standard errors they must stand out.
FEATURES, LEAST_ERRORS = 512, 2.0
#: Bytes of the beginnings of words.
BEGINNINGS = (4, 5, 6, 7)
STEPS, RATE, DECAY = 300, 0.05, 1e-3
BLOCK = 2_048

_LETTER = np.array([b > 0x7F or chr(b).isalnum() for b in range(256)])
_CELLS = np.uint64((1 << 20) - 1)


@dataclass(frozen=True)
class Model:
    """Hashes of the features, sorted; their weights by unit of value, and the intercept."""

    feature: np.ndarray
    weight: np.ndarray
    intercept: float


class Known:
    """Places of hashes in a sorted list; a table of bits turns most others away."""

    def __init__(self, feature: np.ndarray):
        self.feature = feature
        self.cell = np.zeros(int(_CELLS) + 1, bool)
        self.cell[(feature & _CELLS).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(which of the hashes are listed, their places)``"""
        maybe = np.flatnonzero(self.cell[(hashes & _CELLS).astype(np.int64)])
        at = np.searchsorted(self.feature, hashes[maybe])
        at[at == len(self.feature)] = 0
        hit = self.feature[at] == hashes[maybe] if len(self.feature) else np.zeros(len(maybe), bool)
        return maybe[hit], at[hit]


def held_out(doc_id: str | Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether the CRC-32 of the id as text, modulo ``folds``, is ``fold``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], bytes]]:
    """Buffers of about ``CHUNK`` bytes, with the number of the text of each line; a long text is cut where no word is."""
    owner: list[int] = []
    lines: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = min(at + CHUNK, len(text))
            while end < len(text) and not SPACE[text[end]]:
                end += 1
            owner.append(i)
            lines.append(text[at:end])
            size += end - at + 1
            at = end
            if size >= CHUNK:
                yield owner, lines
                owner, lines, size = [], [], 0
            if at >= len(text):
                break
    if lines:
        yield owner, lines


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(hashes, text of each, words of each text in this piece)``, a bounded piece at a time; ``texts`` are in small letters A-Z."""
    reach = max(BEGINNINGS)
    for owner, lines in _pieces(texts):
        b = np.frombuffer(b" " + b" ".join(lines) + b" " * (reach + 1), np.uint8)
        letter = _LETTER[b]
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        start, end = edge[0::2], edge[1::2]
        ends = np.cumsum([len(x) + 1 for x in lines])
        text = np.array(owner, np.int64)[np.searchsorted(ends, start - 1, side="right")] if len(start) else start
        up, down = powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(BYTE_HASH[b] * up[:-1], out=total[1:])
        hashes, owners = [mix64((total[end] - total[start]) * down[start])], [text]
        for k in BEGINNINGS:
            at = start[end - start > k]
            hashes.append(mix64((total[at + k] - total[at]) * down[at] + np.uint64(k)))
            owners.append(text[end - start > k])
        yield np.concatenate(hashes), np.concatenate(owners), np.bincount(text, minlength=len(texts))


def vectors(texts: list[bytes], known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, place of the feature, value)`` of the listed features of each text, sorted."""
    words, keys, counts = np.zeros(len(texts), np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    width = max(len(known.feature), 1)
    for hashes, owner, n in features(texts):
        words += n
        hit, at = known(hashes)
        key, count = np.unique(owner[hit] * width + at, return_counts=True)
        keys.append(key)
        counts.append(count)
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(back, np.concatenate(counts), len(key))
    text, at = key // width, key % width
    return text, at, np.log1p(count) / np.log(10.0 + words[text])


def _positives(labels: DataFrame, most: int) -> tuple[DataFrame, float | None]:
    """The ids of at most ``most`` confirmed rows, and the share of toxic ones among all labelled; both of the training fold.

    An id that has several labels is toxic if one of them says so; rows without id or label say nothing.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    return known.where("toxic > 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id"), share


def _held(text: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(feature, texts that hold it)``"""
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for h, owner, _ in features(text):
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        hashes.append(h[new])
        owners.append(owner[new])
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((owner, h))  # a text may have been cut
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return np.unique(h[new], return_counts=True)


def candidates(texts: DataFrame, most: int = MOST_CANDIDATES, share: float = LEAST_SHARE) -> np.ndarray:
    """Hashes of the features that at least ``share`` of the texts (and two) hold, at most ``most``, by frequency; sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, n = _held(as_bytes(batch.column(0), lower=True))
            yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n)], names=["feature", "n"])

    least = max(2, math.ceil(share * texts.count()))
    held = texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    top = held.where(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(most).select("feature").toArrow()
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def moments(texts: DataFrame, feature: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """``(rows, sums of the values, sums of their squares)`` of each feature over all rows of the one column of ``texts``."""
    spark = texts.sparkSession
    listed, width = spark.sparkContext.broadcast(feature), len(feature)
    schema = "block int, rows long, sums binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, sums = Known(listed.value), 0, np.zeros((2, width))
        for batch in batches:
            _, at, value = vectors(as_bytes(batch.column(0), lower=True), known)
            rows += batch.num_rows
            sums[0] += np.bincount(at, value, width)
            sums[1] += np.bincount(at, value * value, width)
        if rows:
            starts = range(0, width, BLOCK)
            yield pa.RecordBatch.from_arrays([
                pa.array([a // BLOCK for a in starts], pa.int32()), pa.array([rows] * len(starts), pa.int64()),
                pa.array([sums[:, a:a + BLOCK].tobytes() for a in starts], pa.binary())], names=["block", "rows", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for block, rows, own in zip(*(c.to_pylist() for c in batch.columns)):
                n, sums = total.get(block, (0, 0.0))
                total[block] = (n + rows, sums + np.frombuffer(own))
        yield pa.RecordBatch.from_arrays([
            pa.array(list(total), pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()),
            pa.array([x.tobytes() for _, x in total.values()], pa.binary())], names=["block", "rows", "sums"])

    rows, sums = 0, np.zeros((2, width))
    for r in texts.mapInArrow(run, schema).repartition("block").mapInArrow(add, schema).collect():  # a row for each block
        own = np.frombuffer(r["sums"]).reshape(2, -1)
        rows, sums[:, r["block"] * BLOCK:r["block"] * BLOCK + own.shape[1]] = r["rows"], own
    return rows, sums[0], sums[1]


def chosen(confirmed: DataFrame, training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes of the features that stand out in the confirmed texts, sorted; the unit of each value)``"""
    feature = candidates(confirmed)
    if not len(feature):
        return feature, np.empty(0)
    n_p, sum_p, _ = moments(confirmed, feature)
    n_u, sum_u, square_u = moments(training, feature)
    mean = sum_u / n_u
    spread = np.sqrt(np.maximum(square_u / n_u - mean * mean, 0))
    errors = np.round((sum_p / n_p - mean) / (spread + 1e-9) * math.sqrt(n_p), 6)
    first = np.lexsort((feature, -errors))[:FEATURES]
    first = np.sort(first[errors[first] > LEAST_ERRORS])
    return feature[first], np.maximum(spread[first], 0.02)


def sparse(docs: DataFrame, feature: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, at, value``: which of the features each row has, and their values."""
    spark = docs.sparkSession
    listed = spark.sparkContext.broadcast(feature)
    own = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    schema = T.StructType([
        *own.schema.fields[:2], T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(listed.value)
        for batch in batches:
            owner, at, value = vectors(as_bytes(batch.column(2), lower=True), known)
            ends = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(value.astype(np.float32)))], names=schema.names)

    return own.mapInArrow(run, schema)


def _matrix(table: pa.Table, unit: np.ndarray) -> np.ndarray:
    """The rows ``at, value`` as a dense matrix, values by their unit."""
    at, value = (table.column(c).combine_chunks() for c in ("at", "value"))
    out = np.zeros((len(table), len(unit)), np.float32)
    row = np.repeat(np.arange(len(table)), np.diff(at.offsets.to_numpy()))
    places = at.flatten().to_numpy()
    out[row, places] = value.flatten().to_numpy() / unit[places]
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, weight_p: np.ndarray | None = None, weight_u: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the intercept of a classifier of least non-negative risk (Adam, all rows in each step)."""
    share_p = np.full(len(positive), 1.0) if weight_p is None else weight_p
    share_u = np.full(len(unlabelled), 1.0) if weight_u is None else weight_u
    share_p, share_u = share_p / share_p.sum(), share_u / share_u.sum()
    w, b = np.zeros(positive.shape[1], np.float32), math.log(prior / (1 - prior))
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        p, u = _sigmoid(positive @ w + b), _sigmoid(unlabelled @ w + b)
        slope_p, slope_u = share_p * p * (1 - p), share_u * u * (1 - u)
        if share_u @ u >= prior * (share_p @ p):
            slope_p, slope_u = -2 * prior * slope_p, slope_u  # of pi * E_P l(z) and of the negative risk
        else:
            slope_p, slope_u = prior * slope_p, -slope_u  # up the negative risk alone
        gradient = np.append(
            positive.T @ slope_p.astype(np.float32) + unlabelled.T @ slope_u.astype(np.float32) + DECAY * w,
            slope_p.sum() + slope_u.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient * gradient
        move = RATE * mean / (1 - 0.9 ** step) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), b - move[-1]
    return np.append(w.astype(np.float64), b)


def train(rows: DataFrame, ids: DataFrame, feature: np.ndarray, unit: np.ndarray, prior: float, part: int = PART) -> Model:
    """The mean of the classifiers of all parts of the training rows of ``sparse``.

    Equal rows count as one row of their number. A row that stands for as many rows as there are parts goes to each of them with its
    share; so neither a part nor its weight grows with a group of copies.
    """
    spark = rows.sparkSession
    training = rows.where(~F.col("held_out"))
    equal = training.groupBy("at", "value").agg(F.count("*").alias("n"))
    n = training.count()
    parts = max(1, -(-n // part))
    order = F.xxhash64("at", "value")
    confirmed = training.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("at", "value").agg(F.count("*").alias("n"))
    confirmed = confirmed.orderBy(order, "at", "value").limit(MOST_POSITIVE).toArrow()  # bounded by its limit
    if not len(confirmed):
        return Model(feature[:0], np.empty(0), -math.inf)
    positive = spark.sparkContext.broadcast((_matrix(confirmed, unit), confirmed.column("n").to_numpy().astype(np.float64)))
    everywhere = F.col("n") >= parts
    dealt = equal.select(
        "at", "value", order.alias("key"),
        F.when(everywhere, F.col("n") / F.lit(parts)).otherwise(F.col("n")).cast("double").alias("n"),
        F.explode(F.when(everywhere, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(
            F.array(F.pmod(order, F.lit(parts)).cast("int")))).alias("part"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("n", "ascending")])
        x, weight = positive.value
        found = fit(x, _matrix(table, unit), prior, weight, table.column("n").to_numpy())
        return pa.table({"k": np.arange(len(found), dtype=np.int32), "w": found})

    fitted = dealt.groupBy("part").applyInArrow(run, "k int, w double").groupBy("k").agg(F.avg("w").alias("w"))
    found = np.zeros(len(feature) + 1)
    for r in fitted.collect():  # one row per feature
        found[r["k"]] = r["w"]
    return Model(feature, found[:-1] / unit, float(found[-1]))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``sparse``."""
    own = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([
        *rows.schema.fields[:2], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, intercept = own.value.weight, own.value.intercept
        for batch in batches:
            at, value = batch.column(2), batch.column(3)
            owner = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
            sums = np.bincount(owner, weight[at.flatten().to_numpy()] * value.flatten().to_numpy(), len(at)) if len(weight) else np.zeros(len(at))
            p = _sigmoid(sums + intercept) if math.isfinite(intercept) else np.zeros(len(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)


def fit_and_score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``; ``labels`` has ``doc_id, toxic``.

    Only labels of the training fold are read, and no text of the other fold is learned from. A null or empty text has no features:
    its score is that of the intercept. Rows that repeat an id are scored by their own texts; a null id is held out. Without
    confirmed toxic texts every score is 0. Columns of other names are ignored.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    training = own.where(~held_out("doc_id"))
    positives, prior = _positives(labels, MOST_POSITIVE)
    ids = stored(positives, "toxic-ids")
    confirmed = stored(training.join(F.broadcast(ids), "doc_id", "left_semi").select("text"), "toxic-texts")
    feature, unit = chosen(confirmed, training.select("text"))
    rows = stored(sparse(own, feature), "toxic-features")
    if not len(feature):
        return score(rows, Model(feature, np.empty(0), -math.inf))
    return score(rows, train(rows, ids, feature, unit, min(max(prior, 1e-3), 1 - 1e-3)))
