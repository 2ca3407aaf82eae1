"""Boosted trees of many questions and folds, each fitted in one task on binned features, with patience on the held-out fold.

Second-order boosting of the logistic loss: a leaf is ``-G / (H + l2)`` of its rows' gradients and curvatures, a split is the one of
largest gain among the borders of at most 256 bins of each drawn feature. Rows are drawn for each tree, features too. Fitting ends
when ``patience`` trees in a row brought no better loss on the held-out fold, and the trees up to the best loss are kept.

A distributed learner needs some jobs for each level of each tree; here a fit is one task, which holds one byte for each of its
entries: 13 MB for 90,000 sessions of 150 features. Borders come from all rows, as quantiles of each part's quantiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrace.operators.model_table import Boosted, matrix, slices

BINS = 256


@dataclass(frozen=True)
class Settings:
    maxIter: int = 100
    maxDepth: int = 5
    stepSize: float = 0.1
    subsamplingRate: float = 1.0
    featureSubset: float = 1.0
    l2: float = 1.0
    patience: int | None = None
    seed: int = 42


def quantiles(values: np.ndarray, weight: np.ndarray, n: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """At most ``n`` rows that stand for the rows of ``values``, column by column, and the weight of each."""
    if len(values) <= n and (weight == weight[0]).all():
        return np.sort(values, axis=0), weight
    order = np.argsort(values, axis=0, kind="stable")
    at = (np.arange(n) + 0.5) / n * weight.sum()
    out = np.empty((n, values.shape[1]))
    for c in range(values.shape[1]):
        ends = np.cumsum(weight[order[:, c]])
        picked = np.minimum(np.searchsorted(ends, at), len(values) - 1)
        out[:, c] = values[order[picked, c], c]
    return out, np.full(n, weight.sum() / n)


def borders(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Of each feature the values at which it may be split: ``x <= border`` goes low."""
    every = np.arange(width)

    def merged(found: list) -> list:
        return [quantiles(np.concatenate([v for v, _ in found]), np.concatenate([w for _, w in found]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in (piece for whole in batches for piece in slices(whole, every)):
            x = matrix(batch.column(0), every)
            found.append(quantiles(x, np.ones(len(x))))
            if len(found) >= 16:
                found = merged(found)
        for values, weight in merged(found) if found else []:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.ascontiguousarray(values).tobytes()], pa.binary()), pa.array([weight.tobytes()], pa.binary())], names=["v", "w"])

    parts = rows.select("features").mapInArrow(run, "v binary, w binary").collect()  # one row a part
    values = np.concatenate([np.frombuffer(p["v"]).reshape(-1, width) for p in parts])
    own, _ = quantiles(values, np.concatenate([np.frombuffer(p["w"]) for p in parts]))
    return [np.unique(own[:, c])[:-1] for c in range(width)]


def _histograms(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Sums of gradients and curvatures, by feature, slot and bin."""
    out, base = np.empty((2, len(bins), n, BINS)), slot * BINS
    for i, own in enumerate(bins):
        key = base + own
        out[0, i], out[1, i] = (np.bincount(key, x, n * BINS).reshape(n, BINS) for x in (g, h))
    return out


def grown(
    bins: np.ndarray, g: np.ndarray, h: np.ndarray, drawn: np.ndarray, columns: np.ndarray, depth: int, l2: float,
) -> tuple[list[list], np.ndarray]:
    """``(nodes, node of each row)`` of one tree over the ``drawn`` rows; ``bins`` is features by rows.

    A node is ``[feature, bin, low, high, value, gain]``; a leaf has no feature. Of the two sides of a split the smaller one is added up,
    and the other is what is left of their node.
    """
    def leaf(gs: float, hs: float) -> list:
        return [None, None, None, None, -gs / (hs + l2), 0.0]

    at = np.zeros(bins.shape[1], np.int64)
    mine, gd, hd = bins[columns[:, None], drawn], g[drawn], h[drawn]
    sums = np.array([[gd.sum()], [hd.sum()]])
    nodes, level = [leaf(*sums[:, 0])], [0]  # the nodes that may be split
    found = _histograms(mine, np.zeros(len(drawn), np.int64), gd, hd, 1) if depth else None
    for step in range(depth):
        left = np.cumsum(found, axis=3)
        whole = sums[:, None, :, None]
        right = whole - left
        gain = (left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2)) - whole[0] ** 2 / (whole[1] + l2)
        gain[np.minimum(left[1], right[1]) <= 1e-9 * whole[1]] = -1  # an empty side
        gain = gain.transpose(1, 0, 2).reshape(len(level), -1)
        split, following, small = [], [], []
        for k, n in enumerate(level):
            best = int(gain[k].argmax())
            if not gain[k, best] > 1e-10:
                continue
            column, cut = divmod(best, BINS)
            sides = left[:, column, k, cut], right[:, column, k, cut]
            nodes[n] = [int(columns[column]), cut, len(nodes), len(nodes) + 1, None, float(gain[k, best])]
            small.append(len(nodes) + int(sides[1][1] < sides[0][1]))
            split.append(k)
            following += [len(nodes), len(nodes) + 1]
            nodes += [leaf(*side) for side in sides]
        if not split:
            break
        feature, cut, low = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        for n in (level[k] for k in split):
            feature[n], cut[n], low[n] = nodes[n][:3]
        inner = np.flatnonzero(feature[at] >= 0)
        of = at[inner]
        at[inner] = low[of] + (bins[feature[of], inner] > cut[of])
        if step == depth - 1:
            break
        slot = np.full(len(nodes), -1)
        slot[small] = np.arange(len(small))
        of = slot[at[drawn]]
        rows = np.flatnonzero(of >= 0)
        part = _histograms(mine[:, rows], of[rows], gd[rows], hd[rows], len(small))
        rest = found[:, :, split] - part
        found = np.empty((2, len(columns), len(following), BINS))
        for k, n in enumerate(small):
            second = n - following[2 * k]
            found[:, :, 2 * k + second], found[:, :, 2 * k + 1 - second] = part[:, :, k], rest[:, :, k]
        sums = found[:, 0].sum(axis=2) if len(columns) else sums
        level = following
    return nodes, at


def boosted(
    bins: np.ndarray, y: np.ndarray, weight: np.ndarray, held_out: np.ndarray, edges: Sequence[np.ndarray], s: Settings,
    out: Sequence[int] = (),
) -> Boosted:
    """One fit; ``bins`` is features by rows, ``weight`` counts on rows that are not held out."""
    rng = np.random.default_rng(s.seed)
    usable = np.array([c for c in range(len(edges)) if len(edges[c]) and c not in set(out)], np.int64)
    rows, valid = np.flatnonzero(~held_out), np.flatnonzero(held_out)
    raw, trees, gains = np.zeros(len(y)), [], []
    best, best_loss = 0, math.inf
    for tree in range(s.maxIter):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (p - y), weight * p * (1 - p)
        drawn = rows if s.subsamplingRate >= 1 else rows[rng.random(len(rows)) < s.subsamplingRate]
        columns = usable
        if s.featureSubset < 1 and len(usable):
            columns = np.sort(rng.choice(usable, max(1, round(len(usable) * s.featureSubset)), replace=False))
        nodes, at = grown(bins, g, h, drawn, columns, s.maxDepth if len(columns) else 0, s.l2)
        raw += s.stepSize * np.array([0.0 if n[4] is None else n[4] for n in nodes])[at]
        trees.append([  # a table's boosted models are of the margin's half
            (tree, s.stepSize, i, n[0], None if n[0] is None else float(edges[n[0]][n[1]]), n[2], n[3], None if n[4] is None else n[4] / 2)
            for i, n in enumerate(nodes)])
        gains.append([(n[0], n[5]) for n in nodes if n[0] is not None])
        if not len(valid) or s.patience is None:
            best = tree + 1
            continue
        loss = (np.logaddexp(0, raw[valid]) - y[valid] * raw[valid]).mean()
        if loss < best_loss:
            best, best_loss = tree + 1, loss
        elif tree + 1 - best >= s.patience:
            break
    total: dict[int, float] = {}
    for feature, gain in (x for own in gains[:best] for x in own):
        total[feature] = total.get(feature, 0.0) + gain
    columns = list(zip(*(node for own in trees[:best] for node in own)))
    return Boosted([np.array([np.nan if x is None else x for x in c]) for c in columns], len(edges), total, len(trees))


def fit_boosted(
    rows: DataFrame, keys: Sequence[tuple[int, int]], width: int, settings: dict[int, Settings], balanced: bool,
    out: dict[int, Sequence[int]],
) -> dict[tuple[int, int], Boosted]:
    """The fits ``keys`` (question, fold), each over its question's rows (``session, level, fold, correct, features``)."""
    spark, every = rows.sparkSession, np.arange(width)
    keys = list(keys)
    levels = sorted({level for level, _ in keys})
    rows = rows.where(F.col("level").isin(levels) & F.col("fold").isNotNull())
    edges = borders(rows, width)
    shared = spark.sparkContext.broadcast((edges, keys, settings, out))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value[0]
        for batch in (piece for whole in batches for piece in slices(whole, every)):
            x = matrix(batch.column(4), every)
            own = np.empty(x.shape, np.uint8)
            for c in range(width):
                own[:, c] = np.searchsorted(cuts[c], x[:, c], side="left")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([r.tobytes() for r in own], pa.binary())], names=["session", "level", "fold", "correct", "bins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, asked, given, left_out = shared.value
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        at = table.column("_k")[0].as_py()
        level, fold = asked[at]
        bins = np.concatenate([
            np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, width) for c in table.column("bins").chunks])
        session, folds, y = (table.column(c).to_numpy() for c in ("session", "fold", "correct"))
        order = np.lexsort((y, session))  # the order of rows must not depend on the shuffle, as rows are drawn
        bins, folds, y = np.ascontiguousarray(bins[order].T), folds[order], y[order].astype(np.float64)
        held_out = folds == fold
        weight = np.ones(len(y))
        if balanced:
            mine = y[~held_out]
            classes = {v: (mine == v).sum() for v in np.unique(mine)}
            for v, n in classes.items():
                weight[y == v] = len(mine) / (len(classes) * n)
        model = boosted(bins, y, weight, held_out, cuts, given[level], left_out.get(level, ()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([model.fitted], pa.int32()), pa.array([np.stack(model.columns).tobytes()], pa.binary()),
             pa.array([list(model.gain)], pa.list_(pa.int32())), pa.array([list(model.gain.values())], pa.list_(pa.float64()))],
            names=["k", "fitted", "nodes", "features", "gains"])

    bins = rows.select("session", "level", "fold", "correct", "features").mapInArrow(
        binned, "session long, level int, fold int, correct int, bins binary")
    ks = F.array(*[F.struct(F.lit(level).alias("_level"), F.lit(k).alias("_k")) for k, (level, _) in enumerate(keys)])
    own = F.transform(F.filter(ks, lambda x: x["_level"] == F.col("level")), lambda x: x["_k"])
    dealt = bins.withColumn("_k", F.explode(own)).repartitionById(len(keys), F.col("_k"))
    schema = "k int, fitted int, nodes binary, features array<int>, gains array<double>"
    models = {}
    try:
        for r in dealt.mapInArrow(run, schema).collect():  # one row a model
            columns = list(np.frombuffer(r["nodes"]).reshape(8, -1))
            models[keys[r["k"]]] = Boosted(columns, width, dict(zip(r["features"], r["gains"])), r["fitted"])
    finally:
        shared.destroy()
    if lost := [key for key in keys if key not in models]:
        raise ValueError(f"no rows to fit: {lost}")
    return {key: models[key] for key in keys}
