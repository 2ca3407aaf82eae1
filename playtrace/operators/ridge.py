"""Logistic regressions with an L2 penalty, of all questions and folds over the same sessions, fitted together.

A session's vector is the same for each of its questions, and a fold leaves out some of the sessions. So the vectors are dealt once, as
blocks of a matrix on the executors' disks, and a pass over them gives the losses and gradients of all models, as products of matrices.
The models are those of ``pyspark.ml``'s ``LogisticRegression``: the same objective (mean weighted loss, penalty on the coefficients of
features divided by their deviation over the rows of the fit, none on the intercept), whose least point is only one.

The curvature of the loss is at most a quarter of that of the features, which all models share: steps start from its inverse (up to
``MOST_CURVED`` features) and are mended by a memory of earlier ones, so that some ten passes are enough.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrace.operators.model_table import matrix, slices

#: Features of which the driver holds a matrix of all pairs; more are scaled one by one.
MOST_CURVED = 3_072
#: Entries of the matrix in one part, and the most parts, each of which hands on one matrix of features by models.
PART_ENTRIES, MOST_PARTS = 4_000_000, 128
#: Cells of a stored block.
BLOCK_CELLS = 1 << 19
#: Bytes of all parts' sums that go to the driver as they are; more are added up on the executors, in pieces of ``PIECE`` numbers.
COLLECTED, PIECE = 64 << 20, 1 << 18
MEMORY = 10

_BLOCK = "n int, folds binary, neg binary, pos binary, used binary, x binary"


@dataclass
class Fit:
    """One model: its question and fold, the weights of its classes, and the features that it leaves out."""

    level: int
    fold: int
    weight: tuple[float, float] = (1.0, 1.0)
    out: Sequence[int] = ()


def _blocks(rows: DataFrame, levels: Sequence[int], width: int) -> DataFrame:
    """``rows`` (``fold, levels, correct, features``) as blocks: the features that some row has, and counts of labels by question."""
    place = {level: i for i, level in enumerate(levels)}
    every = np.arange(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, every, BLOCK_CELLS):
                n, asked, truth = batch.num_rows, batch.column(1), batch.column(2)
                row = np.repeat(np.arange(n), np.diff(asked.offsets.to_numpy()))
                at = np.array([place.get(x, -1) for x in asked.flatten().to_pylist()], np.int64)
                y = np.array([-1 if x is None else x for x in truth.flatten().to_pylist()], np.int64)
                counts = []
                for label in (0, 1):
                    own = (at >= 0) & (y == label)
                    count = np.zeros((n, len(place)), np.float32)
                    np.add.at(count, (row[own], at[own]), 1)
                    counts.append(count.tobytes())
                x = matrix(batch.column(3), every)
                used = np.flatnonzero(x.any(axis=0))
                folds = np.array([-1 if f is None else f for f in batch.column(0).to_pylist()], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int32()), *[pa.array([b], pa.binary()) for b in (
                        folds.tobytes(), *counts, used.tobytes(), np.ascontiguousarray(x[:, used]).tobytes())]],
                    names=["n", "folds", "neg", "pos", "used", "x"])

    return rows.select("fold", "levels", "correct", "features").mapInArrow(run, _BLOCK)


def _each(blocks: Iterator[pa.RecordBatch], fits: Sequence[Fit], levels: Sequence[int]) -> Iterator[tuple]:
    """``used, x, w0, w1`` of each block: its matrix, and the weights of its rows' labels 0 and 1 in each fit."""
    of = np.array([levels.index(f.level) for f in fits])
    left_out = np.array([f.fold for f in fits])
    weight = np.array([f.weight for f in fits])
    for batch in blocks:
        for i in range(batch.num_rows):
            n = batch.column(0)[i].as_py()
            folds, neg, pos, used, x = (
                np.frombuffer(batch.column(k)[i].as_buffer(), t)
                for k, t in ((1, np.int32), (2, np.float32), (3, np.float32), (4, np.int64), (5, np.float64)))
            inside = folds[:, None] != left_out[None, :]
            w0, w1 = (c.reshape(n, -1)[:, of] * inside * weight[:, k] for k, c in ((0, neg), (1, pos)))
            yield used, x.reshape(n, len(used)), w0, w1


def _sums(blocks: DataFrame, fits: Sequence[Fit], levels: Sequence[int], shapes: Sequence[tuple], add: Callable, shared) -> list[np.ndarray]:
    """What ``add(sums, shared value, used, x, w0, w1)`` adds up over all blocks, each part for itself at first."""
    sent = blocks.sparkSession.sparkContext.broadcast(shared)
    size = sum(math.prod(s) for s in shapes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.zeros(size)
        sums = _views(flat, shapes)
        for block in _each(batches, fits, levels):
            add(sums, sent.value, *block)
        for a in range(0, size, PIECE):
            yield pa.RecordBatch.from_arrays(
                [pa.array([a], pa.int64()), pa.array([flat[a:a + PIECE].tobytes()], pa.binary())], names=["a", "sums"])

    def together(pieces: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer()) for p in pieces.column("sums"))
        return pa.table({"a": pieces.column("a")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(run, "a long, sums binary")
    if size * 8 * blocks.rdd.getNumPartitions() > COLLECTED:
        parts = parts.groupBy("a").applyInArrow(together, "a long, sums binary")
    flat = np.zeros(size)
    try:
        for a, part in parts.collect():
            part = np.frombuffer(part)
            flat[a:a + len(part)] += part
    finally:
        sent.destroy()
    return _views(flat, shapes)


def _views(flat: np.ndarray, shapes: Sequence[tuple]) -> list[np.ndarray]:
    ends = np.cumsum([math.prod(s) for s in shapes])
    return [flat[end - math.prod(s):end].reshape(s) for s, end in zip(shapes, ends)]


def _add_means(sums, shared, used, x, w0, w1) -> None:
    sums[0][used] += x.sum(axis=0)
    sums[1][0] += len(x)
    sums[2] += np.stack([w0.sum(axis=0), w1.sum(axis=0)])


def _add_moments(sums, mean, used, x, w0, w1) -> None:
    d = np.repeat(-mean[None, :], len(x), axis=0)
    d[:, used] += x
    w = w0 + w1
    sums[0] += d.T @ w
    sums[1] += (d * d).T @ w
    if sums[2].ndim == 2:
        sums[2] += d.T @ d
    else:
        sums[2] += (d * d).sum(axis=0)


def _add_losses(sums, at, used, x, w0, w1) -> None:
    coefficients, intercept = at
    margin = x @ coefficients[used] + intercept
    grown = np.exp(-np.abs(margin))
    soft = np.log1p(grown) + np.maximum(margin, 0)
    p = np.where(margin >= 0, 1.0, grown) / (1 + grown)
    sums[0] += (w1 * (soft - margin) + w0 * soft).sum(axis=0)
    off = w1 * (p - 1) + w0 * p
    sums[1][used] += x.T @ off
    sums[2] += off.sum(axis=0)


def least(evaluate: Callable, start: np.ndarray, first: Callable, tol: float, most: int) -> np.ndarray:
    """The least points of several convex functions, one in each column: L-BFGS with ``first`` as the first inverse of the curvature.

    ``evaluate(points, ks)`` gives values and gradients of the functions ``ks``, and ``first(gradients, ks)`` is linear. A function is done when what its next step promises is
    below ``tol`` squared of its value, or after ``most`` passes.
    """
    x = start.copy()
    every = np.arange(x.shape[1])
    f, g = evaluate(x, every)
    step, steps, changes, rho = np.ones(len(every)), [], [], []

    def direction(ks: np.ndarray) -> np.ndarray:
        q, kept = g[:, ks].copy(), []
        for s, y, r in zip(reversed(steps), reversed(changes), reversed(rho)):
            a = r[ks] * (s[:, ks] * q).sum(axis=0)
            kept.append(a)
            q -= a * y[:, ks]
        q = first(q, ks)
        for (s, y, r), a in zip(zip(steps, changes, rho), reversed(kept)):
            q += s[:, ks] * (a - r[ks] * (y[:, ks] * q).sum(axis=0))
        return -q

    d = direction(every)
    slope = (g * d).sum(axis=0)
    open_ = -slope > tol * tol * np.abs(f)
    for _ in range(most):
        ks = np.flatnonzero(open_)
        if not len(ks):
            break
        to = x[:, ks] + step[ks] * d[:, ks]
        f_to, g_to = evaluate(to, ks)
        good = f_to <= f[ks] + 1e-4 * step[ks] * slope[ks] + 1e-14 * np.abs(f[ks])
        moved = ks[good]
        if len(moved):
            s, y, r = np.zeros_like(x), np.zeros_like(x), np.zeros(x.shape[1])
            s[:, moved], y[:, moved] = to[:, good] - x[:, moved], g_to[:, good] - g[:, moved]
            curved = (s * y).sum(axis=0)
            r[curved > 0] = 1 / curved[curved > 0]
            steps, changes, rho = [*steps, s][-MEMORY:], [*changes, y][-MEMORY:], [*rho, r][-MEMORY:]
            x[:, moved], f[moved], g[:, moved], step[moved] = to[:, good], f_to[good], g_to[:, good], 1.0
            d[:, moved] = direction(moved)
            slope[moved] = (g[:, moved] * d[:, moved]).sum(axis=0)
            open_[moved] = -slope[moved] > tol * tol * np.abs(f[moved])
        missed = ks[~good]
        step[missed] /= 2
        open_[missed] &= step[missed] > 1e-9
    return x


def fit_ridges(
    rows: DataFrame, fits: Sequence[Fit], width: int, n_rows: int, reg: float, tol: float = 1e-6, most: int = 100,
) -> list[tuple[np.ndarray, float]]:
    """``(coefficients, intercept)`` of each fit over ``rows`` (``fold, levels, correct, features``) outside of its fold.

    A fit whose rows are of one class has no coefficients and an infinite intercept, as in ``pyspark.ml``.
    """
    levels = sorted({f.level for f in fits})
    parts = min(max(1, math.ceil(n_rows * width / PART_ENTRIES)), MOST_PARTS)
    blocks = _blocks(rows, levels, width).coalesce(parts).persist(StorageLevel.DISK_ONLY)
    try:
        return _fitted(blocks, fits, levels, width, reg, tol, most)
    finally:
        blocks.unpersist()


def _fitted(blocks, fits, levels, width, reg, tol, most) -> list[tuple[np.ndarray, float]]:
    total, n, by_class = _sums(blocks, fits, levels, [(width,), (1,), (2, len(fits))], _add_means, None)
    if not (by_class.sum(axis=0) > 0).all():
        raise ValueError("no rows to fit: " + str([(f.level, f.fold) for f, w in zip(fits, by_class.sum(axis=0)) if not w]))
    mean = total / n[0]
    curved = width <= MOST_CURVED
    pairs = (width, width) if curved else (width,)
    first, second, spread = _sums(blocks, fits, levels, [(width, len(fits))] * 2 + [pairs], _add_moments, mean)
    weight = by_class.sum(axis=0)
    # of a fit: the sample form for weighted rows; a class's weights are equal, so the sum of their squares is their sum times one
    squares = (by_class * np.array([f.weight for f in fits]).T).sum(axis=0)
    free = weight - squares / weight
    variance = np.maximum(second - first * first / weight, 0) / np.where(free > 0, free, np.inf)
    variance[variance <= 1e-14 * (second / weight)] = 0
    spread /= n[0]
    scale = np.sqrt(np.diag(spread) if curved else spread)
    scale[scale == 0] = 1.0
    out = [(np.zeros(width), math.inf if ones else -math.inf) for ones in by_class[1] > 0]
    live = np.flatnonzero((by_class > 0).all(axis=0))
    if not len(live):
        return out
    asked, weight, variance = [fits[k] for k in live], weight[live], variance[:, live]
    used = variance > 0
    for k, f in enumerate(asked):
        used[list(f.out), k] = False
    penalty = reg * variance / (scale * scale)[:, None]
    inverse = np.linalg.inv(spread / scale / scale[:, None] / 4 + max(reg, 1e-6) * np.eye(width)) if curved else None

    def near(q: np.ndarray, ks: np.ndarray) -> np.ndarray:
        own = inverse @ q[:-1] if curved else q[:-1] / (0.25 + reg)
        return np.concatenate([np.where(used[:, ks], own, 0.0), 4 * q[-1:]])

    def raw(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coefficients = x[:-1] / scale[:, None]
        return coefficients, x[-1] - mean @ coefficients

    def evaluate(x: np.ndarray, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, shapes = [asked[k] for k in ks], [(len(ks),), (width, len(ks)), (len(ks),)]
        loss, slope, off = _sums(blocks, own, levels, shapes, _add_losses, raw(x))
        penalised = penalty[:, ks] * x[:-1]
        towards = (slope - mean[:, None] * off) / scale[:, None] / weight[ks] + penalised
        return (loss / weight[ks] + (penalised * x[:-1]).sum(axis=0) / 2,
                np.concatenate([np.where(used[:, ks], towards, 0.0), (off / weight[ks])[None, :]]))

    start = np.zeros((width + 1, len(live)))
    start[-1] = np.log(by_class[1, live] / by_class[0, live])
    coefficients, intercept = raw(least(evaluate, start, near, tol, most))
    for i, k in enumerate(live):
        out[k] = coefficients[:, i], float(intercept[i])
    return out
