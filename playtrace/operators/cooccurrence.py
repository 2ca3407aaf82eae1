"""Token vectors from co-occurrence counts: positive pointwise mutual information, factored by a block power iteration.

Counts, the matrix and the vectors are tables; the driver holds only matrices of ``dim`` by ``dim`` numbers. The same events give the
same vectors, but for the last digits of sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrace.plans.skew import CHECK, reliable, with_row_number
from playtrace.schema import EVENT_ORDER, SESSION

#: Positions of a session that are looked at together; its neighbours beyond the border are dealt to it as well.
PIECE = 10_000


def pair_counts(
    events: DataFrame, column: str, window: int = 5, keys: tuple[str, ...] = (SESSION,), piece: int = PIECE, hot=CHECK,
) -> DataFrame:
    """``a, b, n``: how often token b stands up to ``window`` places after token a, or before it, in the order of a session.

    Null tokens are left out first. A session is looked at in pieces of bounded length that overlap by the window, so the
    longest session takes no more of a task than any other; pairs are counted map-side.
    """
    tokens = events.where(F.col(column).isNotNull()).withColumn("_token", F.col(column).cast("string"))
    placed = with_row_number(tokens, list(keys), EVENT_ORDER, "_rn", hot=hot).select(
        *keys, "_token", (F.col("_rn") - 1).alias("_at"))
    own = F.floor(F.col("_at") / piece)
    pieces = F.when((F.col("_at") % piece < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = placed.withColumn("_piece", F.explode(pieces))
    lists = dealt.groupBy(*keys, "_piece").agg(F.sort_array(F.collect_list(F.struct("_at", "_token"))).alias("_l"))
    # of each token the next ones; those that belong to the next piece are only met, they start no pair here
    starts = F.filter(F.sequence(F.lit(1), F.size("_l")), lambda i: F.get("_l._at", i - 1) < (F.col("_piece") + 1) * piece)
    after = F.transform(starts, lambda i: F.struct(
        F.get("_l._token", i - 1).alias("a"), F.slice("_l._token", i + 1, window).alias("others")))
    pairs = lists.select(F.explode(after).alias("p")).select("p.a", F.explode("p.others").alias("b"))
    # equal tokens stand on both sides of their pair, so such a pair counts twice, as it does in the sum of both directions
    once = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    return once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")).groupBy("a", "b").agg(F.sum("n").alias("n"))


def positive_information(counts: DataFrame, shift: float = 0.0) -> DataFrame:
    """``a, b, m``: the positive part of ln(n(a, b) * n / (n(a) * n(b))) - ``shift``; pairs with none are left out."""
    margins = counts.groupBy("a").agg(F.sum("n").alias("_n"))
    total = margins.agg(F.sum("_n")).first()[0] or 0
    m = F.log(F.col("n") * F.lit(float(total)) / (F.col("_n") * F.col("_m"))) - F.lit(shift)
    found = counts.join(margins, "a").join(margins.select(F.col("a").alias("b"), F.col("_n").alias("_m")), "b")
    return found.select("a", "b", m.alias("m")).where("m > 0")


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _products(table: DataFrame, left: str, right: str, dim: int) -> np.ndarray:
    """The sum over all rows of the outer product of two array columns; a task hands on one matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            total += _matrix(batch.column(0), dim).T @ _matrix(batch.column(1), dim)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    parts = table.select(F.col(left).alias("_l"), F.col(right).alias("_r")).mapInArrow(run, "m binary").collect()  # one small row a task
    return sum((np.frombuffer(r["m"]).reshape(dim, dim) for r in parts), np.zeros((dim, dim)))


def _times(table: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``word, vector`` with each vector times a small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(1), matrix.shape[0]) @ matrix
            ends = pa.array(np.arange(len(own) + 1, dtype=np.int32) * matrix.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(own.ravel()))], names=["word", "vector"])

    return table.select("word", "vector").mapInArrow(run, "word string, vector array<double>")


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """What to multiply vectors of this Gram matrix with to make their columns orthonormal; directions without length go to 0."""
    values, vectors = np.linalg.eigh(gram)
    good = values > max(values.max(), 0.0) * 1e-12
    return (vectors * np.where(good, 1 / np.sqrt(np.where(good, values, 1.0)), 0.0)) @ vectors.T


def factor(matrix: DataFrame, dim: int = 8, turns: int = 12, seed: int = 42, extra: int = 8) -> DataFrame:
    """``word, vector``: the ``dim`` leading directions of a symmetric matrix ``a, b, m``, each times the root of its eigenvalue's
    size. The matrix is multiplied ``turns`` times to vectors that start from hashes of the words, made orthonormal in between;
    ``extra`` directions more are carried along, which lets the leading ones settle sooner, and left out at the end.

    Directions come in falling order of the eigenvalues' size; the sign is such that the entries sum to no less than 0. Fewer words than
    ``dim`` leave the rest 0.
    """
    matrix, width = reliable(matrix), dim + extra

    def start(i: int) -> Column:
        return F.xxhash64("word", F.lit(seed), F.lit(i)) / F.lit(float(1 << 63))

    now = matrix.select(F.col("a").alias("word")).distinct().select("word", F.array(*[start(i) for i in range(width)]).alias("vector"))
    moved = now
    for _ in range(turns + 1):
        turn = _orthonormal(_products(moved, "vector", "vector", width))
        now = _times(moved, turn)
        sums = [F.sum(F.col("m") * F.get("vector", F.lit(i))) for i in range(width)]
        moved = reliable(matrix.join(now.withColumnRenamed("word", "b"), "b").groupBy("a").agg(F.array(*sums).alias("vector"))
                         .withColumnRenamed("a", "word"))
    both = reliable(now.join(moved.withColumnRenamed("vector", "image"), "word"))
    small = _products(both, "vector", "image", width)
    values, directions = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")[:dim]
    values, directions = values[order], directions[:, order]
    ones = _products(both.withColumn("_one", F.array_repeat(F.lit(1.0), width)), "_one", "vector", width)[0]
    scale = np.sqrt(np.abs(values)) * np.where(ones @ directions < 0, -1.0, 1.0)
    return _times(both, directions * scale)


def token_vectors(
    events: DataFrame, column: str, dim: int = 8, window: int = 5, turns: int = 12, seed: int = 42, hot=CHECK,
) -> DataFrame:
    """``word, vector`` for each token of ``column`` that has a neighbour which it meets more often than by chance."""
    return factor(positive_information(reliable(pair_counts(events, column, window, hot=hot))), dim, turns, seed)
