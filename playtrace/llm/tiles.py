"""Comparing the members of a bucket in tiles of bounded size, a large class of settled members never with itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiles(members: DataFrame, size: int, weight: str | None = None, most: int = 0) -> DataFrame:
    """``key, item, class, side, part, i, j`` for members ``key, item, class`` whose bucket holds more than one class.

    Per bucket the largest class is side 1, all others side 0, both cut into parts of about ``size`` members (parts of side 1 have
    negative numbers), and, if a column ``weight`` is named, of about ``most`` of it. Tile (i, j) is to compare part i with part j, (i, i) part i with itself: each pair of members of which
    one is on side 0 meets in exactly one tile.
    """
    load = F.sum(F.col(weight) if weight else F.lit(0)).cast("long")
    by_class = members.groupBy("key", "class").agg(F.count("*").alias("count"), load.alias("load"))
    buckets = by_class.groupBy("key").agg(
        F.max(F.struct("count", "class", "load")).alias("most"), F.sum("count").alias("n"), F.sum("load").alias("load"),
    ).where("n > most.count")

    def parts(n, load):
        return F.greatest(F.ceil(n / F.lit(size)), F.ceil(load / F.lit(most or 1)) if weight else F.lit(1)).cast("int")

    buckets = buckets.select(
        "key", F.col("most.class").alias("large"), parts(F.col("n") - F.col("most.count"), F.col("load") - F.col("most.load")).alias("rest"),
        parts(F.col("most.count"), F.col("most.load")).alias("wide"))
    own = members.join(buckets, "key").withColumn("side", (F.col("class") == F.col("large")).cast("int"))
    nth = F.pmod(F.xxhash64("item"), F.when(F.col("side") == 1, F.col("wide")).otherwise(F.col("rest"))).cast("int")
    own = own.withColumn("part", F.when(F.col("side") == 1, -1 - nth).otherwise(nth))
    each = F.sequence(F.lit(0), F.col("rest") - 1)
    rest = F.transform(each, lambda k: F.struct(F.least(k, "part").alias("i"), F.greatest(k, "part").alias("j")))
    wide = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda k: F.struct(F.col("part").alias("i"), (-1 - k).alias("j")))
    mine = F.transform(each, lambda k: F.struct(k.alias("i"), F.col("part").alias("j")))
    dealt = F.explode(F.when(F.col("side") == 1, mine).otherwise(F.concat(rest, wide))).alias("t")
    return own.select("key", "item", "class", "side", "part", dealt).select(
        "key", "item", "class", "side", "part", "t.i", "t.j")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of sorted batches in runs that agree in the first ``keys`` columns."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and rows[0][:keys] != row[:keys]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def meets(i: int, j: int, part: np.ndarray) -> np.ndarray:
    """Which pairs of rows tile (i, j) is to compare."""
    a, b = part[:, None] == i, part[None, :] == j
    return a & b | (a & b).T


def local_links(linked: np.ndarray) -> np.ndarray:
    """For each row the first row of its component in the matrix of links."""
    n = len(linked)
    label = np.arange(n)
    while True:
        now = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1))
        now = now[now]
        if (now == label).all():
            return label
        label = now
