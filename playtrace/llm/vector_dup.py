"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points, the more the more points there are (``prefix``). Two vectors are candidates if
they share at least ``SHARED`` of them: the inverted lists are kept per pair of reference points, so that a list holds the vectors that share both, and a pair
of vectors counts in the list of the two smallest points it shares only. Candidates are verified in double precision.

Vectors within ``CORE`` of the same nearest reference point lie within twice that angle of each other, so they are linked
without a comparison: the size of a tight group costs nothing. The others meet in tiles of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrace.llm.common import bounded_batches, stored
from playtrace.llm.components import components
from playtrace.llm.tiles import local_links, meets, runs, tiles

SIMILAR = 0.9
SHARED = 2
#: Cosine whose angle, doubled, still gives ``SIMILAR``, with a margin above the rounding of doubles.
CORE = 0.9748
#: Reference points: twice the root of the number of vectors, within these bounds, out of four times as many sampled vectors.
LEAST_PIVOTS, MOST_PIVOTS = 32, 1024
TILE = 512


def prefix(points: int) -> int:
    """How many nearest points describe a vector: 6 up to 128 points, and one more for each doubling.

    Random pairs at cosine 0.90 share two of them with probability 0.985 or more, whatever the number of points (measured with
    64 and 256 dimensions; with 6 for all it falls to 0.92 at 1,024 points).
    """
    return 6 + max(0, math.ceil(math.log2(max(points, 1) / 128)))


def _unit(values: bytes) -> np.ndarray | None:
    x = np.frombuffer(values, np.float64)
    return x / np.linalg.norm(x)


def prepared(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, digest, values`` per row: the components as doubles, null if the vector cannot be compared.

    That is a vector that is null, empty or zero, or holds a null, an infinity or a NaN.
    """
    bounded_batches(vectors.sparkSession)
    own = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("values"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, values = [], []
            for x in batch.column(1).to_pylist():
                ok = bool(x) and None not in x
                x = np.array(x, np.float64) if ok else np.zeros(1)
                largest = np.abs(x).max()
                ok = ok and bool(np.isfinite(x).all()) and largest > 0
                x = x / largest if ok else x  # keeps squares from overflowing, copies stay copies
                values.append(x.tobytes() if ok else None)
                digests.append(hashlib.blake2b(values[-1], digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(values, pa.binary())], names=["vec_id", "digest", "values"])

    return own.mapInArrow(run, f"vec_id {own.schema['vec_id'].dataType.simpleString()}, digest binary, values binary")


def pivots(distinct: DataFrame, n: int) -> np.ndarray:
    """Reference points: sampled vectors by hash order, without those close to an earlier one, each moved to the mean of the
    sampled vectors close to it. The sample is bounded by ``4 * MOST_PIVOTS``."""
    most = min(max(math.ceil(2 * math.sqrt(n)), LEAST_PIVOTS), MOST_PIVOTS)
    rows = distinct.select("values", F.xxhash64("digest").alias("h")).orderBy("h").limit(4 * most).collect()
    sample = [_unit(bytes(r["values"])) for r in rows]
    if not sample:
        return np.empty((0, 1))
    size = max((len(x) for x in sample), key=[len(x) for x in sample].count)
    x = np.array([s for s in sample if len(s) == size])
    near = x @ x.T >= SIMILAR
    leaders: list[int] = []
    for i in range(len(x)):
        if not near[i, leaders].any():
            leaders.append(i)
    points = np.array([x[near[i]].sum(axis=0) for i in leaders[:most]])
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def listed(distinct: DataFrame, points) -> DataFrame:
    """``key, digest, class, points`` for each list that a vector stands in; ``points`` is a broadcast of ``pivots``.

    ``class`` is the nearest reference point if it lies within ``CORE``, else a number of the vector's own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = points.value
        k = min(prefix(len(p)), len(p))
        subsets = list(combinations(range(k), min(SHARED, k)))
        for batch in batches:
            x = np.zeros((batch.num_rows, p.shape[1]))
            fits = np.zeros(batch.num_rows, bool)
            for i, values in enumerate(batch.column(1).to_pylist()):
                own = _unit(values)[:p.shape[1]]  # another length is routed by what there is of it
                x[i, :len(own)] = own
                fits[i] = len(values) == 8 * p.shape[1]
            cosine = x @ p.T
            order = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
            first = order[:, 0]
            core = fits & (cosine[np.arange(len(x)), first] >= CORE)
            nearest = np.sort(order, axis=1)
            own_class = np.array([int.from_bytes(d[:8], "little", signed=True) for d in batch.column(0).to_pylist()], np.int64)
            own_class = np.where(core, first, own_class | np.int64(1 << 40))
            for s in subsets:
                a = nearest[:, s[0]] if len(s) > 1 else np.full(len(x), -1)
                yield pa.RecordBatch.from_arrays([
                    pa.array((a * 65536 + nearest[:, s[-1]]).astype(np.int64)), batch.column(0), pa.array(own_class),
                    pa.array(nearest.tolist(), pa.list_(pa.int32()))], names=["key", "digest", "class", "points"])

    return distinct.select("digest", "values").mapInArrow(run, "key long, digest binary, class long, points array<int>")


def verified(groups: DataFrame) -> DataFrame:
    """``digest, root, n``: per tile and vector the first vector it is connected with, and its links there (copies counted)."""
    dealt = groups.select("key", "i", "j", "part", "class", "digest", "copies", "points", "values")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "digest")

    def compare(rows: list[tuple]) -> list[tuple[bytes, bytes, int]]:
        key, i, j = rows[0][:3]
        part, kind = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
        size = np.array([len(r[8]) for r in rows])
        linked = meets(i, j, part) & (kind[:, None] != kind[None, :])
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            x = np.array([_unit(rows[a][8]) for a in at])
            linked[np.ix_(at, at)] &= x @ x.T >= SIMILAR
        linked &= size[:, None] == size[None, :]
        if not linked.any():
            return []
        # a pair counts where the key is the two smallest reference points that it shares
        smaller = [[p for p in r[7] if p < key % 65536 and p != key // 65536] for r in rows]
        names = {p: c for c, p in enumerate({p for s in smaller for p in s})}
        has = np.zeros((len(rows), len(names)), np.float32)
        for a, s in enumerate(smaller):
            has[a, [names[p] for p in s]] = 1
        linked &= has @ has.T == 0
        copies = np.array([r[6] for r in rows])
        n, root = linked @ copies, local_links(linked)
        return [(rows[a][5], rows[root[a]][5], int(n[a])) for a in np.flatnonzero(n).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 3):
            found = compare(rows)
            if found:
                a, b, n = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["digest", "root", "n"])

    return dealt.mapInArrow(run, "digest binary, root binary, n long")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Vectors that cannot be compared, and vectors of different lengths, link with nothing. Copies (also scaled ones that round to
    the same numbers) are compared once and linked with each other. The id of a component is its smallest ``vec_id``; a row
    with a null id has links like any other, and the id of its component if another row there has one.
    """
    spark = vectors.sparkSession
    rows = stored(prepared(vectors, vec_id, embedding), "vec-rows")
    distinct = stored(rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("values").alias("values")), "vec-distinct")
    points = spark.sparkContext.broadcast(pivots(distinct, distinct.count()))
    lists = stored(listed(distinct, points), "vec-lists")
    dealt = tiles(lists.select("key", F.col("digest").alias("item"), "class"), TILE).withColumnRenamed("item", "digest")
    dealt = dealt.join(lists.select("key", "digest", "points"), ["key", "digest"])
    found = stored(verified(dealt.join(distinct.select("digest", "copies", "values"), "digest")), "vec-links")
    # a core links all of its vectors with each other
    cores = lists.where(F.col("class") < len(points.value)).where("class >= 0").select("digest", "class").distinct()
    cores = cores.join(distinct.select("digest", "copies"), "digest")
    sums = cores.groupBy("class").agg(F.sum("copies").alias("all"), F.min("digest").alias("root"))
    inside = cores.join(F.broadcast(sums), "class").select("digest", "root", (F.col("all") - F.col("copies")).alias("n"))
    links = stored(found.unionByName(inside), "vec-links")
    joined = components(links.select(F.col("digest").alias("a"), F.col("root").alias("b")), "vec-components")
    own = distinct.select("digest", "copies", "least").join(links.groupBy("digest").agg(F.sum("n").alias("n")), "digest", "left")
    own = own.join(joined.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    own = own.join(least, "root").select(
        "digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    whole = rows.select("vec_id", "digest").join(own, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return whole.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
