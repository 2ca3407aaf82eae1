"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous sweeps.

Lengths are whole numbers up to the capacity, so documents sorted by length are a few runs of equal length however many
there are, and so are the gaps. A sweep takes the longest run that is left, finds the successor of its length among the
gaps, matches the two runs rank by rank, and puts the gaps that this leaves back among the runs. What the sweeps exchange is the
size of each run (at most one number per length); the documents themselves are ranked within their run, and placed, where
they lie. The result is that of sequential best-fit decreasing.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import as_bytes, bounded_batches, stored
from playtrace.llm.tokens import encoder

CAPACITY = 2048


def cut(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """The pieces of all documents: ``doc_id, piece, start, length, ids_crc32`` and their place ``part, seat``.

    A document is its ids and then ``end``. One that is longer than ``capacity`` is cut so that only its first piece may be
    shorter. ``seat`` numbers the pieces of one length within a partition.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        own.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("seat", T.LongType())])
    closing = int(end).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        seats = [0] * (capacity + 1)
        for batch in batches:
            owner, rows = [], []
            for at, ids in enumerate(encode.ids(as_bytes(batch.column(1)))):
                ids += closing
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    rows.append((piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), part, seats[length]))
                    owner.append(at)
                    seats[length] += 1
                    start, piece = start + length, piece + 1
            if rows:
                columns = [pa.array(c, pa.int32() if i in (0, 4) else pa.int64()) for i, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *columns], names=schema.names)

    return own.mapInArrow(run, schema)


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: ``(length, first rank, sequence, offset, pieces per sequence)`` of each match.

    Runs of documents from long to short. The successor of a length is the smallest gap that holds it; a sequence that has
    taken a piece is the best fit for the next of the same length as long as it holds it. Without a successor new
    sequences are opened.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # size -> runs of sequences
    sizes: list[int] = []
    plan, opened = [], 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            per = gap // length
            full, rest = min(n, left // per), 0
            plan.append((length, rank, first, capacity - gap, per))
            leave(gap - per * length, first, full)
            if full < n and left > full * per:  # the last pieces fill one sequence in part
                rest = left - full * per
                leave(gap - rest * length, first + full, 1)
            used = full + (rest > 0)
            leave(gap, first + used, n - used)
            rank, left = rank + full * per + rest, left - full * per - rest
    return plan


_RANKS = 1 << 48  # ranks of one length stay below


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are the end id alone; rows that repeat an id are packed as often as they stand; no documents, no
    rows. Sequences have no gaps before or between their pieces.
    """
    pieces = stored(cut(docs, tokenizer, doc_id, text, capacity, end), "pack-pieces")
    runs = pieces.groupBy("length", "part").count()
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select("length", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # <= capacity rows
    plan = sweep(counts, capacity)
    plan.sort()
    length, rank, first, offset, per = (np.array(x, np.int64) for x in (zip(*plan) if plan else [()] * 5))
    starts = length * _RANKS + rank
    placed = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("seat") + F.col("base"))
    placed = placed.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    schema = T.StructType([*placed.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, r = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            k = np.searchsorted(starts, own * _RANKS + r, side="right") - 1
            nth = r - rank[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first[k] + nth // per[k]), pa.array(offset[k] + nth % per[k] * own)],
                names=schema.names)

    return placed.mapInArrow(place, schema)
