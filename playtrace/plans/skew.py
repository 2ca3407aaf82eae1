"""Ordered per-key operators that stay distributed when one key holds much of the table.

A window over ``PARTITION BY key`` puts a whole key into one task. That is the right plan while keys are
small, and it shares one shuffle with the aggregations that follow. Keys above ``HOT_ROWS`` rows are split off
(``by_heat``) and range-partitioned on ``key, order`` instead: every task then owns a contiguous *chunk* of a key,
works on it alone, and gets what precedes it from a per-chunk summary of one row per chunk.
Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrace.sources.storage import shared_root

#: Rows of one key that a single task may still sort, collect into an array, or count by value.
HOT_ROWS = 200_000
#: Rows of a chunk: a task's share of the hot keys, which it only sorts and streams through.
CHUNK_ROWS = 5_000_000
#: Rows that a task is dealt where each of them becomes many, and the fewest that are worth a task of their own.
TASK_ROWS, LEAST_ROWS = 50_000, 5_000
#: Most rows, and most bytes of them, that are sent to every task as a broadcast side.
BROADCAST_KEYS = 1_000_000
BROADCAST_BYTES = 128 << 20

CHUNK = "_chunk"


class _Check:
    """Marks "measure whether any key is hot" as opposed to a known answer (``None`` or a table of hot keys)."""


CHECK = _Check()


def reliable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: stable rows, no lineage to redo."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def task_count(df: DataFrame, most: int = TASK_ROWS) -> int:
    """Tasks for the rows of ``df``: none gets many more than ``most``, however large the table is."""
    n = df.count()
    ordinary = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / LEAST_ROWS))
    return max(1, ordinary, math.ceil(n / most))


def dealt(df: DataFrame, keys: Sequence[str], most: int = TASK_ROWS) -> DataFrame:
    """``df`` by hash of its keys in ``task_count`` parts. The number is given, so Spark does not join parts that look small
    before their rows are multiplied. They are two at least: a single one would not count as dealt by its keys."""
    return df.repartition(max(2, task_count(df, most)), *keys)


def find_hot(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or ``None``. One pass over the key columns, combined map-side."""
    limit = HOT_ROWS if limit is None else limit
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys)
    if hot.isEmpty():
        return None
    return reliable(hot)


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_KEYS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint, given only after counting rows and bytes; a larger side keeps Spark's own choice of join."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    n, total = df.select(F.octet_length(text).alias("_b")).limit(rows + 1).agg(F.count(F.lit(1)), F.sum("_b")).first()
    return F.broadcast(df) if n <= rows and (total or 0) <= size else df


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def split_hot(df: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows of ordinary keys, rows of hot keys)``."""
    keys = hot.columns
    side = bounded_broadcast(hot.withColumnsRenamed({k: f"_k_{k}" for k in keys}))
    return df.join(side, _same(df, side, keys), "left_anti"), df.join(side, _same(df, side, keys), "left_semi")


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None | _Check,
    ordinary: Callable[[DataFrame], DataFrame],
    heavy: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply ``ordinary`` to the rows of small keys and ``heavy`` to those of hot ones.

    ``hot`` may hold a prefix of the keys: if a session is not hot, no phase of it is.
    """
    if isinstance(hot, _Check):
        hot = find_hot(df, keys)
    if hot is None:
        return ordinary(df)
    cold_rows, hot_rows = split_hot(df, hot)
    return ordinary(cold_rows).unionByName(heavy(hot_rows))


def in_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sorted ranges of ``keys, order`` numbered by partition. Kept in the checkpoint folder, so that a lost
    executor cannot move a row to another chunk between the two reads that follow."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / CHUNK_ROWS))
    ranged = df.repartitionByRange(parts, *keys, *order)
    return reliable(ranged.withColumn(CHUNK, F.spark_partition_id()))


def _join_chunks(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give every row its chunk's summary. There are few: at most one per hot key and task boundary. Sent to the
    rows, they leave the window's shuffle as the only one."""
    on = [*keys, CHUNK]
    side = bounded_broadcast(reliable(summary.withColumnsRenamed({k: f"_k_{k}" for k in on})))
    return df.join(side, _same(df, side, on), "left").drop(*[f"_k_{k}" for k in on])


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    name: str = "_prev",
    hot: DataFrame | None | _Check = CHECK,
) -> DataFrame:
    """Add ``name``: a struct of ``columns`` in the preceding row of the key, null on its first row."""
    row = F.struct(*columns)

    def ordinary(d: DataFrame) -> DataFrame:
        return d.withColumn(name, F.lag(row).over(Window.partitionBy(*keys).orderBy(*order)))

    def heavy(d: DataFrame) -> DataFrame:
        chunks = in_chunks(d, keys, order)
        last = chunks.groupBy(*keys, CHUNK).agg(F.max_by(row, F.struct(*order)).alias("_last"))
        before = last.select(
            *keys, CHUNK, F.lag("_last").over(Window.partitionBy(*keys).orderBy(CHUNK)).alias("_before"))
        inner = Window.partitionBy(*keys, CHUNK).orderBy(*order)
        return (_join_chunks(chunks, before, keys)
                .withColumn(name, F.coalesce(F.lag(row).over(inner), F.col("_before")))
                .drop("_before", CHUNK))

    return by_heat(df, keys, hot, ordinary, heavy)


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    total: str | None = None,
    hot: DataFrame | None | _Check = CHECK,
) -> DataFrame:
    """Add the running sum of ``value`` up to and including each row, and on request the key's ``total``.

    ``order`` must be unique within a key.
    """

    def ordinary(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumn(name, F.sum(value).over(w))
        return d.withColumn(total, F.sum(value).over(Window.partitionBy(*keys))) if total else d

    def heavy(d: DataFrame) -> DataFrame:
        chunks = in_chunks(d, keys, order)
        sums = chunks.groupBy(*keys, CHUNK).agg(F.sum(value).alias("_sum"))
        ahead = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select(
            *keys, CHUNK,
            F.sum("_sum").over(ahead).alias("_offset"),
            F.sum("_sum").over(Window.partitionBy(*keys)).alias(total or "_total"))
        inner = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        own = F.sum(value).over(inner)
        out = _join_chunks(chunks, offsets, keys)
        # A null running sum (only null values so far) stays null, as in a plain window.
        out = out.withColumn(name, F.when(own.isNull(), F.col("_offset")).otherwise(
            own + F.when(F.col("_offset").isNull(), F.lit(0)).otherwise(F.col("_offset"))))
        return out.drop("_offset", CHUNK, *([] if total else ["_total"]))

    return by_heat(df, keys, hot, ordinary, heavy)


def with_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    total: str | None = None,
    hot: DataFrame | None | _Check = CHECK,
) -> DataFrame:
    """Add the 1-based position within the key (a long), and on request the key's row count."""
    return with_running_sum(df, keys, order, F.lit(1), name, total, hot)


def value_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    hot: DataFrame | None | _Check = CHECK,
) -> DataFrame:
    """Exact order statistics: for each name, the value at the 0-based rank that its function gives for the
    number of non-null values. Equal values are counted before the shuffle; nothing is collected."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    if isinstance(hot, _Check):
        counts = reliable(counts)  # read again by the check
    run = with_running_sum(counts, keys, [value], F.col("_c"), "_cum", total="_n", hot=hot)
    n, cum, c = F.col("_n"), F.col("_cum"), F.col("_c")
    picked = [
        F.max(F.when((cum - c <= rank(n)) & (rank(n) < cum), F.col(value))).alias(name)
        for name, rank in ranks.items()
    ]
    return run.groupBy(*keys).agg(*picked)
