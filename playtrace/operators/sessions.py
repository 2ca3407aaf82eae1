"""Operators on the ordered events of a session: differences, running sums, cleansing, tails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrace.functions.columns import bounded
from playtrace.plans.skew import CHECK, with_previous, with_row_number, with_running_sum
from playtrace.schema import EVENT_ORDER, KEYS, SESSION

#: Longest time between two events that counts, in ms.
MAX_TIME_DIFF = 1_000_000_000


def time_since(previous: Column) -> Column:
    """Elapsed time since the previous row: 0 on the first row and where time runs backwards."""
    diff = F.coalesce(F.col("elapsed_time") - previous, F.lit(0).cast("long"))
    return bounded(diff, 0, MAX_TIME_DIFF).cast("long")


def with_differences(events: DataFrame, hot=CHECK, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add ``elapsed_time_diff``, ``location_x_diff`` and ``location_y_diff`` in one ordered pass.

    Differences restart in every phase; a coordinate difference is null if either side is.
    """
    columns = ["elapsed_time", "screen_coor_x", "screen_coor_y"]
    out = with_previous(events, keys, EVENT_ORDER, columns, "_prev", hot)
    return out.withColumns({
        "elapsed_time_diff": time_since(F.col("_prev.elapsed_time")),
        "location_x_diff": F.abs(F.col("screen_coor_x") - F.col("_prev.screen_coor_x")),
        "location_y_diff": F.abs(F.col("screen_coor_y") - F.col("_prev.screen_coor_y")),
    }).drop("_prev")


def with_level_change(events: DataFrame, hot=CHECK, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Add ``level_diff`` to the previous event of the session (0 on the first)."""
    out = with_previous(events, [SESSION], order, ["level"], "_prev", hot)
    return out.withColumn("level_diff", F.coalesce(F.col("level") - F.col("_prev.level"), F.lit(0))).drop("_prev")


def reversal_flag(events: DataFrame, hot=CHECK, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Add ``is_reversed``: "reversed" where the level falls, "not_reversed" elsewhere."""
    out = with_level_change(events, hot, order)
    return out.withColumn(
        "is_reversed", F.when(F.col("level_diff") < 0, "reversed").otherwise("not_reversed")).drop("level_diff")


def with_reversals(events: DataFrame, hot=CHECK, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Add ``reversal_sum``: the running sum of level decreases, 0 until the level first falls."""
    changed = with_level_change(events, hot, order)
    fall = F.least(F.col("level_diff"), F.lit(0))
    return with_running_sum(changed, [SESSION], order, fall, "reversal_sum", hot=hot).drop("level_diff")


def first_play_only(events: DataFrame, hot=CHECK, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Rows before the first level decrease of their session."""
    return with_reversals(events, hot, order).where(F.col("reversal_sum") == 0).drop("reversal_sum")


def non_monotonic_sessions(
    events: DataFrame, column: str = "index", arrival: Sequence[str] = ("event_id",), hot=CHECK,
) -> DataFrame:
    """Sessions in which ``column`` falls somewhere, reading rows in order of arrival."""
    out = with_previous(events, [SESSION], list(arrival), [column], "_prev", hot)
    falls = F.coalesce(F.col(column) < F.col(f"_prev.{column}"), F.lit(False))
    return out.groupBy(SESSION).agg(F.bool_or(falls).alias("_falls")).where("_falls").select(SESSION)


def duplicate_keys(events: DataFrame, keys: Sequence[str] = (SESSION, "index")) -> DataFrame:
    """All rows whose ``keys`` occur more than once.

    Keys are counted map-side first, so a key held by much of the table costs one row per task; only the repeated
    keys are joined back.
    """
    keys = list(keys)
    repeated = find_repeated(events, keys)
    return events.join(repeated, keys, "left_semi")


def find_repeated(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def drop_sessions_with_duplicates(events: DataFrame, keys: Sequence[str] = (SESSION, "index")) -> DataFrame:
    """Rows of the sessions in which no key is repeated."""
    bad = find_repeated(events, keys).select(SESSION).distinct()
    return events.join(bad, SESSION, "left_anti")


def tail_n(events: DataFrame, n: int, keys: Sequence[str] = (SESSION,), rank: str = "tail_rank") -> DataFrame:
    """Last ``n`` events of each key, numbered 1 (latest) to ``n``.

    Spark limits each group before the shuffle for ``row_number() <= n``, so no task receives more than ``n``
    rows per key from any other.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in EVENT_ORDER])
    return events.withColumn(rank, F.row_number().over(latest)).where(F.col(rank) <= n)


def with_recency_weight(events: DataFrame, n: int, keys: Sequence[str] = (SESSION,)) -> DataFrame:
    """Last ``n`` events of each key with linear weights i/N, where N is how many there are and the latest has 1."""
    tail = tail_n(events, n, keys)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return tail.withColumn("weight", (size - F.col("tail_rank") + 1) / size)


def sort_events(events: DataFrame, by: Sequence[str] = (SESSION, *EVENT_ORDER)) -> DataFrame:
    """Global sort (range-partitioned, so distributed)."""
    return events.orderBy(*by)


def first_rows(df: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by a key; Spark keeps only ``n`` per task."""
    return df.orderBy(*by).limit(n)


def first_seen_order(events: DataFrame, keys: Sequence[str] = (SESSION,), row_id: str = "event_id") -> DataFrame:
    """Groups by first appearance, with the id of that row."""
    return events.groupBy(*keys).agg(F.min(row_id).alias("first_seen")).orderBy("first_seen")


def session_sequences(events: DataFrame, columns: Sequence[str], keys: Sequence[str] = (SESSION,)) -> DataFrame:
    """Ordered lists of ``columns`` per key: one row per key, however long.

    A list is one value in one task. Where a session may be too long for that, use ``last_values`` or ``session_segments``.
    """
    keys = list(keys)
    rows = F.sort_array(F.collect_list(F.struct(*EVENT_ORDER, F.struct(*columns).alias("_v"))))
    out = events.groupBy(*keys).agg(rows.alias("_rows"))
    return out.select(*keys, *[F.col(f"_rows._v.{c}").alias(c) for c in columns])


def last_values(events: DataFrame, columns: Sequence[str], n: int, keys: Sequence[str] = (SESSION,)) -> DataFrame:
    """Ordered lists of the last ``n`` events of each key; only these are collected."""
    return session_sequences(tail_n(events, n, keys), columns, keys)


def session_segments(
    events: DataFrame, columns: Sequence[str], max_len: int, keys: Sequence[str] = (SESSION,), hot=CHECK,
) -> DataFrame:
    """Ordered lists in segments of ``max_len`` events: ``segment`` 0, 1, ... is part of the key of the result, and no list
    grows with the table."""
    keys = list(keys)
    numbered = with_row_number(events, keys, EVENT_ORDER, "_rn", hot=hot)
    cut = numbered.withColumn("segment", F.floor((F.col("_rn") - 1) / max_len).cast("int"))
    rows = F.sort_array(F.collect_list(F.struct("_rn", *columns)))
    out = cut.groupBy(*keys, "segment").agg(rows.alias("_rows"))
    return out.select(*keys, "segment", *[F.col(f"_rows.{c}").alias(c) for c in columns])
