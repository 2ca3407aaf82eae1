"""Data-quality and profile queries over event and label tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrace.operators.vocab import melt
from playtrace.plans.skew import value_at_ranks
from playtrace.schema import EVENT_ORDER, SESSION


def null_ratio(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """Null fraction of each column and whether it exceeds the threshold."""
    one_row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    tall = melt(one_row, [], columns, F.col)
    return tall.select("column", F.col("value").alias("null_ratio"), (F.col("value") > threshold).alias("mostly_null"))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with one distinct value, null being a value: compared by minimum and maximum in one pass."""
    one_row = df.agg(*[
        F.struct(F.min(F.col(c).cast("string")).alias("lo"), F.max(F.col(c).cast("string")).alias("hi"),
                 F.count(c).alias("present"), F.count(F.lit(1)).alias("n")).alias(c) for c in columns])
    tall = melt(one_row, [], columns, F.col)
    v = F.col("value")
    constant = (v["present"] == 0) | ((v["present"] == v["n"]) & (v["lo"] == v["hi"]))
    return tall.where(constant).select("column")


def nunique_sessions(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct sessions and rows per group."""
    per_session = events.groupBy(*by, SESSION).agg(F.count(F.lit(1)).alias("_n"))
    return per_session.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("_n").alias("n_rows"))


def value_counts(df: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """Count and relative frequency of each value (nulls left out), overall or within groups."""
    within = list(within)
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(*within, column).agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy(*within).agg(F.sum("n").alias("total"))
    if within:
        return counts.join(totals, within).withColumn("freq", F.col("n") / F.col("total")).drop("total")
    return counts.withColumn("freq", F.col("n") / totals.scalar())


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles (interpolated, exact) and max of each column."""
    tall = melt(df, [], columns, lambda c: F.col(c).cast("double")).where(F.col("value").isNotNull())
    basic = tall.groupBy("column").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quarters = {"q25": "0.25", "q50": "0.5", "q75": "0.75"}
    ranks = {}
    for name, q in quarters.items():
        ranks[f"{name}_lo"] = lambda n, q=q: F.floor((n - 1) * F.expr(f"{q}BD"))
        ranks[f"{name}_hi"] = lambda n, q=q: F.ceil((n - 1) * F.expr(f"{q}BD"))
    picked = value_at_ranks(tall, ["column"], "value", ranks)
    out = basic.join(picked, "column")
    for name, q in quarters.items():
        place = (F.col("n") - 1) * F.expr(f"{q}BD")
        weight = (place - F.floor(place)).cast("double")
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out = out.withColumn(name, lo + (hi - lo) * weight)
    return out.select("column", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, number of distinct values, most frequent value (smallest on ties) and its frequency."""
    tall = melt(df, [], columns).where(F.col("value").isNotNull())
    counts = tall.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    smallest_of_most = F.min(F.struct((-F.col("n")).alias("neg"), "value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), smallest_of_most.alias("_top"),
    ).select("column", "count", "unique", F.col("_top.value").alias("top"), (-F.col("_top.neg")).alias("freq"))


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return melt(df.agg(*[F.avg(c).alias(c) for c in columns]), [], columns, F.col).withColumnRenamed("value", "mean")


def session_extent(events: DataFrame) -> DataFrame:
    return events.groupBy(SESSION).agg(
        F.max("index").alias("max_index"), F.min("level").alias("min_level"), F.max("level").alias("max_level"))


def extent_distribution(events: DataFrame, column: str) -> DataFrame:
    """How many sessions have each value of an extent column."""
    return session_extent(events).groupBy(column).agg(F.count(F.lit(1)).alias("n_sessions"))


def extent_distributions(events: DataFrame) -> DataFrame:
    """``measure, value, n_sessions`` of all extent columns, from one pass over the events."""
    extent = session_extent(events)
    measures = [c for c in extent.columns if c != SESSION]
    tall = extent.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in measures])))
    return tall.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n_sessions"))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Counts in equal bins between minimum and maximum; the last bin includes the maximum. Empty bins are listed."""
    x = F.col(column).cast("double")
    rows = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    limits = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    placed = rows.withColumn("_lim", limits)
    lo, hi = F.col("_lim.lo"), F.col("_lim.hi")
    step = (hi - lo) / bins
    number = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - lo) / step), F.lit(bins - 1)).cast("int"))
    counts = placed.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.any_value("_lim").alias("_lim"))
    filled = F.map_from_entries(F.collect_list(F.struct("bin", "n")))  # at most ``bins`` entries
    packed = counts.agg(filled.alias("_counts"), F.any_value("_lim").alias("_lim"))
    slots = packed.select("_counts", "_lim", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_lim.hi") - F.col("_lim.lo")) / bins
    return slots.select(
        "bin", (F.col("_lim.lo") + F.col("bin") * width).alias("bin_from"),
        F.coalesce(F.element_at("_counts", F.col("bin")), F.lit(0).cast("long")).alias("n"))


def level_profile(events: DataFrame) -> DataFrame:
    """mean, std, min, max, first and last elapsed time per session and level, in event order."""
    order = F.struct(*EVENT_ORDER)
    return events.groupBy(SESSION, "level").agg(
        F.avg("elapsed_time").alias("mean"), F.stddev_samp("elapsed_time").alias("std"),
        F.min("elapsed_time").alias("min"), F.max("elapsed_time").alias("max"),
        F.min_by("elapsed_time", order).alias("first"), F.max_by("elapsed_time", order).alias("last"))


def pivot_first(events: DataFrame, levels: Sequence[int], keys: Sequence[str] = (SESSION, "index")) -> DataFrame:
    """First elapsed time by index (rows) and level (columns ``level_<n>``)."""
    first = events.groupBy(*keys, "level").agg(F.min_by("elapsed_time", F.struct(*EVENT_ORDER)).alias("_first"))
    out = first.groupBy(*keys).pivot("level", list(levels)).agg(F.first("_first"))
    return out.withColumnsRenamed({str(v): f"level_{v}" for v in levels})


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count, column name, type and non-null count for each column of each table."""
    parts = []
    for name, df in tables.items():
        types = dict(df.dtypes)
        one_row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).alias("non_null"))
            for c in df.columns])
        parts.append(one_row.select(F.lit(name).alias("table"), F.col("_rows").alias("n_rows"), F.inline(pairs)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def distinct_values(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values, sorted, one per row, overall or per group."""
    return df.select(*by, column).where(F.col(column).isNotNull()).distinct().orderBy(*by, column)


def top_bottom_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` most and ``n`` least frequent values of each column; ties by value. Both limits apply before
    the shuffle."""
    tall = melt(df, [], columns).where(F.col("value").isNotNull())
    counts = tall.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    sides = []
    for side, order in (("top", [F.desc("n"), F.asc("value")]), ("bottom", [F.asc("n"), F.asc("value")])):
        rank = F.row_number().over(Window.partitionBy("column").orderBy(*order))
        sides.append(counts.withColumn("rank", rank).where(F.col("rank") <= n).withColumn("side", F.lit(side)))
    return sides[0].unionByName(sides[1])


def session_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct sessions on each side and on both."""
    marks = (left.select(SESSION, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
             .unionByName(right.select(SESSION, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    per = marks.groupBy(SESSION).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return per.agg(
        F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"),
        F.sum(F.col("_l") * F.col("_r")).alias("n_both"))
