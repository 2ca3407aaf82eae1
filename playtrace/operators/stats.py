"""Per-session aggregations: flat statistics and the tall per-value statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrace.functions.columns import category, matches
from playtrace.operators.vocab import melt
from playtrace.plans.skew import CHECK, by_heat, value_at_ranks
from playtrace.schema import (
    CATEGORY_COLUMNS, KEYS, LANDMARKS, METRIC_COLUMNS, NUMERIC_COLUMNS, NUNIQUE_COLUMNS, QUANTILES, WORDS,
    Landmark, word_key,
)

TIME = "elapsed_time_diff"


def holds(word: str) -> str:
    """SQL text of the predicate "the event's text holds this word"."""
    literal = word.replace("\\", "\\\\").replace("'", "\\'")
    return f"contains(text, '{literal}')"


def word_count_exprs(words: Sequence[str] = WORDS) -> list[Column]:
    return [F.expr(f"count_if({holds(w)}) AS word_{word_key(w)}") for w in words]


def with_word_times(diffed: DataFrame, words: Sequence[str] = WORDS) -> DataFrame:
    """Add one column per word: the time difference of the rows whose text holds it. Each text is searched once per
    word here, and not again for every statistic."""
    return diffed.selectExpr("*", *[f"CASE WHEN {holds(w)} THEN {TIME} END AS {word_column(w)}" for w in words])


def word_column(word: str) -> str:
    return f"_time_{word_key(word)}"


def word_time_exprs(words: Sequence[str] = WORDS, empty_sum_zero: bool = False, count: bool = False) -> list[Column]:
    """Mergeable statistics of the columns of ``with_word_times``."""
    forms = {"word": "count({t})"} if count else {}
    forms |= {"word_mean": "avg({t})", "word_std": "stddev_samp({t})", "word_max": "max({t})",
              "word_sum": "coalesce(sum({t}), 0L)" if empty_sum_zero else "sum({t})"}
    return [F.expr(f"{form.format(t=word_column(w))} AS {name}_{word_key(w)}")
            for w in words for name, form in forms.items()]


def word_median_exprs(words: Sequence[str] = WORDS) -> list[Column]:
    return [F.expr(f"median({word_column(w)}) AS word_median_{word_key(w)}") for w in words]


def numeric_exprs(columns: Sequence[str] = NUMERIC_COLUMNS) -> list[Column]:
    return [
        F.expr(f"{fn}(`{c}`) AS `{c}_{name}`")
        for c in columns for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("sum", "sum"))]


def quantile_name(column: str, q: str) -> str:
    return f"{column}_qtile_{q.replace('.', '_')}"


def span_exprs(landmarks: Sequence[Landmark]) -> list[Column]:
    """max - min of time and index over the landmark's rows, 0.0 where there are none."""
    out = []
    for mark in landmarks:
        hit = matches(mark.any_of)
        for c in ("elapsed_time", "index"):
            x = F.when(hit, F.col(c))
            span = (F.max(x) - F.min(x)).cast("double")
            out.append(F.coalesce(span, F.lit(0.0)).alias(f"{mark.name}_span_{c}"))
    return out


def nunique_exprs(columns: Sequence[str] = NUNIQUE_COLUMNS) -> list[Column]:
    """Distinct values, the null token included."""
    return [F.count_distinct(category(c)).alias(f"{c}_nunique") for c in columns]


def nunique(events: DataFrame, columns: Sequence[str] = NUNIQUE_COLUMNS, keys: Sequence[str] = KEYS) -> DataFrame:
    """``nunique_exprs`` as two plain aggregations over the melted columns.

    The first removes repeats map-side, so it needs neither one copy of every row per distinct column nor any
    set of values in memory.
    """
    distinct = melt(events, keys, columns, category).distinct()
    return distinct.groupBy(*keys).agg(
        *[F.count_if(F.col("column") == c).alias(f"{c}_nunique") for c in columns])


def mergeable_exprs(landmarks: Sequence[Landmark], empty_sum_zero: bool = False) -> list[Column]:
    """Everything that combines map-side, over the rows of ``with_word_times``."""
    return [
        F.count("index").alias("nrows"), *word_time_exprs(empty_sum_zero=empty_sum_zero, count=True),
        F.sum("elapsed_time").alias("elapsed_time_sum"), *numeric_exprs(), *span_exprs(landmarks),
    ]


def quantiles_nearest(
    events: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, qs: Sequence[str] = QUANTILES,
    keys: Sequence[str] = KEYS, hot=CHECK,
) -> DataFrame:
    """Nearest-rank quantiles per key. One sorted array per column and ordinary key serves all quantiles;
    hot keys go through distributed ranks."""

    def ordinary(d: DataFrame) -> DataFrame:
        arrays = d.groupBy(*keys).agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in columns])
        return arrays.selectExpr(*keys, *[nearest_sql(c, q, quantile_name(c, q)) for c in columns for q in qs])

    def heavy(d: DataFrame) -> DataFrame:
        return d.select(*keys).distinct().join(_distributed_quantiles(d, columns, qs, keys), list(keys), "left")

    return by_heat(events, keys, hot, ordinary, heavy)


def _distributed_quantiles(
    d: DataFrame, columns: Sequence[str], qs: Sequence[str], keys: Sequence[str],
) -> DataFrame:
    """Quantiles of hot keys that have any values, ranked without collecting."""
    tall = melt(d, keys, columns, lambda c: F.col(c).cast("double"))
    picked = value_at_ranks(tall, [*keys, "column"], "value", {f"q{i}": _nearest_rank(q) for i, q in enumerate(qs)})
    return picked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("column") == c, F.col(f"q{i}"))).alias(quantile_name(c, q))
        for c in columns for i, q in enumerate(qs)])


def nearest_sql(array: str, q: str, name: str) -> str:
    """SQL text: element of rank round((n-1)*q), halves up, of a sorted array; null if it is empty."""
    return f"CAST(get(`{array}`, CAST(round((size(`{array}`) - 1) * {q}BD) AS INT)) AS DOUBLE) AS `{name}`"


def _nearest_rank(q: str):
    return lambda n: F.round((n - 1) * F.expr(f"{q}BD")).cast("long")


def _distributed_medians(timed: DataFrame, words: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Medians of hot keys that have any: one row per hit, ranked without collecting."""
    columns = [word_column(w) for w in words]
    tall = melt(timed, keys, columns, F.col).where(F.col("value").isNotNull())
    middle = value_at_ranks(tall, [*keys, "column"], "value", {
        "low": lambda n: F.floor((n - 1) / 2), "high": lambda n: F.ceil((n - 1) / 2)})
    return middle.groupBy(*keys).agg(*[
        F.max(F.when(F.col("column") == word_column(w), (F.col("low") + F.col("high")) / 2.0))
        .alias(f"word_median_{word_key(w)}") for w in words])


def word_times(diffed: DataFrame, words: Sequence[str] = WORDS, keys: Sequence[str] = KEYS, hot=CHECK) -> DataFrame:
    """mean, std, max, sum and exact median of the time difference over the rows that hold each word."""
    keys = list(keys)

    def ordinary(d: DataFrame) -> DataFrame:
        return d.groupBy(*keys).agg(*word_time_exprs(words), *word_median_exprs(words))

    def heavy(d: DataFrame) -> DataFrame:
        return d.groupBy(*keys).agg(*word_time_exprs(words)).join(
            _distributed_medians(d, words, keys), keys, "left")

    return by_heat(with_word_times(diffed, words), keys, hot, ordinary, heavy)


def flat_stats(
    diffed: DataFrame, landmarks: Sequence[Landmark] = LANDMARKS, keys: Sequence[str] = KEYS, hot=CHECK,
    empty_sum_zero: bool = False,
) -> DataFrame:
    """All statistics that do not depend on the vocabulary, one row per key (distinct counts: ``nunique``)."""
    keys = list(keys)

    def ordinary(d: DataFrame) -> DataFrame:
        arrays = [F.sort_array(F.collect_list(c)).alias(f"_sorted_{c}") for c in NUMERIC_COLUMNS]
        agg = d.groupBy(*keys).agg(*mergeable_exprs(landmarks, empty_sum_zero), *word_median_exprs(), *arrays)
        quantiles = [nearest_sql(f"_sorted_{c}", q, quantile_name(c, q)) for c in NUMERIC_COLUMNS for q in QUANTILES]
        return agg.selectExpr(*[c for c in agg.columns if not c.startswith("_sorted_")], *quantiles)

    def heavy(d: DataFrame) -> DataFrame:
        agg = d.groupBy(*keys).agg(*mergeable_exprs(landmarks, empty_sum_zero))
        return (agg.join(_distributed_medians(d, WORDS, keys), keys, "left")
                .join(_distributed_quantiles(d, NUMERIC_COLUMNS, QUANTILES, keys), keys, "left"))

    return by_heat(with_word_times(diffed), keys, hot, ordinary, heavy)


def tall_stats(
    diffed: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS, keys: Sequence[str] = KEYS,
    metrics: Sequence[str] = METRIC_COLUMNS,
) -> DataFrame:
    """Statistics of every category value: one row per key, column and value that occurs.

    All columns are melted first, so there is one aggregation whatever the size of the vocabulary.
    """
    tall = melt(diffed, [*keys, *metrics], columns, category)
    stats = [F.count(F.lit(1)).alias("n")]
    for m in metrics:
        stats += [
            F.sum(m).cast("double").alias(f"{m}_sum"), F.avg(m).alias(f"{m}_mean"),
            F.stddev_samp(m).alias(f"{m}_std"), F.max(m).cast("double").alias(f"{m}_max"),
            F.min(m).cast("double").alias(f"{m}_min"),
        ]
    return tall.groupBy(*keys, "column", "value").agg(*stats)


def elapsed_basic(events: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.sum("elapsed_time").alias("elapsed_sum"), F.avg("elapsed_time").alias("elapsed_mean"),
        F.max("elapsed_time").alias("elapsed_max"), F.min("elapsed_time").alias("elapsed_min"))
