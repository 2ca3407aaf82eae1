"""Features of a vocabulary of any size: a sparse vector per session and phase, built from the tall statistics.

A *block* is what all features come from: one row per session and group of features, ``column, value, stats``. Each category value that
a session meets is a group of 11 statistics; the features that depend on no vocabulary are one more group. Profiles, the catalogue
and the numbering of features work on this table, so nothing is as wide as the vocabulary, neither a plan nor a row.

In a vector a missing value is 0: counts are stored as they are, any other value minus what stands for a missing one. All models see a
feature moved by a constant, which changes no split and no fitted probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.functions.columns import nan_to
from playtrace.operators.features import STATS
from playtrace.operators.sessions import with_differences
from playtrace.operators.stats import flat_stats, nunique, tall_stats
from playtrace.plans.skew import CHECK, bounded_broadcast, dealt, find_hot, reliable, with_row_number
from playtrace.schema import (
    ALL_NULL_COLUMNS, CATEGORY_COLUMNS, KEYS, LANDMARKS, METRIC_COLUMNS, NUNIQUE_COLUMNS, PHASE, PHASES, SESSION, Landmark,
)

#: Statistics of a category value by their place in ``stats``; the first is its count.
VALUE_STATS = ("count", *[f"{m}_{s}" for m in METRIC_COLUMNS for s in STATS])
#: ``column`` of the features without a category value; ``value`` is empty.
FLAT = ""
#: What stands for a missing value in models.
MISSING = -1.0

BLOCK_SCHEMA = T.StructType([
    T.StructField(SESSION, T.LongType()), T.StructField(PHASE, T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("stats", T.ArrayType(T.DoubleType()))])


def flat_names(events: DataFrame, phase: str, landmarks: Sequence[Landmark] = LANDMARKS) -> list[str]:
    """Names of the features without a category value, by their place in ``stats``."""
    flat = flat_stats(with_differences(events, None), [m for m in landmarks if m.phase == phase], hot=None)
    return [c for c in flat.columns if c not in KEYS] + [f"{c}_nunique" for c in NUNIQUE_COLUMNS]


def block(events: DataFrame, phase: str, hot=CHECK, landmarks: Sequence[Landmark] = LANDMARKS) -> DataFrame:
    """All features of one phase as ``session_id, level_group, column, value, stats``: a row for each category value that a session
    meets, and one for its other features. No vocabulary is asked for."""
    rows = events.where(F.col(PHASE) == phase).drop(*[c for c in ALL_NULL_COLUMNS if c in events.columns])
    if hot is CHECK:
        hot = find_hot(rows, KEYS)
    if hot is None:
        rows = dealt(rows, [SESSION])
    diffed = with_differences(rows, hot)
    flat = flat_stats(diffed, [m for m in landmarks if m.phase == phase], hot=hot)
    distinct = nunique(rows)  # of its own, without statistics: those of the values are computed once
    values = tall_stats(diffed).select(
        *KEYS, "column", "value",
        F.array(F.col("n").cast("double"), *[nan_to(F.col(c)) for c in VALUE_STATS[1:]]).alias("stats"))
    whole = flat.join(distinct.drop(PHASE), SESSION)
    names = [c for c in whole.columns if c not in KEYS]
    numbers = ", ".join(f"nanvl(CAST(`{c}` AS DOUBLE), -1D)" for c in names)
    return whole.select(
        *KEYS, F.lit(FLAT).alias("column"), F.lit("").alias("value"), F.expr(f"array({numbers})").alias("stats")).unionByName(values)




def profile(rows: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """``column, value, stat, n, n_null, lowest, highest`` of each feature over the sessions of a block, in one pass over it.

    The number of sessions is that of the first statistic without a category value, the number of rows, which no session lacks.

    A session that does not meet a value has count 0 and no other statistics. With ``folds`` (``session_id, fold``) there is a row
    for each ``fold`` too, over the sessions outside of it: numbers are totals minus the fold's, extremes those of the others.
    """
    by = []
    if folds is not None:
        by = ["fold"]
        rows = rows.join(folds.select(SESSION, "fold"), SESSION)
    entries = rows.select(*by, "column", "value", F.posexplode("stats").alias("stat", "x"))
    found = reliable(entries.groupBy("column", "value", "stat", *by).agg(  # one row per feature; the block is not computed again
        F.count("x").alias("present"), F.min("x").alias("lowest"), F.max("x").alias("highest")))
    sessions = found.where((F.col("column") == FLAT) & (F.col("stat") == 0)).select(*by, "present").collect()  # one row per fold
    is_count = (F.col("column") != FLAT) & (F.col("stat") == 0)
    if folds is None:
        found = found.withColumn("n", F.lit(sum(r["present"] for r in sessions)).cast("long"))
    else:
        sizes = {r["fold"]: r["present"] for r in sessions}
        total = sum(sizes.values())
        parts = F.collect_list(F.struct("fold", "present", "lowest", "highest")).alias("_folds")
        others = [
            F.struct(
                F.lit(k).alias("fold"), F.lit(total - own).cast("long").alias("n"),
                F.aggregate(_outside(k), F.lit(0).cast("long"), lambda s, p: s + p["present"]).alias("present"),
                F.array_min(F.transform(_outside(k), lambda p: p["lowest"])).alias("lowest"),
                F.array_max(F.transform(_outside(k), lambda p: p["highest"])).alias("highest"))
            for k, own in sorted(sizes.items())]
        found = found.groupBy("column", "value", "stat").agg(parts).select("column", "value", "stat", F.inline(F.array(*others)))
    zero = F.when(is_count & (F.col("present") < F.col("n")), F.lit(0.0))
    return found.select(
        "column", "value", "stat", *by, "n", F.when(is_count, F.lit(0).cast("long")).otherwise(F.col("n") - F.col("present")).alias("n_null"),
        F.least("lowest", zero).alias("lowest"), F.greatest("highest", zero).alias("highest"))


def _outside(fold: int) -> Column:
    return F.filter("_folds", lambda p: p["fold"] != fold)


def pruned(profiled: DataFrame, null_ratio: float = 0.9) -> DataFrame:
    """``profiled`` with ``kept`` and ``reason``: constant features and those missing in more than ``null_ratio`` of the rows go."""
    n, missing = F.col("n"), F.col("n_null")
    constant = (missing == n) | ((missing == 0) & (F.col("lowest") == F.col("highest")))
    reason = F.when(constant, "constant").when(missing / n > null_ratio, "null_ratio")
    return profiled.withColumns({"kept": reason.isNull(), "reason": reason})


def numbered(catalog: DataFrame) -> DataFrame:
    """``catalog`` with ``place``, the number of each kept feature from 0 by column, value and statistic; null for the others."""
    kept = with_row_number(
        catalog.where("kept").withColumn("_all", F.lit(0)), ["_all"], ["column", "value", "stat"], "_rn", hot=CHECK)
    kept = kept.select(*catalog.columns, (F.col("_rn") - 1).cast("int").alias("place"))
    return kept.unionByName(catalog.where("NOT kept").withColumn("place", F.lit(None).cast("int")))


def pack(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """``session_id, level_group, at, x`` per session of a block: places of its features in order, and their values as stored.

    Features that the catalogue does not have, of values met first after it was made, are left out.
    """
    places = catalog.where("kept").groupBy("column", "value").agg(
        F.collect_list(F.struct("stat", "place")).alias("_places"))
    found = rows.join(bounded_broadcast(places), ["column", "value"], "left")
    counted = F.col("column") != FLAT

    def entry(p: Column) -> Column:
        x = F.get(F.col("stats"), p["stat"])
        return F.struct(p["place"].alias("at"), F.when(counted & (p["stat"] == 0), x).otherwise(x - F.lit(MISSING)).alias("x"))

    own = F.filter(F.transform("_places", entry), lambda e: e["x"].isNotNull() & (e["x"] != 0))
    packed = found.groupBy(*KEYS).agg(F.array_sort(F.flatten(F.collect_list(own))).alias("_e"))  # a null list is not collected
    return packed.select(*KEYS, F.col("_e.at").alias("at"), F.col("_e.x").alias("x"))


def vectors(carried: DataFrame, widths: Sequence[int]) -> DataFrame:
    """``session_id, features`` from the carried blocks ``g0_at, g0_x, g1_at, ...``: one vector, as the struct that a vector is stored as.

    A phase that a session has not played has no entries.
    """
    def moved(places: Column, by: int) -> Column:
        return F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda k: k + F.lit(by))

    at, x, before = [], [], 0
    for i, width in enumerate(widths):
        at.append(moved(F.col(f"g{i}_at"), before))
        x.append(F.coalesce(f"g{i}_x", F.array().cast("array<double>")))
        before += width
    return carried.select(SESSION, F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(before).alias("size"), F.concat(*at).alias("indices"),
        F.concat(*x).alias("values")).alias("features"))


def read_vectors(spark: SparkSession, path: str, keep: Sequence[T.StructField] = ()) -> DataFrame:
    """A stored table whose column ``features`` was written as a struct, with vectors that estimators take."""
    return spark.read.schema(T.StructType([*keep, T.StructField("features", VectorUDT())])).parquet(path)


class Places(Sequence):
    """Names of the features of a vector by their place, without a list of them: each is its number as text."""

    def __init__(self, width: int):
        self.width = width

    def __len__(self) -> int:
        return self.width

    def __getitem__(self, i: int) -> str:
        if not 0 <= i < self.width:
            raise IndexError(i)
        return str(i)

    def __iter__(self) -> Iterator[str]:
        return map(str, range(self.width))

    def index(self, name: str, *_) -> int:
        if not (name.isdigit() and int(name) < self.width):
            raise ValueError(name)
        return int(name)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and name.isdigit() and int(name) < self.width


def feature_catalog(catalogs: dict[str, DataFrame], widths: Sequence[int], phases: Sequence[str] = PHASES) -> DataFrame:
    """``level_group, feature, block, column, value, stat``: what the number of a feature in the vectors of a phase stands for."""
    out = None
    for k, phase in enumerate(phases):
        for i in range(k + 1):
            own = catalogs[phases[i]].where("kept").select(
                F.lit(phase).alias(PHASE), (F.col("place") + sum(widths[:i])).cast("string").alias("feature"), F.lit(i).alias("block"),
                "column", "value", "stat")
            out = own if out is None else out.unionByName(own)
    return out
