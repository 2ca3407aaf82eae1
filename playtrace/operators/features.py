"""The feature step: one wide row per session and phase, carry-forward, and pruning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrace.functions.columns import nan_to
from playtrace.operators.sessions import with_differences
from playtrace.operators.stats import flat_stats, tall_stats
from playtrace.plans.skew import CHECK, dealt, find_hot
from playtrace.schema import (
    ALL_NULL_COLUMNS, CATEGORY_COLUMNS, KEYS, LANDMARKS, METRIC_COLUMNS, NUNIQUE_COLUMNS, PHASE, PHASES, SESSION, Landmark,
    null_token, phase_prefix, unique_names,
)

STATS = ["sum", "mean", "std", "max", "min"]
#: Most category values that become columns; longer vocabularies stay in the tall layout.
MAX_WIDE_VALUES = 5_000


@dataclass(frozen=True)
class CategoryValue:
    """One value that becomes 11 columns: its position in the dense array and its column-name stem."""

    pos: int
    column: str
    value: str
    stem: str


def wide_values(vocab: DataFrame, phase: str, columns: Sequence[str] = CATEGORY_COLUMNS) -> list[CategoryValue]:
    """The phase's values plus one null token per column, in a fixed order. They name the output columns, so
    they have to be known before the plan is built; read ``vocab`` from a table written once."""
    rows = (vocab.where((F.col(PHASE) == phase) & F.col("column").isin(list(columns)))
            .select("column", "value").limit(MAX_WIDE_VALUES + 1).collect())
    if len(rows) > MAX_WIDE_VALUES:
        raise ValueError(f"more than {MAX_WIDE_VALUES} values in phase {phase}: use tall_stats")
    by_column = {c: {r["value"] for r in rows if r["column"] == c} - {null_token(c)} for c in columns}
    pairs = [(c, v) for c in columns for v in [*sorted(by_column[c]), null_token(c)]]
    stems = unique_names([f"{c}_{v}" for c, v in pairs])
    return [CategoryValue(i, c, v, stem) for i, ((c, v), stem) in enumerate(zip(pairs, stems))]


def stat_names(value: CategoryValue) -> list[str]:
    return [f"{value.stem}_count", *[f"{value.stem}_{m}_{s}" for m in METRIC_COLUMNS for s in STATS]]


def place(tall: DataFrame, values: Sequence[CategoryValue]) -> DataFrame:
    """Add each row's slot number ``pos`` (null for values that have no columns)."""
    slots = tall.sparkSession.createDataFrame(
        [(v.column, v.value, v.pos) for v in values], "column string, value string, pos int")
    return tall.join(F.broadcast(slots), ["column", "value"], "left")  # at most MAX_WIDE_VALUES rows


def slots_expr() -> Column:
    """Aggregate over placed tall rows: slot number -> statistics of the values that occur."""
    stats = F.struct("n", *[nan_to(F.col(f"{m}_{s}")).alias(f"{m}_{s}") for m in METRIC_COLUMNS for s in STATS])
    entries = F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", stats.alias("stats"))))
    return F.map_from_entries(entries)


def slot_columns(values: Sequence[CategoryValue]) -> list[str]:
    """SQL texts of the 11 columns of each value. A lookup compares integers, and is shared by the 11."""
    out = []
    for v in values:
        count, *stats = stat_names(v)
        fields = [f"{m}_{s}" for m in METRIC_COLUMNS for s in STATS]
        out.append(f"coalesce(_slots[{v.pos}].n, 0L) AS `{count}`")
        out += [f"_slots[{v.pos}].{field} AS `{name}`" for field, name in zip(fields, stats)]
    return out


def session_features(
    events: DataFrame, phase: str, vocab: DataFrame, layout: str = "wide", hot=CHECK,
    landmarks: Sequence[Landmark] = LANDMARKS, empty_sum_zero: bool = False,
) -> DataFrame:
    """All features of one phase, one row per session (``layout="wide"``), or only the tall statistics. In the wide
    row a value that does not occur has count 0 and null statistics.

    Two branches, each reading and shuffling only its own columns by session: flat statistics, and the tall
    statistics packed into one map per session. Everything after the shuffle (ordered differences,
    aggregations, the final join, and the joins of ``carry_forward``) uses that partitioning: rows have one phase, so
    they are dealt by session alone unless a session is hot.
    """
    rows = events.where(F.col(PHASE) == phase).drop(*[c for c in ALL_NULL_COLUMNS if c in events.columns])
    if hot is CHECK:
        hot = find_hot(rows, KEYS)
    if hot is None:
        rows = dealt(rows, [SESSION])
    diffed = with_differences(rows, hot)
    if layout == "tall":
        return tall_stats(diffed)
    marks = [m for m in landmarks if m.phase == phase]
    flat = flat_stats(diffed, marks, hot=hot, empty_sum_zero=empty_sum_zero)
    values = wide_values(vocab, phase)
    # The tall rows of a column are its distinct values, so the distinct counts come from the same aggregation.
    tall = tall_stats(diffed, [*CATEGORY_COLUMNS, *[c for c in NUNIQUE_COLUMNS if c not in CATEGORY_COLUMNS]])
    packed = place(tall, values).groupBy(*KEYS).agg(
        *[F.count_if(F.col("column") == c).alias(f"{c}_nunique") for c in NUNIQUE_COLUMNS],
        slots_expr().alias("_slots"))
    doubles = [f.name for f in flat.schema.fields if f.dataType.typeName() == "double"]
    others = [c for c in flat.columns if c not in (*KEYS, *doubles)]
    return flat.join(packed.drop(PHASE), SESSION).selectExpr(
        *KEYS, *others, *[f"nanvl(`{c}`, -1D) AS `{c}`" for c in doubles],
        *[f"{c}_nunique" for c in NUNIQUE_COLUMNS], *slot_columns(values))


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in KEYS]


def to_float32(features: DataFrame) -> DataFrame:
    return features.selectExpr(
        *[c for c in KEYS if c in features.columns],
        *[f"CAST(`{c}` AS FLOAT) AS `{c}`" for c in feature_columns(features)])


def carry_forward(by_phase: dict[str, DataFrame], phases: Sequence[str] = PHASES) -> dict[str, DataFrame]:
    """For each phase, the features of all earlier phases and its own, prefixed ``g0_``, ``g1_``, ...

    A session missing from an earlier phase keeps its row, with nulls in that block.
    """
    out: dict[str, DataFrame] = {}
    earlier: list[DataFrame] = []
    for phase in phases:
        prefix = phase_prefix(phase, list(phases))
        own = by_phase[phase]
        own = own.selectExpr(SESSION, *[f"`{c}` AS `{prefix}{c}`" for c in feature_columns(own)])
        wide = own
        for block in earlier:
            wide = wide.join(block, SESSION, "left")
        order = [c for block in [*earlier, own] for c in block.columns if c != SESSION]
        out[phase] = wide.select(SESSION, *order)
        earlier.append(own)
    return out


def as_arrays(columns: Sequence[str]) -> tuple[Column, Column]:
    """The columns as one array of doubles, and their names. Parsed from one text each: a wide row has too many
    columns to build expression by expression from Python."""
    values = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in columns)
    names = ", ".join(f"'{c}'" for c in columns)
    return F.expr(f"array({values})"), F.expr(f"array({names})")


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, n, n_null, lowest, highest`` for numeric columns, as one narrow aggregation.

    The columns are unpivoted first: four aggregates whatever the width, where one aggregate per column would
    produce a plan too large to compile.
    """
    columns = list(columns)
    values, names = as_arrays(columns)
    tall = df.select(F.posexplode(values).alias("_i", "_x"))
    agg = tall.groupBy("_i").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_x").isNull()).alias("n_null"),
        F.min("_x").alias("lowest"), F.max("_x").alias("highest"))
    return agg.select(F.get(names, F.col("_i")).alias("feature"), "n", "n_null", "lowest", "highest")


def original_names(values: Sequence[CategoryValue]) -> dict[str, str]:
    """For each column of the wide row that belongs to a category value: the value as it stands in the vocabulary."""
    return {name: f"{v.column}={v.value}" for v in values for name in stat_names(v)}


def prune_features(
    features: DataFrame, phase: str, null_ratio: float = 0.9, originals: dict[str, str] | None = None,
) -> DataFrame:
    """Catalogue ``level_group, feature, original, kept, reason``: constant and mostly-null features are not kept.

    ``originals`` maps the names of category features to ``column=value`` as they were before names were made unique
    (``original_names``); any other feature is its own original. Null counts as one more value: a column of nulls is constant, one value next to nulls is not.
    """
    profile = column_profile(features, feature_columns(features))
    n, missing = F.col("n"), F.col("n_null")
    constant = (missing == n) | ((missing == 0) & (F.col("lowest") == F.col("highest")))
    reason = (F.when(constant, "constant")
              .when(missing / n > null_ratio, "null_ratio"))
    original = F.col("feature")
    if originals:
        named = features.sparkSession.createDataFrame(list(originals.items()), "feature string, _original string")
        profile = profile.join(F.broadcast(named), "feature", "left")  # at most one row per column
        original = F.coalesce("_original", "feature")
    return profile.select(
        F.lit(phase).alias(PHASE), "feature", original.alias("original"), reason.isNull().alias("kept"), reason.alias("reason"))


def kept_features(catalog: DataFrame, phase: str) -> list[str]:
    """Names to select; bounded by the width of the feature table."""
    rows = catalog.where((F.col(PHASE) == phase) & F.col("kept")).select("feature").collect()
    return sorted(r["feature"] for r in rows)


def select_features(features: DataFrame, names: Sequence[str]) -> DataFrame:
    wanted = set(names)
    return features.select(*[c for c in features.columns if c in KEYS or c in wanted])


def features_long(features: DataFrame) -> DataFrame:
    """``session_id, level_group, feature, value`` without nulls: the wide row as a narrow table."""
    values, names = as_arrays(feature_columns(features))
    tall = features.select(*KEYS, F.posexplode(values).alias("_i", "value"))
    return tall.where(F.col("value").isNotNull()).select(*KEYS, F.get(names, F.col("_i")).alias("feature"), "value")
