"""Labels: parsing, phases, folds, balanced weights, and the joins with features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrace.functions.columns import label_question, label_session, question_phase
from playtrace.plans.skew import CHECK, bounded_broadcast, with_row_number
from playtrace.schema import PHASE, SESSION


def parse_labels(labels: DataFrame) -> DataFrame:
    """Add ``session`` and ``level`` (the question) from ``<session>_q<n>``."""
    return labels.withColumns({
        "session": label_session(F.col("session_id")), "level": label_question(F.col("session_id"))})


def assign_phase(labels: DataFrame) -> DataFrame:
    return labels.withColumn(PHASE, question_phase(F.col("level")))


def group_folds(
    labels: DataFrame, group: str = "session", label: str = "correct", k: int = 5, seed: int = 42, hot=CHECK,
) -> DataFrame:
    """One row per group with its ``fold``: no group spans folds, and label rates are alike.

    Groups with the same label profile (number of rows and of positives) form a stratum; within a stratum they
    are dealt out to the folds in a seeded hash order, each stratum starting at its own fold. A large stratum is
    numbered without a single-task window.
    """
    profile = labels.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(label).alias("n_pos"))
    mixed = profile.withColumn("_mix", F.md5(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string"))))
    dealt = with_row_number(mixed, ["n_rows", "n_pos"], ["_mix", group], "_rn", hot=hot)
    fold = F.pmod(F.col("_rn") - 1 + F.col("n_rows") + F.col("n_pos"), F.lit(k)).cast("int")
    return dealt.select(group, fold.alias("fold"))


def with_folds(labels: DataFrame, folds: DataFrame, group: str = "session") -> DataFrame:
    return labels.join(folds, group)


def fold_split(labels: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """``(train, valid)`` of a fold."""
    return labels.where(F.col("fold") != fold), labels.where(F.col("fold") == fold)


def weight_of_class(rows: DataFrame, label: str = "correct", name: str = "weight") -> DataFrame:
    """``rows`` of one fit with the weight n / (number of classes * rows of the class), from counts of these rows alone."""
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(total / (len(counts) * n))).otherwise(weight)
    return rows.withColumn(name, weight)


def balanced_weights(labels: DataFrame, label: str = "correct", name: str = "weight") -> DataFrame:
    """Add the row weight n / (number of classes * rows of the class) over all rows; for fits, see ``weight_of_class``."""
    classes = labels.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    overall = Window.partitionBy(F.lit(0))  # over one row per class
    weights = classes.select(
        F.col(label).alias("_y"),
        (F.sum("_c").over(overall) / (F.count(F.lit(1)).over(overall) * F.col("_c"))).alias(name))
    return labels.join(bounded_broadcast(weights), F.col(label) == F.col("_y")).drop("_y")


def join_features(labels: DataFrame, features: DataFrame, strict: bool = False) -> DataFrame:
    """Features of each label's session, and of its phase where both tables have one.

    ``strict`` fails, while the join runs, at a label that has none.
    """
    on = ["session", *([PHASE] if PHASE in labels.columns and PHASE in features.columns else [])]
    feats = features.withColumnRenamed(SESSION, "session")
    feats = feats if PHASE in on else feats.drop(PHASE)
    if not strict:
        return labels.drop(SESSION).join(feats, on)
    found = labels.drop(SESSION).join(feats.withColumn("_found", F.lit(True)), on, "left")
    lost = F.raise_error(F.concat(F.lit("label without features: session "), F.col("session").cast("string")))
    return found.where(F.when(F.col("_found").isNull(), lost.cast("boolean")).otherwise(True)).drop("_found")


def label_lists(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per session (and ``by``) the list of labels in question order. At most one entry per question."""
    rows = F.sort_array(F.collect_list(F.struct("level", "correct")))
    return labels.groupBy("session", *by).agg(rows.alias("_rows")).select(
        F.col("session").alias(SESSION), *by, F.col("_rows.correct").alias("correct"))


def sample_sessions(events: DataFrame, sample: DataFrame) -> DataFrame:
    """Events of the sessions in ``sample``."""
    return events.join(sample.select(SESSION).distinct(), SESSION, "left_semi")


def session_phase_grid(events: DataFrame, phases: Sequence[str]) -> DataFrame:
    """Every (phase, session) pair in phase-major order, numbered phases first."""
    sessions = events.select(SESSION).distinct()
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(p).alias(PHASE)) for i, p in enumerate(phases)])
    return sessions.select(SESSION, F.inline(steps)).orderBy("step", SESSION)


def align_models(oof: DataFrame, models: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Predictions of several models side by side, joined by key and never by position.

    Two predictions of one model for one key are an error, raised while the query runs.
    """
    twice = F.raise_error(F.lit("a model has two predictions for one key")).cast("double")
    one = oof.groupBy(*keys, "model").agg(F.count(F.lit(1)).alias("_n"), F.max("p").alias("p"))
    one = one.withColumn("p", F.when(F.col("_n") > 1, twice).otherwise(F.col("p")))
    return one.groupBy(*keys).pivot("model", list(models)).agg(F.max("p"))
