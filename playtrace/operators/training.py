"""One classifier per (question, fold) on ``pyspark.ml``: fitting, out-of-fold predictions, selection, search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import partial
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrace.operators.boosting import Settings, fit_boosted
from playtrace.operators.labels import weight_of_class
from playtrace.operators.metrics import log_loss, roc_auc
from playtrace.operators.model_table import (
    SCHEMA, best_prefix, kept_places, oof_scores, prefixes, rows_of, score_models, scorer, scorer_of, staged_losses,
)
from playtrace.operators.ridge import Fit, fit_ridges
from playtrace.operators.sparse import Places
from playtrace.plans.skew import TASK_ROWS, reliable, task_count
from playtrace.schema import KEYS, SESSION

#: Entries (rows times features, some 12 bytes each) that one task of a fit holds, and that all fits side by side keep in memory, as
#: the learners' own blocks. The rows that these are made from stand on the executors' disks.
TASK_ENTRIES, HELD_ENTRIES = 4_000_000, 250_000_000

#: Stands for a missing feature value; tree learners here reject NaN.
MISSING = -1.0

#: ``boosted``, fitted in one task each, is not among them (``playtrace.operators.boosting``).
#: ``ridge`` is the logistic regression at the least point of its loss, for which ``fit_levels`` fits all questions and folds together.
ESTIMATORS: dict[str, Callable[..., Estimator]] = {
    "gbt": GBTClassifier, "forest": RandomForestClassifier, "logistic": LogisticRegression, "ridge": LogisticRegression,
}


@dataclass(frozen=True)
class ModelSpec:
    """A named model: estimator, parameters (with per-question overrides), and the features it leaves out, by name or place."""

    name: str
    estimator: str = "gbt"
    params: dict = field(default_factory=dict)
    level_params: dict[int, dict] = field(default_factory=dict)
    dropped: dict[int, Sequence[int | str]] = field(default_factory=dict)
    balanced: bool = False
    early_stop: bool = False

    def pipeline(self, level: int, n_features: int, names: Sequence[str] = ()) -> Pipeline:
        dropped = [x for x in self.dropped.get(level, ()) if not isinstance(x, str) or x in names]
        out = {names.index(x) if isinstance(x, str) else x for x in dropped}
        settings = {**self.params, **self.level_params.get(level, {})}
        learner = ESTIMATORS[self.estimator](labelCol="correct", featuresCol="kept" if out else "features", **settings)
        if self.balanced:
            learner = learner.setWeightCol("weight")
        if self.early_stop and isinstance(learner, GBTClassifier):
            learner = learner.setValidationIndicatorCol("is_valid")
        if not out:
            return Pipeline(stages=[learner])
        kept = [i for i in range(n_features) if i not in out]
        return Pipeline(stages=[VectorSlicer(inputCol="features", outputCol="kept", indices=kept), learner])


def feature_vector(features: DataFrame, names: Sequence[str], missing: float = MISSING) -> DataFrame:
    """``session_id`` and one dense vector of the named features, nulls and NaN replaced."""
    values = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in names)
    instead = f"CAST({missing} AS DOUBLE)"
    filled = f"transform(array({values}), x -> coalesce(nanvl(x, {instead}), {instead}))"
    return features.select(SESSION, array_to_vector(F.expr(filled)).alias("features"))


def model_rows(labels: DataFrame, vectors: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Training rows: labels (``session, level, fold, correct`` and optionally ``weight``) with their vector.

    Write them partitioned by ``level``: every fit then reads only its own question. A vector stands once for each label, so tasks
    are cut by the rows that come out, about ``task_rows`` in each, and not by what goes in.
    """
    keep = [c for c in ("session", "level", "fold", "correct", "weight") if c in labels.columns]
    parts = task_count(labels, task_rows)
    return labels.select(*keep).repartition(parts, "session").join(
        vectors.withColumnRenamed(SESSION, "session").repartition(parts, "session"), "session")


def session_rows(labels: DataFrame, vectors: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The same with each vector once: ``session, fold, levels, correct, features``, where a session's labels are two lists.

    A vector of thousands of entries for each of ten questions is most of what training would write and read.
    """
    both = F.sort_array(F.collect_list(F.struct("level", "correct"))).alias("_l")
    lists = reliable(labels.groupBy("session", "fold").agg(both).select(
        "session", "fold", F.col("_l.level").alias("levels"), F.col("_l.correct").alias("correct")))
    parts = task_count(lists, task_rows)
    return lists.repartition(parts, "session").join(
        vectors.withColumnRenamed(SESSION, "session").repartition(parts, "session"), "session")


def label_rows(rows: DataFrame) -> DataFrame:
    """``session, level, fold, correct, features`` from the rows of sessions."""
    if "levels" not in rows.columns:
        return rows
    both = F.arrays_zip(F.col("levels").alias("level"), F.col("correct").alias("correct"))
    return rows.select("session", "fold", "features", F.inline(both)).select("session", "level", "fold", "correct", "features")


def _width(rows: DataFrame) -> int:
    return rows.select("features").first()["features"].size


def _side_by_side(spark: SparkSession, jobs: Sequence, work: Callable, parallelism: int) -> list:
    # Each job inherits for itself: otherwise all threads would share one set of local properties, and with it the running execution.
    targets = [inheritable_thread_target(spark)(partial(work, job)) for job in jobs]
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        return pool.map(lambda target: target(), targets)


def _sizes(rows: DataFrame, levels: Sequence[int]) -> dict[int, int]:
    """The rows of each question, in one pass that reads no vectors."""
    found = {r["level"]: r["count"] for r in rows.groupBy("level").count().collect()}  # one row per question
    return {level: found.get(level, 0) for level in levels}


def _of_level(rows: DataFrame, level: int, n_rows: int, n_features: int) -> DataFrame:
    """A question's rows, kept on disk in parts by their entries: a fit has some ten jobs, and a task for each part in each of them,
    however many files the rows were written to. In memory the learner keeps what it makes of them; both would be the same rows twice."""
    mine = rows.where(F.col("level") == level).coalesce(max(1, math.ceil(n_rows * n_features / TASK_ENTRIES)))
    return mine.persist(StorageLevel.DISK_ONLY)


def _at_once(sizes: dict[int, int], n_features: int, parallelism: int) -> int:
    """Questions that are fitted side by side: as many as fit in memory. Fits of large ones have tasks for all cores by themselves."""
    return max(1, min(parallelism, HELD_ENTRIES // max(1, max(sizes.values(), default=0) * n_features)))


def _fit_fold(
    mine: DataFrame, spec: ModelSpec, level: int, fold: int, n_features: int, names: Sequence[str] = (),
) -> PipelineModel:
    held_out = F.col("fold") == fold
    train = mine.where(~held_out)
    if spec.balanced:
        train = weight_of_class(train)
    if spec.early_stop:
        valid = mine.where(held_out).drop("weight")
        valid = valid.withColumn("weight", F.lit(1.0)) if "weight" in train.columns else valid
        train = train.withColumn("is_valid", F.lit(False)).unionByName(valid.withColumn("is_valid", F.lit(True)))
    return spec.pipeline(level, n_features, names).fit(train)


def fit_levels(
    rows: DataFrame, spec: ModelSpec, levels: Sequence[int], folds: Sequence[int], parallelism: int = 4,
    names: Sequence[str] = (),
) -> dict[tuple[int, int], PipelineModel]:
    """Independent fits, several at a time; each is itself a distributed job over its question's rows.

    With early stopping the held-out fold decides when to stop (it is marked, not trained on). Balanced weights come from
    the rows that a fit trains on. Rows are those of labels or of sessions (``session_rows``).
    """
    if spec.estimator == "ridge":
        return _fit_ridges(rows, spec, levels, folds, names)
    rows = label_rows(rows)
    if spec.estimator == "boosted":
        return _fit_boosted(rows, spec, levels, folds, names)
    n_features, sizes = _width(rows), _sizes(rows, levels)

    def fit(level: int) -> dict[tuple[int, int], PipelineModel]:
        mine = _of_level(rows, level, sizes[level], n_features)  # read once for all folds
        try:
            return {(level, fold): _fit_fold(mine, spec, level, fold, n_features, names) for fold in folds}
        finally:
            mine.unpersist()

    fitted = {}
    for own in _side_by_side(rows.sparkSession, list(levels), fit, _at_once(sizes, n_features, parallelism)):
        fitted |= own
    return fitted


def _fit_ridges(
    rows: DataFrame, spec: ModelSpec, levels: Sequence[int], folds: Sequence[int], names: Sequence[str],
) -> dict[tuple[int, int], PipelineModel]:
    """All questions and folds in passes over the rows that they share."""
    spark, n_features = rows.sparkSession, _width(rows)
    known = {"regParam", "tol", "maxIter"}
    if unknown := {*spec.params, *(k for own in spec.level_params.values() for k in own)} - known:
        raise ValueError(f"a ridge has no parameters {sorted(unknown)}")
    lists = rows = rows.where(F.col("fold").isNotNull())
    if "levels" not in rows.columns:
        lists = rows.select("session", "fold", F.array("level").alias("levels"), F.array("correct").alias("correct"), "features")
    counts: dict[tuple[int, int], dict[int, int]] = {}  # one row per question, fold and label
    labels = lists.select("fold", F.inline(F.arrays_zip(F.col("levels").alias("level"), F.col("correct").alias("correct"))))
    for level, fold, label, n in labels.groupBy("level", "fold", "correct").count().collect():
        counts.setdefault((level, fold), {})[label] = n
    groups: dict[tuple, list[Fit]] = {}
    for level in levels:
        found = spec.pipeline(level, n_features, names).getStages()
        out = sorted(set(range(n_features)) - set(found[0].getIndices())) if len(found) > 1 else []
        settings = {**spec.params, **spec.level_params.get(level, {})}
        for fold in folds:
            seen = [sum(c.get(y, 0) for (of, k), c in counts.items() if of == level and k != fold) for y in (0, 1)]
            classes = sum(n > 0 for n in seen)
            weight = tuple(sum(seen) / (classes * n) if spec.balanced and n else 1.0 for n in seen)
            groups.setdefault(tuple(sorted(settings.items())), []).append(Fit(level, fold, weight, out))
    models = {}
    n_rows = lists.select("fold").count()
    for settings, fits in groups.items():
        own = dict(settings)
        found = fit_ridges(lists, fits, n_features, n_rows, own.get("regParam", 0.0), own.get("tol", 1e-6), own.get("maxIter", 100))
        for f, (coefficients, intercept) in zip(fits, found):
            models[f.level, f.fold] = _logistic_model(spark, coefficients, intercept, f.out)
    return {(level, fold): models[level, fold] for level in levels for fold in folds}


def _fit_boosted(
    rows: DataFrame, spec: ModelSpec, levels: Sequence[int], folds: Sequence[int], names: Sequence[str],
) -> dict[tuple[int, int], PipelineModel]:
    """Each question and fold in a task of its own; their trees are scored as rows of a model table."""
    settings = {level: Settings(**{**spec.params, **spec.level_params.get(level, {})}) for level in levels}
    out = {level: [names.index(x) if isinstance(x, str) else x for x in spec.dropped.get(level, ()) if not isinstance(x, str) or x in names]
           for level in levels}
    keys = [(level, fold) for level in levels for fold in folds]
    found = fit_boosted(rows, keys, _width(rows), settings, spec.balanced, out)
    return {key: PipelineModel([model]) for key, model in found.items()}


def _logistic_model(spark: SparkSession, coefficients, intercept: float, out: Sequence[int]) -> PipelineModel:
    """A fitted model of ``pyspark.ml`` with these coefficients."""
    kept = [i for i in range(len(coefficients)) if i not in set(out)] if out else None
    own = Vectors.dense(coefficients if kept is None else coefficients[kept])
    uid = LogisticRegression().uid
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(uid, _py2java(spark.sparkContext, own), float(intercept))
    model = LogisticRegressionModel(java)
    if kept is None:
        return PipelineModel([model])
    java.setFeaturesCol("kept")
    return PipelineModel([VectorSlicer(inputCol="features", outputCol="kept", indices=kept), model])


def oof_predict(rows: DataFrame, models: dict[tuple[int, int], PipelineModel], name: str) -> DataFrame:
    """Predictions of each model on its held-out fold: ``session, level, fold, model, y, p``.

    One pass over the rows, each of which is answered by the model of its own question and fold.
    """
    return oof_scores(rows, scorer_of(models, name, _width(rows), rows.sparkSession))


def predict_all_folds(vectors: DataFrame, models: dict[tuple[int, int], PipelineModel], name: str) -> DataFrame:
    """Predictions of every fold's model for new sessions: ``session, level, fold, model, p``. The vectors are read once."""
    scored = score_models(vectors, [scorer_of(models, name, _width(vectors), vectors.sparkSession)])
    return scored.select("session", "level", "fold", "model", "p")


def gains(
    models: dict[tuple[int, int], PipelineModel], names: Sequence[str], spark: SparkSession,
) -> DataFrame:
    """Importance of the features that each model uses: ``level, fold, feature, gain``. One small vector per model."""
    out = []
    for (level, fold), model in models.items():
        kept, found = kept_places(model, len(names)), model.stages[-1].featureImportances
        out += [(level, fold, names[kept[int(i)]], float(v)) for i, v in zip(found.indices, found.values)]
    return spark.createDataFrame(out, "level int, fold int, feature string, gain double")


def drop_column_selection(
    rows: DataFrame, names: Sequence[str], spec: ModelSpec, levels: Sequence[int], fold: int = 0,
    groups: dict[str, Sequence[int]] | None = None, parallelism: int = 4,
) -> DataFrame:
    """Refit without each feature (or named group of features) and mark it if the log loss on the held-out fold gets
    strictly lower: ``level, feature, baseline, log_loss, drop``. The cost is one fit per feature and level.

    A level's rows are read once for all of its fits, and the models of all levels and groups are scored in one pass over the
    held-out rows."""
    groups = groups or {n: [i] for i, n in enumerate(names)}
    trials = [None, *groups]
    n_features, sizes, spark = _width(rows), _sizes(rows, levels), rows.sparkSession

    def fit(level: int) -> list[tuple]:
        mine = _of_level(rows, level, sizes[level], n_features)
        try:
            nodes = []
            for k, group in enumerate(trials):
                out = sorted({*spec.dropped.get(level, ()), *(groups[group] if group else ())})
                model = _fit_fold(mine, replace(spec, dropped={level: out}), level, fold, n_features)
                nodes += rows_of({(level, fold): model}, str(k), Places(n_features), spark)
            return nodes
        finally:
            mine.unpersist()

    at_once = _at_once(sizes, n_features, parallelism)
    nodes = [row for own in _side_by_side(spark, list(levels), fit, at_once) for row in own]
    held_out = rows.where((F.col("fold") == fold) & F.col("level").isin(list(levels)))
    scored = oof_scores(held_out, scorer(pd.DataFrame(nodes, columns=SCHEMA.names), Places(n_features)))
    found = {(r["level"], trials[int(r["model"])]): r["log_loss"]
             for r in log_loss(scored, ["level", "model"]).collect()}  # one row per level and group
    table = [(level, g, found[level, None], found[level, g], found[level, g] < found[level, None])
             for level in levels for g in groups]
    return spark.createDataFrame(
        table, "level int, feature string, baseline double, log_loss double, `drop` boolean")


def apply_selection(spec: ModelSpec, selection: DataFrame) -> ModelSpec:
    """``spec`` without the features that ``drop_column_selection`` marked, in addition to those it leaves out already."""
    out = {level: list(found) for level, found in spec.dropped.items()}
    for row in selection.where("`drop`").select("level", "feature").collect():  # at most one row per level and feature
        out.setdefault(row["level"], []).append(row["feature"])
    return replace(spec, dropped=out)


def apply_search(spec: ModelSpec, trials: DataFrame) -> ModelSpec:
    """``spec`` with the parameters of the best trial of each question that ``hyperparam_search`` has looked at."""
    out = dict(spec.level_params)
    for row in trials.where("best").select("level", "params").collect():  # one row per level
        own = {k: int(v) if k in ("maxIter", "maxDepth") else v for k, v in row["params"].items()}
        if "featureSubset" in own:
            own["featureSubsetStrategy"] = f"{own.pop('featureSubset'):.6f}"
        out[row["level"]] = {**out.get(row["level"], {}), **own}
    return replace(spec, level_params=out)


# The ranges that are searched. Two more dimensions of gradient boosting libraries, the L1 and L2 penalties on leaf
# weights, have no counterpart in the learners of ``pyspark.ml`` and are not searched.
SEARCH_SPACE = {
    "stepSize": ("log", 0.02, 0.1), "maxIter": ("int", 100, 700), "maxDepth": ("int", 3, 10),
    "subsamplingRate": ("uniform", 0.4, 0.8), "featureSubset": ("uniform", 0.2, 0.6),
}


def draw(space: dict[str, tuple], rng: random.Random) -> dict:
    def one(kind: str, low, high):
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.randint(low, high) if kind == "int" else rng.uniform(low, high)

    return {name: one(*bounds) for name, bounds in space.items()}


def _settings(trial: dict, seed: int) -> dict:
    """A trial as parameters of the boosted learner."""
    own = {k: v for k, v in trial.items() if k != "featureSubset"}
    if "featureSubset" in trial:
        own["featureSubsetStrategy"] = f"{trial['featureSubset']:.6f}"
    return {**own, "seed": seed}


def hyperparam_search(
    rows: DataFrame, levels: Sequence[int], n_trials: int = 100, space: dict[str, tuple] = SEARCH_SPACE, n_folds: int = 5,
    seed: int = 42, parallelism: int = 4, keep: float = 1 / 3, budgets: Sequence[float] = (0.1, 0.3, 1.0),
) -> DataFrame:
    """Random search by mean AUC over the group folds, all questions side by side, by successive halving.

    In each rung the trials that a question has left are fitted with a share of their trees (``budgets``); the best ``keep`` of them, by
    AUC, then by number, go on. One row per question, rung and trial: ``level, rung, trial, params, auc, best``; ``best`` marks the
    first maximum of a question's last rung. All models of a rung are scored in one pass over the rows.
    """
    rng = random.Random(seed)
    trials = [draw(space, rng) for _ in range(n_trials)]
    left = {level: list(range(n_trials)) for level in levels}
    n_features, spark = _width(rows), rows.sparkSession
    table = []
    for rung, budget in enumerate(budgets):
        nodes: list[tuple] = []
        for t, trial in enumerate(trials):
            asked = [level for level in levels if t in left[level]]
            if not asked:
                continue
            own = _settings(trial, seed)
            own["maxIter"] = max(1, math.ceil(own.get("maxIter", 20) * budget))
            models = fit_levels(rows, ModelSpec(f"trial{t}", "gbt", own), asked, range(n_folds), parallelism)
            nodes += rows_of(models, f"trial{t}", Places(n_features), spark)
        scored = oof_scores(rows, scorer(pd.DataFrame(nodes, columns=SCHEMA.names), Places(n_features)))
        by_fold = roc_auc(scored, ["level", "model", "fold"])
        found = {(r["level"], int(r["model"].removeprefix("trial"))): r["auc"] or 0.0 for r in
                 by_fold.groupBy("level", "model").agg(F.avg("auc").alias("auc")).collect()}  # one row per question and trial
        last = rung == len(budgets) - 1
        for level in levels:
            order = sorted(left[level], key=lambda t: (-found[level, t], t))
            table += [(level, rung, t, {k: float(v) for k, v in trials[t].items()}, float(found[level, t]), last and t == order[0])
                      for t in left[level]]
            left[level] = sorted(order[:max(1, math.ceil(len(order) * keep))])
    return spark.createDataFrame(
        table, "level int, rung int, trial int, params map<string,double>, auc double, best boolean")


def validation_rows(rows: DataFrame, inner: float | None = None, n_folds: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(rows to train on, rows to choose trees by)``.

    Trees are chosen by the held-out fold itself, or, with ``inner``, by about that share of each fit's training sessions, which
    the fit then does not see: a session is drawn by its hash for all questions. Drawn rows stand once for each fold but their own.
    """
    if inner is None:
        return rows, rows
    drawn = F.pmod(F.xxhash64(F.lit(seed), "session"), F.lit(1_000_000)) < int(inner * 1_000_000)
    others = F.array_remove(F.array(*[F.lit(k) for k in range(n_folds)]), F.col("fold"))
    return rows.where(~drawn), rows.where(drawn).withColumn("fold", F.explode(others))


def fit_patient(
    rows: DataFrame, spec: ModelSpec, levels: Sequence[int], folds: Sequence[int], patience: int | None = 50,
    inner: float | None = None, parallelism: int = 4, names: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(model table, best prefixes)`` of boosted models that keep the trees up to their best loss.

    Models are fitted with all their trees; the losses of all prefixes of all models come from one pass over the rows that
    choose. ``patience`` ends the search after so many trees without a better loss, as if fitting had stopped there.
    """
    train, valid = validation_rows(rows, inner, len(folds))
    names = names or Places(_width(rows))
    models = fit_levels(train, spec, levels, folds, parallelism, names)
    nodes = rows_of(models, spec.name, names, rows.sparkSession)
    valid = valid.where(F.col("level").isin(list(levels)) & F.col("fold").isin(list(folds)))
    best = reliable(best_prefix(staged_losses(valid, scorer(pd.DataFrame(nodes, columns=SCHEMA.names), names)), patience))
    return prefixes(rows.sparkSession.createDataFrame(nodes, SCHEMA), best), best


def feature_names(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in KEYS]
