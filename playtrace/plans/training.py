"""The whole batch run, from an event log and its labels to stored features, models, stackers and scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.operators import labels as L
from playtrace.operators.features import carry_forward
from playtrace.operators.metrics import best_threshold, threshold_sweep
from playtrace.operators.model_table import Scorer, model_table, score_models, scorers
from playtrace.operators.modelsel import mean_importance, top_half
from playtrace.operators.sparse import Places, block, numbered, pack, profile, pruned, read_vectors, vectors
from playtrace.operators.stacking import apply_stack, ensemble_score, ridge_stack
from playtrace.operators.training import ModelSpec, fit_levels, gains, oof_predict, session_rows
from playtrace.operators.vocab import build_vocab
from playtrace.plans.skew import CHECK, reliable, task_count
from playtrace.schema import PHASE, PHASES, SESSION
from playtrace.sources import tables as S

#: Columns of the rows that models are fitted on, before their vector: a session's questions and answers are two lists.
MODEL_ROW = [T.StructField("session", T.LongType()), T.StructField("fold", T.IntegerType()),
             *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("levels", "correct")]]
#: Such rows that one task writes; their vectors have thousands of entries.
WIDE_ROWS = 10_000
#: Sessions that one task joins and scores; some tens of MB.
SCORED_ROWS = 2_000


@dataclass(frozen=True)
class Layout:
    """Where the tables of a run live."""

    root: str

    @property
    def vocab(self) -> str:
        return f"{self.root}/vocab"

    @property
    def features(self) -> str:
        return f"{self.root}/features"

    @property
    def catalog(self) -> str:
        return f"{self.root}/catalog"

    @property
    def packed(self) -> str:
        return f"{self.root}/packed"

    @property
    def carried(self) -> str:
        return f"{self.root}/carried"

    @property
    def labels(self) -> str:
        return f"{self.root}/labels"

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def models(self) -> str:
        return f"{self.root}/models"

    @property
    def oof(self) -> str:
        return f"{self.root}/oof"

    @property
    def stackers(self) -> str:
        return f"{self.root}/stackers"

    @property
    def scores(self) -> str:
        return f"{self.root}/scores"


def prepare_features(events: DataFrame, out: Layout, hot=CHECK, null_ratio: float = 0.9) -> list[int]:
    """Vocabulary, features per phase, catalogue and carried vectors as tables; returns the number of features of each phase.

    Features stay tall until they are numbered: the vocabulary may have any size.
    """
    spark = events.sparkSession
    S.write_vocab(build_vocab(events), out.vocab)
    packed, widths = {}, []
    for i, phase in enumerate(PHASES):
        S.write_features(block(events, phase, hot), f"{out.features}/phase={i}")
        rows = S.read_table(spark, f"{out.features}/phase={i}")
        S.write_table(numbered(pruned(profile(rows), null_ratio)), f"{out.catalog}/phase={i}")
        catalog = S.read_table(spark, f"{out.catalog}/phase={i}")
        S.write_table(pack(rows, catalog), f"{out.packed}/phase={i}")
        packed[phase] = S.read_table(spark, f"{out.packed}/phase={i}")
        widths.append(catalog.where("kept").count())
    for i, carried in enumerate(carry_forward(packed).values()):
        S.write_features(vectors(carried, widths[:i + 1]), f"{out.carried}/phase={i}")
    return widths


def best_scores(oof: DataFrame, scope: str, y: str = "y", p: str = "p") -> DataFrame:
    """``scope, level, threshold, score``: the best threshold of each question, and (level null) over all of them."""
    by_level = best_threshold(threshold_sweep(oof, ["level"], y=y, p=p), ["level"])
    over_all = best_threshold(threshold_sweep(oof, y=y, p=p)).withColumn("level", F.lit(None).cast("int"))
    columns = [F.lit(scope).alias("scope"), F.col("level").cast("int").alias("level"), "threshold", "score"]
    return by_level.select(*columns).unionByName(over_all.select(*columns))


def without_lower_half(spec: ModelSpec, importance: DataFrame, names: Sequence[str], levels: Sequence[int]) -> ModelSpec:
    """The variant ``<name>_half`` of a model that leaves out all but the half of the features with the largest mean gain."""
    kept: dict[int, set[str]] = {level: set() for level in levels}
    for row in top_half(importance).select("level", "feature").collect():  # at most one row per level and feature
        kept[row["level"]].add(row["feature"])
    dropped = {level: [n for n in names if n not in own] for level, own in kept.items() if own}
    return replace(spec, name=f"{spec.name}_half", dropped=dropped)


def model_names(specs: Sequence[ModelSpec], halved: Sequence[str] = ()) -> list[str]:
    """The models of a run: each spec, and its half where asked for."""
    return [n for s in specs for n in ([s.name, f"{s.name}_half"] if s.name in halved else [s.name])]


def train(
    events: DataFrame, labels: DataFrame, specs: Sequence[ModelSpec], out: Layout, levels: Sequence[int],
    n_folds: int = 5, seed: int = 42, parallelism: int = 4, hot=CHECK, halved: Sequence[str] = (),
) -> DataFrame:
    """Run every step and return the scores table ``scope, level, threshold, score`` (each model, and the stack).

    The models named in ``halved`` are fitted a second time with the half of their features that had the largest gain.
    """
    spark: SparkSession = events.sparkSession
    parsed = L.assign_phase(L.parse_labels(labels)).where(F.col("level").isin(list(levels)))
    parsed = parsed.join(L.group_folds(parsed, k=n_folds, seed=seed), "session")
    S.write_folds(parsed, out.labels)
    parsed = S.read_table(spark, out.labels)
    widths = prepare_features(events, out, hot)
    for i, phase in enumerate(PHASES):
        mine = parsed.where(F.col(PHASE) == phase)
        asked = sorted(r["level"] for r in mine.select("level").distinct().collect())
        if not asked:
            continue
        names = Places(sum(widths[:i + 1]))
        rows_path = f"{out.rows}/phase={i}"
        S.write_table(session_rows(mine, S.read_table(spark, f"{out.carried}/phase={i}"), WIDE_ROWS), rows_path)
        rows = read_vectors(spark, rows_path, MODEL_ROW)

        def fit(spec: ModelSpec):
            models = fit_levels(rows, spec, asked, range(n_folds), parallelism, names)
            S.write_table(model_table(models, spec.name, names, spark), f"{out.models}/model={spec.name}/phase={i}")
            S.write_table(oof_predict(rows, models, spec.name), f"{out.oof}/model={spec.name}/phase={i}")
            return models

        for spec in specs:
            models = fit(spec)
            if spec.name in halved:
                fit(without_lower_half(spec, mean_importance(gains(models, names, spark)), names, asked))
    oof = S.read_table(spark, out.oof)
    inputs = model_names(specs, halved)
    for name in inputs:
        S.append_scores(best_scores(oof.where(F.col("model") == name), name), out.scores)
    aligned = L.align_models(oof, inputs, ["session", "level", "fold", "y"])
    S.write_table(ridge_stack(aligned, inputs), out.stackers)
    stacked = apply_stack(aligned, S.read_table(spark, out.stackers), inputs, ["level", "fold"])
    S.append_scores(best_scores(stacked, "stack"), out.scores)
    return S.read_table(spark, out.scores)


class StoredRun:
    """A finished run, read back: features as its vocabulary and catalogue have them, models, stackers and the threshold."""

    def __init__(self, spark: SparkSession, out: Layout, models: Sequence[str], n_folds: int = 5):
        self.out, self.models, self.n_folds = out, list(models), n_folds
        self.catalogs = {p: S.read_table(spark, f"{out.catalog}/phase={i}") for i, p in enumerate(PHASES)}
        self.widths = [c.where("kept").count() for c in self.catalogs.values()]
        asked = S.read_table(spark, out.labels).select(PHASE, "level").distinct().collect()  # one row per question
        self.levels = {p: sorted(r["level"] for r in asked if r[PHASE] == p) for p in PHASES}
        stack = S.read_table(spark, out.scores).where((F.col("scope") == "stack") & F.col("level").isNull())
        self.threshold = stack.first()["threshold"]
        self.passes: dict[str, list[Scorer]] = {}

    def features(self, events: DataFrame, phase: str, hot=CHECK) -> DataFrame:
        """The run's features of one phase for new events: places and values of those that the catalogue keeps."""
        return pack(block(events, phase, hot), self.catalogs[phase])

    def predict(self, carried: DataFrame, phase: str) -> DataFrame:
        """``session, level, p, correct`` for carried rows of one phase: the mean of all folds, stacked, over the threshold.

        All questions, folds and models are scored in one pass over the rows.
        """
        spark, widths = carried.sparkSession, self.widths[:PHASES.index(phase) + 1]
        if phase not in self.passes:
            keys = F.col("level").isin(self.levels[phase]) & F.col("model").isin(self.models) & (F.col("fold") < self.n_folds)
            table = spark.read.parquet(*[f"{self.out.models}/model={m}/phase={PHASES.index(phase)}" for m in self.models])
            self.passes[phase] = scorers(table.where(keys), Places(sum(widths)))
        predictions = score_models(vectors(carried, widths), self.passes[phase])
        stackers = S.read_table(spark, self.out.stackers)
        return ensemble_score(predictions, stackers, self.models, self.threshold)


def score(run: StoredRun, events: DataFrame, hot=CHECK) -> DataFrame:
    """Predictions of a stored run for all sessions of an event log, in batch.

    Each phase's features are computed once and kept in the checkpoint folder: no task holds the statistics of several phases. They
    are joined in parts by sessions, ``SCORED_ROWS`` in each: Spark, left alone, joins parts by their size on disk, and packed
    vectors are many times larger in a task.
    """
    stored = {p: reliable(run.features(events, p, hot)) for p in PHASES}
    parts = max(task_count(own, SCORED_ROWS) for own in stored.values())
    carried = carry_forward({p: own.repartition(parts, SESSION) for p, own in stored.items()})
    return reduce(DataFrame.unionByName, [run.predict(carried[p], p) for p in PHASES if run.levels[p]])
