"""Model tables against the models they come from, sparse features against wide ones, and choices made from losses."""

import math
import random
import threading

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from playtrace.operators import model_table as X
from playtrace.operators import sparse as P
from playtrace.operators import training as T
from playtrace.operators.features import carry_forward, column_profile, feature_columns, session_features, stat_names, wide_values
from playtrace.operators.stats import tall_stats
from playtrace.operators.vocab import build_vocab
from playtrace.plans.training import Layout, StoredRun, prepare_features, score, train
from playtrace.schema import CATEGORY_COLUMNS, PHASE, PHASES, SESSION
from workload.inputs import event_log, question_labels

N = 5


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    given = []
    for s in range(160):
        x = [rnd.gauss(0, 1) for _ in range(N)]
        for level in (1, 2):
            given.append((s, level, s % 3, int(x[level] + rnd.gauss(0, 0.7) > 0), x))
    df = spark.createDataFrame(given, "session long, level int, fold int, correct int, x array<double>")
    return df.select("session", "level", "fold", "correct", array_to_vector("x").alias("features")).repartition(3).cache()


SPECS = [
    T.ModelSpec("gbt", "gbt", {"maxIter": 4, "maxDepth": 3, "seed": 1}, dropped={2: [0, 3]}),
    T.ModelSpec("forest", "forest", {"numTrees": 3, "maxDepth": 3, "seed": 1}, balanced=True),
    T.ModelSpec("logistic", "logistic", {"maxIter": 5, "regParam": 0.05}, dropped={1: ["f4"]}),
]
NAMES = [f"f{i}" for i in range(N)]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_table_equals_the_models(spark, rows, spec):
    models = T.fit_levels(rows, spec, [1, 2], range(3), names=NAMES)
    want = {}
    for (level, fold), model in models.items():
        for r in model.transform(rows).select("session", vector_to_array("probability")[1].alias("p")).collect():
            want[r["session"], level, fold] = r["p"]
    table = X.model_table(models, spec.name, NAMES, spark)
    vectors = rows.where("level = 1").select(F.col("session").alias(SESSION), "features")
    for most in (X.MOST_NODES, 1):  # one pass, or one for each model
        passes = X.scorers(table, NAMES, most)
        got = {(r["session"], r["level"], r["fold"]): r["p"] for r in X.score_models(vectors, passes).collect()}
        assert len(passes) == (1 if most > 1 else 6) and got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    oof = T.oof_predict(rows, models, spec.name).collect()
    assert len(oof) == rows.count()
    assert all(r["p"] == pytest.approx(want[r["session"], r["level"], r["fold"]], abs=1e-12) for r in oof)


def test_scores_have_one_plan_whatever_the_models(spark, rows):
    models = T.fit_levels(rows, SPECS[0], [1, 2], range(3))
    vectors = rows.where("level = 1").select(F.col("session").alias(SESSION), "features")
    names = P.Places(N)

    def nodes(some):
        table = X.model_table(some, "gbt", names, spark)
        plan = X.score_models(vectors, X.scorers(table, names))._jdf.queryExecution().executedPlan().toString()
        return plan.count("\n"), plan.count("MapInArrow")

    assert nodes(models) == nodes({k: models[k] for k in [(1, 0)]}) and nodes(models)[1] == 1


def test_unknown_features_are_an_error(spark, rows):
    table = X.model_table(T.fit_levels(rows, SPECS[2], [2], [0]), "logistic", P.Places(N), spark)
    with pytest.raises(ValueError):
        X.scorers(table, ["other"])


def brute_prefix(losses, patience):
    best, at = math.inf, 0
    for t, loss in enumerate(losses, 1):
        if loss < best:
            best, at = loss, t
        elif patience is not None and t - at >= patience:
            break
    return at


@pytest.mark.parametrize("patience", [None, 1, 2, 50])
@pytest.mark.parametrize("inner", [None, 0.3])
def test_trees_up_to_the_best_loss(spark, rows, patience, inner):
    spec = T.ModelSpec("gbt", "gbt", {"maxIter": 7, "maxDepth": 3, "stepSize": 0.6, "seed": 1})
    table, best = T.fit_patient(rows, spec, [1, 2], range(3), patience, inner)
    fit_on, choose_by = T.validation_rows(rows, inner, 3)
    models = T.fit_levels(fit_on, spec, [1, 2], range(3))
    got = {(r["level"], r["fold"]): r["trees"] for r in best.collect()}
    for (level, fold), model in models.items():
        valid = [(r["correct"], r["features"]) for r in choose_by.where((F.col("level") == level) & (F.col("fold") == fold)).collect()]
        learner = model.stages[-1]
        raw = np.cumsum([[w * t.predict(x) for _, x in valid] for w, t in zip(learner.treeWeights, learner.trees)], axis=0)
        p = np.clip(1 / (1 + np.exp(-2 * raw)), 1e-15, 1 - 1e-15)
        y = np.array([c for c, _ in valid])
        losses = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean(axis=1)
        assert got[level, fold] == brute_prefix([round(x, 12) for x in losses], patience)
    kept = {(r["level"], r["fold"]): r["n"] for r in table.groupBy("level", "fold").agg(F.count_distinct("tree").alias("n")).collect()}
    assert kept == got


def test_inner_rows_are_not_trained_on(rows):
    fit_on, choose_by = T.validation_rows(rows, 0.3, 3)
    inside = {r["session"] for r in choose_by.collect()}
    assert 20 < len(inside) < 80 and not inside & {r["session"] for r in fit_on.collect()}
    own = {r["session"]: r["fold"] for r in rows.collect()}
    assert all(r["fold"] != own[r["session"]] for r in choose_by.collect())
    assert choose_by.count() == 2 * 2 * len(inside)


def test_search_halves_the_trials(rows):
    space = {"stepSize": ("log", 0.1, 0.5), "maxIter": ("int", 2, 4), "maxDepth": ("int", 1, 2)}
    trials = T.hyperparam_search(rows, [1, 2], 4, space, 3, keep=0.5, budgets=(0.3, 0.6, 1.0)).collect()
    for level in (1, 2):
        by_rung = [sorted((-r["auc"], r["trial"]) for r in trials if r["level"] == level and r["rung"] == k) for k in range(3)]
        assert [len(x) for x in by_rung] == [4, 2, 1]
        for now, later in zip(by_rung, by_rung[1:]):
            assert {t for _, t in later} == {t for _, t in now[:len(later)]}
        assert [(r["rung"], r["trial"]) for r in trials if r["level"] == level and r["best"]] == [(2, by_rung[2][0][1])]


# Sparse features.

@pytest.fixture(scope="module")
def log(spark):
    return event_log(spark, "/root/testdata/sf0.001")[0].cache()


def wide_entries(log, phase):
    """What the wide row has: session -> name -> value."""
    vocab = build_vocab(log)
    wide = session_features(log, phase, vocab, hot=None)
    names = feature_columns(wide)
    return {r[SESSION]: {n: r[n] for n in names} for r in wide.collect()}, wide_values(vocab, phase)


@pytest.mark.parametrize("phase", PHASES)
def test_block_equals_the_wide_row(log, phase):
    wide, values = wide_entries(log, phase)
    stems = {(v.column, v.value): stat_names(v) for v in values}
    flat = P.flat_names(log, phase)
    got = {}
    for r in P.block(log, phase, None).collect():
        names = flat if r["column"] == P.FLAT else stems[r["column"], r["value"]]
        got.setdefault(r[SESSION], {}).update(zip(names, r["stats"]))
    assert got.keys() == wide.keys()
    for session, row in wide.items():
        for name, value in row.items():
            mine = got[session].get(name, 0 if name.endswith("_count") and name not in flat else None)
            assert mine == (value if value is None else pytest.approx(float(value))), name


def test_pruning_by_fold_equals_separate_profiles(spark, log):
    phase = "5-12"
    rows = P.block(log, phase, None).cache()
    folds = rows.select(SESSION).distinct().withColumn("fold", (F.col(SESSION) % 3).cast("int"))
    columns = ["column", "value", "stat", "n", "n_null", "lowest", "highest", "kept", "reason"]
    together = P.pruned(P.profile(rows, folds))
    for k in range(3):
        alone = P.pruned(P.profile(rows.where(F.col(SESSION) % 3 != k)))
        want = {tuple(r[:3]): r[3:] for r in alone.select(*columns).collect()}
        got = {tuple(r[:3]): r[3:] for r in together.where(F.col("fold") == k).select(*columns).collect()}
        # a value that only the fold itself has is constant outside of it
        assert want.items() <= got.items() and {got[x][6] for x in got.keys() - want.keys()} <= {"constant"}


def test_profile_equals_that_of_the_wide_row(log):
    phase = "0-4"
    wide, values = wide_entries(log, phase)
    table = session_features(log, phase, build_vocab(log), hot=None)
    want = {r["feature"]: (r["n"], r["n_null"], r["lowest"], r["highest"]) for r in column_profile(table, feature_columns(table)).collect()}
    names = {(P.FLAT, ""): P.flat_names(log, phase)} | {(v.column, v.value): stat_names(v) for v in values}
    got = {names[r["column"], r["value"]][r["stat"]]: (r["n"], r["n_null"], r["lowest"], r["highest"])
           for r in P.profile(P.block(log, phase, None)).collect()}
    for name, (n, missing, low, high) in got.items():
        assert want[name][:2] == (n, missing)
        assert (low, high) == (want[name][2:] if low is None else (pytest.approx(want[name][2]), pytest.approx(want[name][3])))


def test_vectors_hold_each_kept_feature(spark, log, tmp_path):
    out = Layout(str(tmp_path))
    widths = prepare_features(log, out, hot=None)
    for i, phase in enumerate(PHASES):
        catalog = {r["place"]: (r["column"], r["value"], r["stat"]) for r in
                   spark.read.parquet(f"{out.catalog}/phase={i}").where("kept").collect()}
        assert sorted(catalog) == list(range(widths[i]))
        block = {(r[SESSION], r["column"], r["value"]): r["stats"] for r in spark.read.parquet(f"{out.features}/phase={i}").collect()}
        before = sum(widths[:i])
        for r in P.read_vectors(spark, f"{out.carried}/phase={i}", [P.BLOCK_SCHEMA[SESSION]]).collect():
            v = r["features"]
            assert v.size == sum(widths[:i + 1])
            for place, (column, value, stat) in catalog.items():
                stats = block.get((r[SESSION], column, value))
                x = None if stats is None else stats[stat]
                if column in CATEGORY_COLUMNS and stat == 0:
                    assert v[before + place] == (x or 0)
                else:
                    assert v[before + place] == pytest.approx(0 if x is None else x + 1)


def many_values(spark, log, n):
    """The log with ``n`` values of one column more, spread over its events."""
    return log.withColumn("fqid", F.concat(F.lit("item."), F.pmod(F.xxhash64("event_id"), F.lit(n)).cast("string")))


@pytest.fixture(scope="module")
def wide_vocabulary(spark):
    log = event_log(spark, "/root/testdata/sf0.01")[0]
    copies = log.withColumn("event_id", F.explode(F.array(*[F.col("event_id") + 1_000_000 * k for k in range(3)])))
    return many_values(spark, copies, 200_000).cache()


def test_training_and_scoring_beyond_any_wide_row(spark, wide_vocabulary, tmp_path):
    log = wide_vocabulary
    assert log.select("fqid").distinct().count() > 20_000
    specs = [T.ModelSpec("logistic", "logistic", {"maxIter": 2, "regParam": 0.5}), T.ModelSpec("gbt", "gbt", {"maxIter": 1, "maxDepth": 1, "seed": 3})]
    out = Layout(str(tmp_path))
    scores = train(log, question_labels(spark, "/root/testdata/sf0.01"), specs, out, [2, 15], 2, parallelism=4, hot=None)
    assert {(r["scope"], r["level"]) for r in scores.collect()} == {
        (s, level) for s in ("logistic", "gbt", "stack") for level in (2, 15, None)}
    run = StoredRun(spark, out, ["logistic", "gbt"], 2)
    assert sum(run.widths) > 20_000
    got = score(run, log, None).collect()
    sessions = {p: {r[SESSION] for r in log.where(F.col(PHASE) == p).select(SESSION).distinct().collect()} for p in ("0-4", "13-22")}
    assert {(r["session"], r["level"]) for r in got} == {(s, 2) for s in sessions["0-4"]} | {(s, 15) for s in sessions["13-22"]}
    assert all(0 <= r["p"] <= 1 or math.isfinite(r["p"]) for r in got)


def test_features_of_values_that_are_new_are_left_out(spark, log, tmp_path):
    out = Layout(str(tmp_path))
    prepare_features(log, out, hot=None)
    catalog = spark.read.parquet(f"{out.catalog}/phase=0")
    changed = log.where(F.col(PHASE) == "0-4").withColumn("fqid", F.lit("never seen"))
    packed = P.pack(P.block(changed, "0-4", None), catalog)
    fqids = {r["place"] for r in catalog.where("kept AND column = 'fqid'").collect()}
    assert fqids and not any(fqids & set(r["at"]) for r in packed.collect())
    assert packed.count() == changed.select(SESSION).distinct().count()
    carried = carry_forward({PHASES[0]: packed}, PHASES[:1])[PHASES[0]]
    assert P.vectors(carried, [catalog.where("kept").count()]).count() == packed.count()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_task_gets_a_bounded_share(spark, log, monkeypatch):
    """The number of parts follows the rows, whatever the setting for shuffles is."""
    from playtrace.plans import skew
    rows = spark.range(100)
    assert skew.task_count(rows, 10) == 10
    assert skew.dealt(rows, ["id"], 10).rdd.getNumPartitions() == 10
    monkeypatch.setattr(skew, "task_count", lambda df, most=0: 13)
    assert "RepartitionByExpression [session_id" in plan_of(P.block(log, "0-4", None)) and ", 13" in plan_of(P.block(log, "0-4", None))


def test_scoring_keeps_the_features_of_each_phase(spark, log, monkeypatch):
    from playtrace.plans import training
    kept = []
    run = type("Run", (), {
        "levels": {p: [1] for p in PHASES}, "features": lambda self, e, p, hot: e.where(F.col(PHASE) == p).groupBy(SESSION).agg(
            F.array(F.lit(0)).alias("at"), F.array(F.lit(1.0)).alias("x")), "predict": lambda self, carried, p: carried.select(SESSION)})()
    monkeypatch.setattr(training, "reliable", lambda df: kept.append(df) or df)
    assert training.score(run, log, None).count() == sum(log.where(F.col(PHASE) == p).select(SESSION).distinct().count() for p in PHASES)
    assert len(kept) == len(PHASES)


def test_a_profile_computes_its_block_once(log):
    """What is made of a profile reads its rows and not the events again."""
    assert "Window" not in plan_of(P.profile(P.block(log, "0-4", None)))


def test_training_rows_are_cut_by_what_comes_out(spark):
    from playtrace.operators.training import model_rows
    labels = spark.range(40).selectExpr("id % 4 AS session", "CAST(id % 10 AS INT) AS level", "0 AS fold", "1 AS correct")
    vectors = spark.range(4).selectExpr("id AS session_id", "array(1D) AS features")
    out = model_rows(labels, vectors, 5)
    assert out.count() == 40
    assert plan_of(out).count("RepartitionByExpression [session") == 2 and ", 8" in plan_of(out)


def test_columns_are_dropped_in_one_pass_over_the_held_out_rows(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from playtrace.operators import training
    rows = spark.createDataFrame(
        [(i, level, i % 3, int(i % 2 == 0), Vectors.dense([float(i % 2), float(i % 5)])) for i in range(30) for level in (1, 2)],
        ["session", "level", "fold", "correct", "features"]).selectExpr(
        "session", "CAST(level AS INT) AS level", "CAST(fold AS INT) AS fold", "CAST(correct AS INT) AS correct", "features")
    seen, whole = [], training.oof_scores
    monkeypatch.setattr(training, "oof_scores", lambda r, s: seen.append(r.count()) or whole(r, s))
    spec = training.ModelSpec("logistic", "logistic", {"maxIter": 3, "regParam": 0.1})
    out = {(r["level"], r["feature"]): r for r in training.drop_column_selection(rows, ["a", "b"], spec, [1, 2], 0).collect()}
    assert seen == [20]
    for level in (1, 2):
        alone = training.fit_levels(rows, training.ModelSpec("x", "logistic", spec.params, {}, {level: [0]}), [level], [0], 1)
        want = training.log_loss(training.oof_predict(rows, alone, "x")).first()["log_loss"]
        assert out[level, "a"]["log_loss"] == pytest.approx(want) and not out[level, "a"]["drop"]


def test_batches_are_scored_in_slices(spark, rows, monkeypatch):
    """No matrix has more than ``CELLS`` cells, and slices give the matrix of the whole batch, whatever kind its vectors are."""
    monkeypatch.setattr(X, "CELLS", 8)
    columns = np.array([1, 3])
    values = vector_to_array("features")
    sparse = (F.lit(0).cast("tinyint"), F.lit(N), F.array(F.lit(1), F.lit(3)), F.slice(values, 1, 2))
    dense = (F.lit(1).cast("tinyint"), F.lit(None).cast("int"), F.lit(None).cast("array<int>"), values)
    for kind in (sparse, dense):
        vector = F.struct(*[x.alias(n) for x, n in zip(kind, ("type", "size", "indices", "values"))])
        batch = rows.limit(21).select(vector.alias("features")).toArrow().combine_chunks().to_batches()[0]
        whole = X.matrix(batch.column(0), columns)
        parts = [X.matrix(b.column(0), columns) for b in X.slices(batch, columns)]
        assert max(p.size for p in parts) <= 8 and len(parts) == 6
        assert np.array_equal(np.concatenate(parts), whole)


def test_statistics_of_values_are_computed_once(spark, monkeypatch):
    """A block asks only for the statistics that it keeps; distinct values are counted without any."""
    asked = []
    monkeypatch.setattr(P, "tall_stats", lambda d, *columns: asked.append(columns) or tall_stats(d, *columns))
    log, _ = event_log(spark, "/root/testdata/sf0.001")
    P.block(log, PHASES[0], None)
    assert asked == [()]


def test_fits_side_by_side_have_properties_of_their_own(spark):
    """Local properties hold the number of the running execution, which no other thread may change."""
    sc, both = spark.sparkContext, threading.Barrier(2)

    def work(job):
        sc.setLocalProperty("playtrace.job", str(job))
        both.wait(60)
        return sc.getLocalProperty("playtrace.job")

    assert T._side_by_side(spark, [1, 2], work, 2) == ["1", "2"]


def test_parts_of_a_fit_follow_its_entries(spark, rows, monkeypatch):
    """Neither the files that rows were written to nor the number of questions decide what a fit holds."""
    parts = []
    monkeypatch.setattr(T, "_fit_fold", lambda mine, *_: parts.append((mine.rdd.getNumPartitions(), mine.count())))
    many = rows.repartition(40)
    T.fit_levels(many, SPECS[2], [1], [0])
    n = rows.where("level = 1").count()
    monkeypatch.setattr(T, "TASK_ENTRIES", n * N // 3)
    T.fit_levels(many, SPECS[2], [1], [0])
    assert parts[0] == (1, n) and parts[1] in [(3, n), (4, n)]
    monkeypatch.setattr(T, "HELD_ENTRIES", 2_000)
    assert [T._at_once({1: k, 2: 10}, 10, 8) for k in (10, 100, 1_000)] == [8, 2, 1]
    assert T._at_once({}, 10, 8) == 8


def test_rows_of_a_fit_stand_in_memory_once(rows, monkeypatch):
    """A question's rows are on disk, its learner's blocks in memory; at 90,000 sessions and 1,342 features two questions fit."""
    levels = []
    monkeypatch.setattr(T, "_fit_fold", lambda mine, *_: levels.append(mine.storageLevel))
    T.fit_levels(rows, SPECS[2], [1], [0])
    assert levels[0].useDisk and not levels[0].useMemory
    assert T._at_once({1: 90_000, 2: 90_000, 3: 90_000}, 1_342, 8) == 2
