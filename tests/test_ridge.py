"""Logistic regressions fitted together against those of ``pyspark.ml``, each fitted alone."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.operators import ridge as R
from playtrace.operators import training as M
from playtrace.operators.labels import weight_of_class
from playtrace.operators.model_table import model_table, scorers, score_models
from playtrace.operators.sparse import Places
from playtrace.schema import SESSION

N, LEVELS, FOLDS = 6, [4, 7], range(3)


@pytest.fixture(scope="module")
def tables(spark):
    """Labels, some of which come twice or are missing, and vectors, half of them sparse, with a feature that never changes."""
    rnd = random.Random(5)
    labels, vectors = [], []
    for s in range(150):
        x = [rnd.gauss(0, 1), rnd.gauss(1e6, 3e3), 7.0, rnd.choice([0.0, 0.0, 5.0]), 0.0, rnd.gauss(0, 1)]
        vectors.append((s, x))
        for level in LEVELS:
            y = int(x[0] + (x[1] - 1e6) / 3e3 * (level == 7) + rnd.gauss(0, 1) > 0.4)
            labels += [(s, level, s % 3, y)] * rnd.choice([0, 1, 1, 2])
    labels = spark.createDataFrame(labels, "session long, level int, fold int, correct int")
    at = F.filter(F.sequence(F.lit(0), F.lit(N - 1)), lambda i: F.get("x", i) != 0)
    sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(N).alias("size"), at.alias("indices"),
                      F.filter("x", lambda v: v != 0).alias("values"))
    vectors = spark.createDataFrame(vectors, f"{SESSION} long, x array<double>")
    # alone, a weighted feature that never changes has a deviation that is rounding: there it is 0
    dense = array_to_vector(F.transform("x", lambda v: F.when(v == 7.0, F.lit(0.0)).otherwise(v)))
    return labels, vectors.select(SESSION, dense.alias("features")), vectors.select(SESSION, sparse.alias("features"))


@pytest.fixture(scope="module")
def rows(spark, tables, tmp_path_factory):
    labels, _, sparse = tables
    path = str(tmp_path_factory.mktemp("ridge") / "rows")
    M.session_rows(labels, sparse, 20).write.parquet(path)
    own = T.StructType([T.StructField("session", T.LongType()), T.StructField("fold", T.IntegerType()),
                        *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("levels", "correct")], T.StructField("features", VectorUDT())])
    return spark.read.schema(own).parquet(path).cache()


def alone(tables, spec, level, fold):
    labels, dense, _ = tables
    mine = M.model_rows(labels, dense).where((F.col("level") == level) & (F.col("fold") != fold))
    mine = weight_of_class(mine) if spec.balanced else mine.withColumn("weight", F.lit(1.0))
    return LogisticRegression(labelCol="correct", weightCol="weight", maxIter=500, tol=1e-14, **spec.params).fit(mine)


SPECS = [M.ModelSpec("low", "ridge", {"regParam": 0.1}, balanced=True), M.ModelSpec("high", "ridge", {"regParam": 1.0})]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
@pytest.mark.parametrize("most, collected", [(R.MOST_CURVED, 0), (0, R.COLLECTED)])
def test_models_are_those_of_single_fits(spark, rows, tables, monkeypatch, spec, most, collected):
    monkeypatch.setattr(R, "MOST_CURVED", most)
    monkeypatch.setattr(R, "COLLECTED", collected)
    monkeypatch.setattr(R, "PIECE", 5)
    monkeypatch.setattr(R, "BLOCK_CELLS", 120)
    monkeypatch.setattr(R, "PART_ENTRIES", 400)
    for given in [rows] if spec.balanced else [M.label_rows(rows)]:
        got = M.fit_levels(given, spec, LEVELS, FOLDS)
        assert list(got) == [(level, fold) for level in LEVELS for fold in FOLDS]
        for (level, fold), model in got.items():
            want, mine = alone(tables, spec, level, fold), model.stages[-1]
            for a, b, size in zip(mine.coefficients.toArray(), want.coefficients.toArray(), (1, 3e3, 1, 1, 1, 1)):
                assert a * size == pytest.approx(b * size, abs=1e-5)
            assert mine.intercept == pytest.approx(want.intercept, rel=1e-4, abs=1e-2)
            assert mine.coefficients[2] == mine.coefficients[4] == 0


def test_a_run_fits_its_models_to_the_end(rows):
    """No parameter of the stored run's models ends a fit early: at the answer the loss is level."""
    from workload.models import _RUN_SPECS
    for spec in _RUN_SPECS:
        model = M.fit_levels(rows, spec, [4], [0])[4, 0].stages[-1]
        mine = M.label_rows(rows).where("level = 4 AND fold != 0")
        given = (weight_of_class(mine) if spec.balanced else mine.withColumn("weight", F.lit(1.0))).collect()
        x, y, w = np.array([r["features"].toArray() for r in given]), np.array([r["correct"] for r in given]), np.array([r["weight"] for r in given])
        p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
        mean = (w[:, None] * x).sum(axis=0) / w.sum()
        variance = (w[:, None] * (x - mean) ** 2).sum(axis=0) / (w.sum() - (w * w).sum() / w.sum())
        kept = variance > 1e-9
        slope = (x - mean).T @ (w * (p - y)) / w.sum() + spec.params["regParam"] * variance * model.coefficients.toArray()
        assert np.abs(slope[kept] / np.sqrt(variance[kept])).max() < 1e-5 and abs((w * (p - y)).sum()) / w.sum() < 1e-5


def test_left_out_features_and_stored_models(spark, rows, tables):
    spec = M.ModelSpec("some", "ridge", {"regParam": 0.1}, dropped={7: [0]})
    models = M.fit_levels(rows, spec, LEVELS, FOLDS)
    assert models[7, 0].stages[-1].coefficients.size == N - 1 and models[4, 0].stages[-1].coefficients.size == N
    vectors = rows.select(F.col("session").alias(SESSION), "features")
    passes = scorers(model_table(models, "some", Places(N), spark), Places(N))
    got = {(r["session"], r["level"], r["fold"]): r["p"] for r in score_models(vectors, passes).collect()}
    for key, model in models.items():
        for r in model.transform(rows).selectExpr("session", "probability").collect():
            assert got[r["session"], *key] == pytest.approx(r["probability"][1], abs=1e-9)
    oof = M.oof_predict(rows, models, "some").collect()
    by_label = M.oof_predict(M.label_rows(rows), models, "some").collect()
    assert sorted(oof) == sorted(by_label) and len(oof) == tables[0].count()
    assert all(r["p"] == pytest.approx(got[r["session"], r["level"], r["fold"]], abs=1e-9) for r in oof)


def test_a_vector_is_stored_once(rows, tables):
    labels, _, _ = tables
    assert rows.count() == labels.select("session").distinct().count()
    columns = ["session", "level", "fold", "correct"]
    assert sorted(M.label_rows(rows).select(*columns).collect()) == sorted(labels.select(*columns).collect())


def test_rows_of_one_class(rows):
    """As in ``pyspark.ml``: no coefficients, and an intercept that is always right; no rows at all are an error."""
    ones = rows.withColumn("correct", F.transform("correct", lambda _: F.lit(1)))
    model = M.fit_levels(ones, SPECS[0], [4], [0])[4, 0].stages[-1]
    assert model.intercept == math.inf and not model.coefficients.toArray().any()
    with pytest.raises(ValueError):
        M.fit_levels(rows, SPECS[1], [99], [0])
    with pytest.raises(ValueError):
        M.fit_levels(rows, M.ModelSpec("x", "ridge", {"elasticNetParam": 0.5}), [4], [0])
