"""Properties that must hold whatever the data."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import same

from playtrace.operators import labels as L
from playtrace.operators import stacking as K
from playtrace.operators.features import carry_forward, session_features
from playtrace.operators.vocab import build_vocab
from playtrace.schema import PHASES
from workload.inputs import event_log, parsed_labels, scores

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


def test_folds_are_disjoint_and_balanced(spark):
    labels = parsed_labels(spark, SF_LARGER)
    folds = L.group_folds(labels)
    assert folds.count() == labels.select("session").distinct().count()
    per = L.with_folds(labels, folds).groupBy("fold").agg(
        F.count_distinct("session").alias("n"), F.avg("correct").alias("rate")).collect()
    assert len(per) == 5
    assert max(r["n"] for r in per) - min(r["n"] for r in per) <= 10
    assert max(r["rate"] for r in per) - min(r["rate"] for r in per) < 0.02


def test_ridge_equals_closed_form(spark):
    s = scores(spark, SF_LARGER)
    inputs = ["p1", "p2", "p3", "p4"]
    rows = s.toPandas()
    for got in K.ridge_stack(s, inputs).collect():
        train = rows[(rows["level"] == got["level"]) & (rows["fold"] != got["fold"])]
        x, y = train[inputs].to_numpy(), train["y"].to_numpy()
        xc, yc = x - x.mean(axis=0), y - y.mean()
        coef = np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ yc)
        assert got["coef"] == pytest.approx(coef, abs=1e-9)
        assert got["intercept"] == pytest.approx(y.mean() - x.mean(axis=0) @ coef, abs=1e-9)


def test_partitioning_does_not_change_features(spark):
    log, _ = event_log(spark, SF)
    vocab = build_vocab(log).cache()
    usual = session_features(log, "5-12", vocab)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        shuffled = session_features(log.repartition(5, "k"), "5-12", vocab)
        columns = ["session_id", "nrows", "elapsed_time_diff_mean", "word_median_it", "reader_bingo_span_index",
                   "fqid_reader_count", "fqid_reader_elapsed_time_diff_std", "room_coor_x_qtile_0_2", "text_nunique"]
        same(usual.select(*columns), shuffled.select(*columns))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_carried_features_are_not_shuffled_again(spark, tmp_path):
    event_log(spark, SF)[0].write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    vocab = build_vocab(log)
    carried = carry_forward({p: session_features(log, p, vocab) for p in PHASES})
    plan = carried["13-22"]._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(shuffles) <= 6  # two branches of each phase
    assert all(re.search(r"hashpartitioning\(session_id#\d+L?, \d+\)", x) for x in shuffles)


def test_feature_plan_shuffles_by_session_only(spark, tmp_path):
    event_log(spark, SF)[0].write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    f = session_features(log, "5-12", build_vocab(log))
    plan = f._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert shuffles and len(shuffles) <= 2
    assert all(re.search(r"hashpartitioning\(session_id#\d+L?, \d+\)", x) for x in shuffles)
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan or "ShuffledHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
