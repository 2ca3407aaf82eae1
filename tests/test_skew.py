"""Hot keys take another plan; the rows must be the same. The limit is lowered so that test data is hot."""

import pytest
from pyspark.sql import functions as F
from rows import same

from playtrace.operators import labels as L
from playtrace.operators import metrics as M
from playtrace.operators import sessions as W
from playtrace.operators import stats as A
from playtrace.operators.vocab import build_vocab
from playtrace.plans import skew
from playtrace.schema import KEYS, SESSION
from workload.inputs import event_log, parsed_labels, scores

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark):
    """One session holds about a third of the rows."""
    plain, _ = event_log(spark, SF)
    merged = plain.withColumn(SESSION, F.when(F.col(SESSION) % 3 == 0, F.lit(3)).otherwise(F.col(SESSION)).cast("long"))
    return merged.cache()


def both(monkeypatch, build, limit=50):
    """``(ordinary plan, plan with hot keys)``."""
    usual = build()
    monkeypatch.setattr(skew, "HOT_ROWS", limit)
    return usual, build()


CASES = {
    "differences": lambda log: W.with_differences(log).select("event_id", "elapsed_time_diff", "location_x_diff"),
    "reversals": lambda log: W.with_reversals(log).select("event_id", "reversal_sum"),
    "first_play": lambda log: W.first_play_only(log).select("event_id"),
    "monotonic": lambda log: W.non_monotonic_sessions(log),
    "row_number": lambda log: skew.with_row_number(log, [SESSION], ["event_id"], "rn", "n").select("event_id", "rn", "n"),
    "quantiles": lambda log: A.quantiles_nearest(W.with_differences(log)),
    "medians": lambda log: A.word_times(W.with_differences(log)),
    "flat": lambda log: A.flat_stats(W.with_differences(log)),
    "vocab": lambda log: build_vocab(log),
    "ranks": lambda log: skew.value_at_ranks(log, [SESSION], "room_coor_x", {"mid": lambda n: F.floor((n - 1) / 2)}),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_sessions(spark, log, monkeypatch, name):
    limit = 5 if name == "vocab" else 50
    same(*both(monkeypatch, lambda: CASES[name](log), limit))


def test_the_fixture_is_hot(spark, log):
    assert 0 < skew.find_hot(log, KEYS, 50).count() < log.select(*KEYS).distinct().count()
    assert skew.find_hot(log, KEYS) is None


def test_hot_users_in_the_adapter(spark, monkeypatch):
    same(*both(monkeypatch, lambda: event_log(spark, SF)[0], 66))


def test_auc_with_many_scores(spark, monkeypatch):
    s = scores(spark, SF)
    same(*both(monkeypatch, lambda: M.roc_auc(s, p="p2"), 20))
    same(*both(monkeypatch, lambda: M.roc_auc(s, ["level"], p="p3"), 3))


def test_folds_with_a_large_stratum(spark, monkeypatch):
    labels = parsed_labels(spark, SF)
    same(*both(monkeypatch, lambda: L.group_folds(labels), 3))


def test_long_sequences_continue(spark, log):
    out = W.session_segments(log, ["event_id"], 40)
    assert out.agg(F.max(F.size("event_id"))).first()[0] == 40
    flat = out.orderBy(SESSION, "segment").select(SESSION, F.posexplode("event_id").alias("i", "event_id"))
    assert flat.count() == log.count()
    whole = W.session_sequences(log, ["event_id"])
    joined = out.groupBy(SESSION).agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("segment", "event_id"))), lambda x: x["event_id"])).alias("event_id"))
    same(joined, whole.select(SESSION, "event_id"))


def test_descending_ranks_of_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0), ("a", 2.0), ("a", 5.0), ("b", None)], "k string, v double")
    ranks = {f"r{i}": lambda n, i=i: F.lit(i) for i in range(3)}
    for hot in (None, df.select("k").distinct()):
        rows = skew.value_at_ranks(df, ["k"], "v", ranks, hot).collect()
        assert [(r["k"], r["r0"], r["r1"], r["r2"]) for r in rows] == [("a", 2.0, 2.0, 5.0)]


def test_null_keys_survive_the_split(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "k int, v int")
    usual = skew.with_running_sum(df, ["k"], ["v"], F.col("v"), "s", "t", hot=None)
    hot = skew.find_hot(df, ["k"], 1)
    same(usual, skew.with_running_sum(df, ["k"], ["v"], F.col("v"), "s", "t", hot=hot))


def test_stored_buckets_are_carried_forward_without_a_shuffle(spark, tmp_path):
    from playtrace.operators.features import carry_forward
    from playtrace.sources.tables import write_bucketed

    rows = spark.createDataFrame([(s, p, float(s)) for s in range(50) for p in ("0-4", "5-12", "13-22")], "session_id long, level_group string, x double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = {p: write_bucketed(rows.where(F.col("level_group") == p), f"test_buckets_{i}", f"{tmp_path}/{i}", 4) for i, p in enumerate(("0-4", "5-12", "13-22"))}
        carried = carry_forward(stored)["13-22"]
        plan = carried._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(tuple(r) for r in carried.collect()) == [(s, float(s), float(s), float(s)) for s in range(50)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for i in range(3):
            spark.sql(f"DROP TABLE IF EXISTS test_buckets_{i}")
