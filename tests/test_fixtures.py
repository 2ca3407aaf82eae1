"""Hand-checked results on a few rows each."""

import math

import pytest
from pyspark.sql import functions as F
from rows import events

from playtrace.functions import arrays as R
from playtrace.functions import columns as C
from playtrace.operators import labels as L
from playtrace.operators import metrics as M
from playtrace.operators import sessions as W
from playtrace.operators import stats as A
from playtrace.operators.features import carry_forward, prune_features, session_features
from playtrace.operators.vocab import build_vocab, encode_columns
from playtrace.schema import EVENT_SCHEMA, KEYS, LANDMARKS, WORDS, unique_names, word_key
from playtrace.sources import tables as S


def one(df):
    return df.first().asDict()


def test_single_event(spark):
    d = W.with_differences(events(spark, {"elapsed_time": 70}))
    row = one(A.flat_stats(d))
    assert row["elapsed_time_diff_mean"] == 0
    assert row["elapsed_time_diff_std"] is None
    assert row["elapsed_time_diff_qtile_0_75"] == 0
    assert row["hover_duration_qtile_0_5"] is None
    assert row["nrows"] == 1


def test_backwards_time_is_zero(spark):
    d = W.with_differences(events(spark, *[{"elapsed_time": t} for t in (100, 40, 90)]))
    assert [r[0] for r in d.orderBy("index").select("elapsed_time_diff").collect()] == [0, 0, 50]


def test_null_coordinate(spark):
    d = W.with_differences(events(spark, *[{"screen_coor_x": x} for x in (5.0, None, 9.0)]))
    assert [r[0] for r in d.orderBy("index").select("location_x_diff").collect()] == [None, None, None]


def test_differences_restart_in_a_phase(spark):
    rows = [{"elapsed_time": 10 * i, "level_group": g} for i, g in enumerate(["0-4", "0-4", "5-12", "5-12"])]
    d = W.with_differences(events(spark, *rows))
    assert [r[0] for r in d.orderBy("index").select("elapsed_time_diff").collect()] == [0, 10, 0, 10]


def test_nan_but_not_null_is_filled(spark):
    df = spark.createDataFrame([(math.nan,), (None,)], "x double")
    assert [r[0] for r in df.select(C.nan_to(F.col("x"))).collect()] == [-1.0, None]


def test_null_token_counts_as_a_value(spark):
    log = events(spark, {"fqid": None}, {"fqid": None})
    assert one(A.nunique(log))["fqid_nunique"] == 1
    tall = A.tall_stats(W.with_differences(log)).where("column = 'fqid'")
    assert [(r["value"], r["n"]) for r in tall.collect()] == [("fqid_null", 2)]


def test_nearest_quantiles(spark):
    log = events(spark, *[{"room_coor_x": float(x)} for x in (40, 10, 30, 20)])
    row = one(A.quantiles_nearest(log, ["room_coor_x"], ["0.1", "0.2", "0.5", "0.75"]))
    assert [row[f"room_coor_x_qtile_{q}"] for q in ("0_1", "0_2", "0_5", "0_75")] == [10, 20, 30, 30]


def test_span_without_landmark(spark):
    row = one(events(spark, {}, {}).groupBy(*KEYS).agg(*A.span_exprs(LANDMARKS)))
    assert {v for k, v in row.items() if "_span_" in k} == {0.0}


def test_span(spark):
    log = events(spark, {"elapsed_time": 5, "fqid": "logbook.page.bingo"}, {"elapsed_time": 7},
                 {"elapsed_time": 30, "text": "Here's the log book."})
    row = one(log.groupBy(*KEYS).agg(*A.span_exprs(LANDMARKS)))
    assert (row["logbook_bingo_span_elapsed_time"], row["logbook_bingo_span_index"]) == (25.0, 2.0)


@pytest.mark.parametrize("given, want", [([1, 2], [0, 1, 2]), ([1, 2, 3, 4, 5], [3, 4, 5]), ([], [0, 0, 0])])
def test_pad_left(spark, given, want):
    df = spark.createDataFrame([(given,)], "a array<int>")
    assert df.select(R.pad_left(F.col("a"), 3, F.lit(0))).first()[0] == want


def test_label_ids(spark):
    df = L.parse_labels(spark.createDataFrame([("20090312431273200_q14",), ("abc",)], "session_id string"))
    assert [(r["session"], r["level"]) for r in df.collect()] == [(20090312431273200, 14), (None, None)]


def test_question_phases(spark):
    df = L.assign_phase(spark.range(1, 19).select(F.col("id").cast("int").alias("level")))
    got = {r["level"]: r["level_group"] for r in df.collect()}
    assert [k for k, v in got.items() if v == "5-12"] == list(range(4, 14))
    assert got[3] == "0-4" and got[14] == "13-22"


def test_macro_f1_of_one_class(spark):
    s = spark.createDataFrame([(1, 0.9), (1, 0.8)], "y int, p double")
    assert one(M.macro_f1(s, 0.5))["macro_f1"] == 1.0


def test_first_of_tied_thresholds(spark):
    s = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    best = one(M.best_threshold(M.threshold_sweep(s)))
    assert best["threshold"] == 0.0


@pytest.mark.parametrize("strict", [False, True])
def test_grid_position_of_every_threshold(spark, strict):
    grid = [i * M.STEP for i in range(100)]
    near = [x for t in grid for x in (t, math.nextafter(t, 2), math.nextafter(t, -2))] + [-0.5, 1.5]
    df = spark.createDataFrame([(x,) for x in near], "p double")
    got = [r[1] for r in df.select("p", M.thresholds_passed(F.col("p"), strict)).collect()]
    assert got == [sum((x > t) if strict else (x >= t) for t in grid) for x in near]


def test_unique_safe_names():
    assert unique_names(["fqid_a.b c", "fqid_a_b.c", "FQID_A_B_C"]) == ["fqid_a_b_c", "fqid_a_b_c__2", "FQID_A_B_C__3"]
    assert len({word_key(w).lower() for w in WORDS}) == len(WORDS)


def test_missing_phase_keeps_its_place(spark):
    a = events(spark, {"session_id": 1})
    b = events(spark, {"session_id": 1, "level_group": "5-12"}, {"session_id": 2, "level_group": "5-12"})
    by_phase = {p: A.elapsed_basic(x) for p, x in (("0-4", a), ("5-12", b))}
    rows = {r["session_id"]: r for r in carry_forward(by_phase, ["0-4", "5-12"])["5-12"].collect()}
    assert rows[1]["g0_elapsed_sum"] == 0 and rows[2]["g0_elapsed_sum"] is None and rows[2]["g1_elapsed_sum"] == 0


def test_wide_equals_tall(spark):
    log = events(
        spark, {"fqid": "a.b c", "elapsed_time": 1}, {"fqid": "a.b c", "elapsed_time": 5, "hover_duration": 3.0},
        {"fqid": None, "elapsed_time": 6}, {"session_id": 2, "fqid": "z"})
    wide = {r["session_id"]: r for r in session_features(log, "0-4", build_vocab(log)).collect()}
    tall = {(r["session_id"], r["column"], r["value"]): r for r in A.tall_stats(W.with_differences(log)).collect()}
    assert wide[1]["fqid_a_b_c_count"] == tall[1, "fqid", "a.b c"]["n"] == 2
    assert wide[1]["fqid_a_b_c_elapsed_time_diff_sum"] == tall[1, "fqid", "a.b c"]["elapsed_time_diff_sum"] == 4
    assert wide[1]["fqid_z_count"] == 0 and wide[1]["fqid_z_elapsed_time_diff_sum"] is None
    assert wide[1]["fqid_fqid_null_count"] == 1 and wide[2]["fqid_z_count"] == 1
    assert wide[1]["fqid_nunique"] == 2


def test_prune(spark):
    df = spark.createDataFrame(
        [(1, "0-4", 1.0, None, 5.0, 1.0)] + [(i, "0-4", 1.0, None, None, float(i)) for i in range(2, 13)],
        "session_id long, level_group string, same double, empty double, rare double, good double")
    got = {r["feature"]: (r["kept"], r["reason"]) for r in prune_features(df, "0-4").collect()}
    assert got == {"same": (False, "constant"), "empty": (False, "constant"), "rare": (False, "null_ratio"),
                   "good": (True, None)}


def test_encoding(spark):
    vocab = build_vocab(events(spark, {"fqid": "a"}, {"fqid": "b"}))
    log = events(spark, {"fqid": "b"}, {"fqid": None}, {"fqid": "new"})
    ids = [r["id"] for r in encode_columns(log, vocab, {"fqid": "id"}).orderBy("index").collect()]
    assert ids == [2, 3, None]
    ids = [r["id"] for r in encode_columns(log, vocab, {"fqid": "id"}, True).orderBy("index").collect()]
    assert ids == [2, 3, 3]


def test_recency_weights_follow_the_number_of_events(spark):
    out = W.with_recency_weight(events(spark, {}, {}, {}, {}), 50)
    assert [r["weight"] for r in out.orderBy("index").collect()] == [0.25, 0.5, 0.75, 1.0]


def test_balanced_weights(spark):
    labels = spark.createDataFrame([(1,), (1,), (1,), (0,)], "correct int")
    got = {r["correct"]: r["weight"] for r in L.balanced_weights(labels).collect()}
    assert got == {1: pytest.approx(4 / 6), 0: pytest.approx(2.0)}


def test_first_play(spark):
    log = events(spark, *[{"level": v} for v in (0, 1, 2, 0, 1)], *[{"session_id": 2, "level": v} for v in (0, 3)])
    assert W.first_play_only(log).count() == 5


def test_tables_and_arrival_ids(spark, tmp_path):
    log = S.with_arrival_id(events(spark, {"name": "basic"}, {"name": None}, {"text": "a, \"b\""}).drop("event_id"))
    S.write_events(log, f"{tmp_path}/log")
    stored = S.read_table(spark, f"{tmp_path}/log")
    assert stored.select("event_id").distinct().count() == 3
    assert S.read_table(spark, f"{tmp_path}/log", 2).count() == 2
    S.write_csv(stored.drop("event_id").select(*[f.name for f in EVENT_SCHEMA.fields]), f"{tmp_path}/csv")
    assert S.read_events_csv(spark, f"{tmp_path}/csv").schema.names == EVENT_SCHEMA.names
    assert S.read_events_csv(spark, f"{tmp_path}/csv").where("text = 'a, \"b\"'").count() == 1
    assert S.read_events_csv(spark, f"{tmp_path}/csv", 1).count() == 1


def test_standard_csv(spark, tmp_path):
    """Doubled quotes, commas and line breaks in quoted fields, and a row that does not fit the schema."""
    path = f"{tmp_path}/labels.csv"
    with open(path, "w") as f:
        f.write('session_id,correct\n"1_q1",1\n"a ""b"", c\nd_q2",0\n')
    rows = S.read_labels_csv(spark, path, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1_q1", 1), ('a "b", c\nd_q2', 0)]
    with open(path, "w") as f:
        f.write("session_id,correct\n1_q1,1\n1_q2,yes\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_labels_csv(spark, path).collect()
    rejected = S.read_labels_csv(spark, path, mode="REJECTS").collect()
    assert [r[S.REJECTED] for r in rejected] == [None, "1_q2,yes"]


def test_scores_of_a_scope_are_replaced(spark, tmp_path):
    for score in (0.5, 0.6):
        S.append_scores(spark.createDataFrame([("a", 0.1, score)], "scope string, threshold double, score double"), f"{tmp_path}/scores")
    S.append_scores(spark.createDataFrame([("b", 3, 0.1, 0.2)], "scope string, level int, threshold double, score double"), f"{tmp_path}/scores")
    rows = S.read_table(spark, f"{tmp_path}/scores").select("scope", "level", "score").orderBy("scope").collect()
    assert [tuple(r) for r in rows] == [("a", None, 0.6), ("b", 3, 0.2)]


def test_two_predictions_for_one_key_are_an_error(spark):
    twice = spark.createDataFrame([(1, "m", 0.1), (1, "m", 0.2)], "id int, model string, p double")
    with pytest.raises(Exception, match="two predictions"):
        L.align_models(twice, ["m"], ["id"]).collect()


def test_weights_come_from_the_rows_of_the_fit(spark):
    rows = spark.createDataFrame([(1,), (1,), (1,), (0,)], "correct int")
    got = {r["correct"]: r["weight"] for r in L.weight_of_class(rows).collect()}
    assert got == {1: pytest.approx(4 / 6), 0: pytest.approx(2.0)}


def test_whole_words(spark):
    df = spark.createDataFrame([("this",), ("it is",)], "text string")
    assert [r[0] for r in df.select(C.has_word(F.col("text"), "is")).collect()] == [True, True]
    assert [r[0] for r in df.select(C.has_word(F.col("text"), "is", True)).collect()] == [False, True]


def test_empty_sum_option(spark):
    d = W.with_differences(events(spark, {"text": "none of them"}))
    assert one(A.flat_stats(d))["word_sum_flag"] is None
    assert one(A.flat_stats(d, empty_sum_zero=True))["word_sum_flag"] == 0
