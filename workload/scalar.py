"""Queries for sources, sinks, projections and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from playtrace.functions import columns as C
from playtrace.operators import labels as L
from playtrace.operators import metrics as M
from playtrace.operators.features import (
    features_long, kept_features, prune_features, select_features, to_float32,
)
from playtrace.operators.sessions import reversal_flag, with_differences
from playtrace.operators.stats import elapsed_basic, numeric_exprs
from playtrace.operators.vocab import build_vocab, encode_columns
from playtrace.schema import ALL_NULL_COLUMNS, EVENT_SCHEMA, KEYS, PHASE, PHASES, SESSION
from playtrace.sources import tables as S
from playtrace.sources.storage import shared_root
from workload.inputs import event_log, parsed_labels, question_labels, scores, scores_long, table
from workload.registry import (
    DIFFS, FOLDS, GLOG, GRID, LABELS, QLABELS, SCORES, SCORES_LONG, VOCAB, category_sql, query, r, rounded,
    sweep_sql,
)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a written table, under the folder that driver and executors share."""
    return f"{shared_root(spark)}/tables-{uuid.uuid4().hex}/{name}"


EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
_EVENTS_SQL = GLOG + "SELECT " + ", ".join(f'"{c}"' for c in EVENT_COLUMNS) + " FROM glog"


@query("scan_csv", _EVENTS_SQL)
def scan_csv(spark, sf):
    path = scratch(spark, "events_csv")
    S.write_csv(event_log(spark, sf)[0].select(*EVENT_COLUMNS), path)
    return S.read_events_csv(spark, path)


@query("scan_labels_csv", QLABELS)
def scan_labels_csv(spark, sf):
    path = scratch(spark, "labels_csv")
    S.write_csv(question_labels(spark, sf), path)
    return S.read_labels_csv(spark, path)


@query("sink_parquet", _EVENTS_SQL)
def sink_parquet(spark, sf):
    path = scratch(spark, "events")
    S.write_events(event_log(spark, sf)[0].select(*EVENT_COLUMNS), path)
    return S.read_table(spark, path)


@query("scan_parquet", "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events")
def scan_parquet(spark, sf):
    log = S.read_table(spark, f"{sf}/events.parquet")
    return log.select("event_id", F.expr("unix_micros(CAST(ts AS TIMESTAMP))").alias("ts_us"), "user_id", "event_type", "value", "props")


@query("sink_labels_by_group", "WITH " + LABELS + "SELECT * FROM lab WHERE level_group = '5-12'")
def sink_labels_by_group(spark, sf):
    path = scratch(spark, "labels")
    S.write_labels_by_phase(parsed_labels(spark, sf), path)
    return S.read_table(spark, path).where(F.col(PHASE) == "5-12")


@query("sink_folds", "WITH " + LABELS + FOLDS
       + "SELECT session, level, correct, fold, CASE WHEN fold = 0 THEN 'valid' ELSE 'train' END AS part"
         " FROM lab JOIN folds USING (session)")
def sink_folds(spark, sf):
    path = scratch(spark, "folds")
    labels = parsed_labels(spark, sf)
    S.write_folds(L.with_folds(labels, L.group_folds(labels)), path)
    train, valid = L.fold_split(S.read_table(spark, path), 0)
    both = train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))
    return both.select("session", "level", "correct", "fold", "part")


_BASIC = ("SELECT session_id, level_group, CAST(sum(elapsed_time) AS BIGINT) AS elapsed_sum, "
          + r("avg(elapsed_time)", "elapsed_mean")
          + ", max(elapsed_time) AS elapsed_max, min(elapsed_time) AS elapsed_min"
            " FROM glog GROUP BY session_id, level_group")


@query("sink_features", GLOG + _BASIC)
def sink_features(spark, sf):
    path = scratch(spark, "features")
    S.write_features(elapsed_basic(event_log(spark, sf)[0]), path)
    return rounded(S.read_table(spark, path))


@query("sink_vocab", GLOG + VOCAB + "SELECT * FROM vocab")
def sink_vocab(spark, sf):
    path = scratch(spark, "vocab")
    S.write_vocab(build_vocab(event_log(spark, sf)[0]), path)
    return S.read_table(spark, path)


NUMERIC = ["elapsed_time_diff", "hover_duration", "room_coor_x", "room_coor_y", "screen_coor_x", "screen_coor_y",
           "location_x_diff", "location_y_diff"]
#: Per-session numeric statistics as one row per feature, plus two columns that pruning must find.
NUMERIC_LONG = DIFFS + ", nl AS (" + " UNION ALL ".join(
    f"SELECT session_id, level_group, '{c}_{name}' AS feature, CAST({fn}({c}) AS DOUBLE) AS value"
    f" FROM d GROUP BY session_id, level_group"
    for c in NUMERIC for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("sum", "sum"))
) + """
  UNION ALL SELECT session_id, level_group, 'zero' AS feature, 0.0e0 AS value FROM d GROUP BY session_id, level_group
  UNION ALL SELECT session_id, level_group, 'empty' AS feature, CAST(sum(hq) AS DOUBLE) AS value
    FROM d GROUP BY session_id, level_group)
, catalog AS (SELECT level_group, feature, CASE
    WHEN count(value) = 0 OR (count(value) = count(*) AND min(value) = max(value)) THEN 'constant'
    WHEN 1.0e0 - count(value)*1.0e0/count(*) > 0.9 THEN 'null_ratio' END AS reason
  FROM nl GROUP BY level_group, feature)
"""


def numeric_features(spark, sf, phase):
    log, hot = event_log(spark, sf)
    d = with_differences(log.where(F.col(PHASE) == phase), hot)
    return d.groupBy(*KEYS).agg(*numeric_exprs(), F.sum(F.lit(0.0)).alias("zero"), F.sum("hq").alias("empty"))


@query("sink_feature_catalog", GLOG + NUMERIC_LONG
       + "SELECT level_group, feature, feature AS original, reason IS NULL AS kept, reason FROM catalog")
def sink_feature_catalog(spark, sf):
    path = scratch(spark, "catalog")
    parts = [prune_features(numeric_features(spark, sf, p), p) for p in PHASES]
    S.write_catalog(parts[0].unionByName(parts[1]).unionByName(parts[2]), path)
    return S.read_table(spark, path).select(PHASE, "feature", "original", "kept", "reason")


@query("sink_oof", "WITH " + SCORES + SCORES_LONG + "SELECT id, level, fold, model, y, " + r("p", "p", 9) + " FROM sl")
def sink_oof(spark, sf):
    path = scratch(spark, "oof")
    S.write_oof(scores_long(spark, sf), path)
    out = S.read_table(spark, path)
    return rounded(out.select("id", "level", F.col("fold").cast("long").alias("fold"), "model", "y", "p"), 9)


@query("sink_scores", "WITH " + SCORES + SCORES_LONG + GRID + sweep_sql("model", "sl", "p")
       + ", best AS (SELECT model, max(score) AS score FROM sw GROUP BY model)"
         " SELECT sw.model AS scope, CAST(NULL AS INT) AS level, " + r("min(t)", "threshold", 9) + ", " + r("sw.score", "score", 9)
       + " FROM sw JOIN best ON sw.model = best.model AND sw.score = best.score GROUP BY sw.model, sw.score")
def sink_scores(spark, sf):
    path = scratch(spark, "scores")
    best = M.best_threshold(M.threshold_sweep(scores_long(spark, sf), ["model"]), ["model"])
    scores_of_models = best.select(F.col("model").alias("scope"), "threshold", "score")
    S.append_scores(scores_of_models, path)
    S.append_scores(scores_of_models, path)  # a run that is repeated replaces its scores
    return rounded(S.read_table(spark, path), 9)


# Projections and scalar functions.

@query("drop_cols", GLOG + "SELECT * EXCLUDE (fullscreen, hq, music) FROM glog")
def drop_cols(spark, sf):
    return event_log(spark, sf)[0].drop(*ALL_NULL_COLUMNS)


@query("cast_category", GLOG
       + "SELECT event_id, CAST(level AS VARCHAR) AS level, CAST(page AS VARCHAR) AS page FROM glog")
def cast_category(spark, sf):
    return event_log(spark, sf)[0].select(
        "event_id", F.col("level").cast("string").alias("level"), F.col("page").cast("string").alias("page"))


_TOKEN_COLUMNS = ["page", "event_name", "name", "text", "fqid", "room_fqid", "text_fqid"]


@query("fill_null_token", GLOG + "SELECT event_id, " + ", ".join(f"{category_sql(c)} AS {c}" for c in _TOKEN_COLUMNS)
       + " FROM glog")
def fill_null_token(spark, sf):
    return event_log(spark, sf)[0].select("event_id", *[C.category(c).alias(c) for c in _TOKEN_COLUMNS])


@query("parse_labels", "WITH " + LABELS + "SELECT session_id, correct, session, level FROM lab")
def parse_labels(spark, sf):
    return L.parse_labels(question_labels(spark, sf))


@query("bucket_level_group", "WITH " + LABELS + "SELECT session, level, level_group FROM lab")
def bucket_level_group(spark, sf):
    return parsed_labels(spark, sf).select("session", "level", PHASE)


@query("filter_group", GLOG + "SELECT session_id, event_id, level FROM glog WHERE level_group = '5-12'")
def filter_group(spark, sf):
    return event_log(spark, sf)[0].where(F.col(PHASE) == "5-12").select(SESSION, "event_id", "level")


@query("filter_level", "WITH " + LABELS + "SELECT session, correct FROM lab WHERE level = 4")
def filter_level(spark, sf):
    return parsed_labels(spark, sf).where(F.col("level") == 4).select("session", "correct")


_TEXT_WORDS = ["that", "this", "it", "you", "find", "found", "Found", "notebook", "Wells", "wells", "help",
               "need", "Oh", "Ooh", "Jo", "flag", "can", "and", "is", "the", "to"]


def _word_column(word: str) -> str:
    return f"has_{word.lower()}" + ("" if word == word.lower() else "_cap")


@query("text_contains", "SELECT conv_id, turn, "
       + ", ".join(f"contains(text, '{w}') AS {_word_column(w)}" for w in _TEXT_WORDS) + " FROM conversations")
def text_contains(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", *[C.has_word(F.col("text"), w).alias(_word_column(w)) for w in _TEXT_WORDS])


_MARKS = {
    "logbook_bingo": "text = 'Here''s the log book.' OR fqid = 'logbook.page.bingo'",
    "reader_bingo": "(event_name = 'navigate_click' AND fqid = 'reader') OR fqid = 'reader.paper2.bingo'",
    "journals_bingo": "(event_name = 'navigate_click' AND fqid = 'journals') OR fqid = 'journals.pic_2.bingo'",
    "reader_flag": "(event_name = 'navigate_click' AND fqid = 'reader_flag')"
                   " OR fqid = 'tunic.library.microfiche.reader_flag.paper2.bingo'",
    "journals_flag": "(event_name = 'navigate_click' AND fqid = 'journals_flag') OR fqid = 'journals_flag.pic_0.bingo'",
}


@query("landmark_predicate", GLOG + "SELECT event_id, "
       + ", ".join(f"coalesce({p}, false) AS {m}" for m, p in _MARKS.items()) + " FROM glog")
def landmark_predicate(spark, sf):
    return event_log(spark, sf)[0].select("event_id", *[C.landmark(m).alias(m) for m in _MARKS])


@query("clip", GLOG + """SELECT event_id, least(greatest(elapsed_time, 0), 3600000) AS elapsed_clipped,
  CASE WHEN room_coor_x IS NOT NULL THEN least(greatest(room_coor_x, -100.0e0), 100.0e0) END AS room_clipped,
  least(greatest(elapsed_time, 0), 10000000)/10000.0e0 AS elapsed_scaled FROM glog""")
def clip(spark, sf):
    t = F.col("elapsed_time")
    return event_log(spark, sf)[0].select(
        "event_id", C.bounded(t, 0, 3_600_000).alias("elapsed_clipped"),
        C.bounded(F.col("room_coor_x"), -100.0, 100.0).alias("room_clipped"),
        (C.bounded(t, 0, 10_000_000) / 10000.0).alias("elapsed_scaled"))


@query("abs_value", GLOG + "SELECT event_id, " + r("abs(room_coor_x)", "abs_x") + " FROM glog")
def abs_value(spark, sf):
    return rounded(event_log(spark, sf)[0].select("event_id", F.abs("room_coor_x").alias("abs_x")))


@query("split_parts", GLOG + "SELECT event_id, " + ", ".join(
    f"nullif(split_part(room_fqid, '.', {i + 1}), '') AS room_fqid_{i}" for i in range(3)) + " FROM glog")
def split_parts(spark, sf):
    parts = C.dotted_parts(F.col("room_fqid"), 3)
    return event_log(spark, sf)[0].select("event_id", *[p.alias(f"room_fqid_{i}") for i, p in enumerate(parts)])


@query("make_key", GLOG + "SELECT event_id, concat(CAST(session_id AS VARCHAR), '_q', CAST(level AS VARCHAR))"
                          " AS session_q_id FROM glog")
def make_key(spark, sf):
    return event_log(spark, sf)[0].select(
        "event_id", C.question_key(F.col(SESSION), F.col("level")).alias("session_q_id"))


@query("split_key", "WITH " + LABELS + "SELECT session_id AS session_q_id, CAST(session AS VARCHAR) AS session_id,"
                                       " level FROM lab")
def split_key(spark, sf):
    labels = question_labels(spark, sf)
    return labels.select(
        F.col("session_id").alias("session_q_id"), F.get(F.split("session_id", "_"), 0).alias("session_id"),
        C.label_question(F.col("session_id")).alias("level"))


_ENCODED = ["event_name", "level", "fqid", "room_fqid"]


@query("encode_category", GLOG + VOCAB + ", sz AS (SELECT level_group, \"column\", CAST(count(*) AS INT) AS size FROM vocab"
       " GROUP BY level_group, \"column\") SELECT g.event_id, "
       + ", ".join(f"CASE WHEN g.{c} IS NULL THEN s{i}.size + 1 ELSE v{i}.pos + 1 END AS {c}_id"
                   for i, c in enumerate(_ENCODED))
       + " FROM glog g " + " ".join(
           f"LEFT JOIN vocab v{i} ON v{i}.level_group = g.level_group AND v{i}.\"column\" = '{c}'"
           f" AND v{i}.value = CAST(g.{c} AS VARCHAR)"
           f" LEFT JOIN sz s{i} ON s{i}.level_group = g.level_group AND s{i}.\"column\" = '{c}'"
           for i, c in enumerate(_ENCODED)))
def encode_category(spark, sf):
    log = event_log(spark, sf)[0]
    path = scratch(spark, "vocab")
    S.write_vocab(build_vocab(log), path)
    vocab = S.read_table(spark, path)
    return encode_columns(log, vocab, {c: f"{c}_id" for c in _ENCODED}).select("event_id", *[f"{c}_id" for c in _ENCODED])


@query("cast_float32", GLOG + NUMERIC_LONG + "SELECT session_id, level_group, feature, " + r("CAST(CAST(value AS FLOAT) AS DOUBLE)", "value", 3)
       + " FROM nl WHERE value IS NOT NULL")
def cast_float32(spark, sf):
    """The numeric feature matrix in single precision."""
    parts = [features_long(to_float32(numeric_features(spark, sf, p))) for p in PHASES]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 3)


@query("nan_fill", GLOG + "SELECT event_id, CASE WHEN k % 9 = 0 THEN -1.0e0 ELSE page END AS page FROM glog")
def nan_fill(spark, sf):
    page = F.when(F.col("k") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("page"))
    return event_log(spark, sf)[0].select("event_id", C.nan_to(page).alias("page"))


@query("flag_when", GLOG + """, f AS (SELECT event_id, level,
    lag(level) OVER (PARTITION BY session_id ORDER BY "index", elapsed_time, event_id) AS p FROM glog)
SELECT event_id, CASE WHEN level < p THEN 'reversed' ELSE 'not_reversed' END AS is_reversed FROM f""")
def flag_when(spark, sf):
    log, hot = event_log(spark, sf)
    return reversal_flag(log, hot).select("event_id", "is_reversed")


@query("binarize", "WITH " + SCORES + "SELECT id, CASE WHEN p1 >= 0.63e0 THEN 1 ELSE 0 END AS hit FROM s")
def binarize(spark, sf):
    return scores(spark, sf).select("id", C.at_threshold(F.col("p1"), 0.63).alias("hit"))


@query("select_features", GLOG + NUMERIC_LONG + "SELECT session_id, nl.level_group, nl.feature, "
       + r("value", "value", 3) + " FROM nl JOIN catalog c ON c.level_group = nl.level_group AND c.feature = nl.feature"
       " WHERE reason IS NULL AND value IS NOT NULL")
def select_features_query(spark, sf):
    parts = []
    for phase in PHASES:
        features = numeric_features(spark, sf, phase)
        kept = kept_features(prune_features(features, phase), phase)
        parts.append(features_long(select_features(features, kept)))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 3)


@query("rename", GLOG + "SELECT session_id AS sid, level AS game_level, event_id FROM glog")
def rename(spark, sf):
    return (event_log(spark, sf)[0].select(SESSION, "level", "event_id")
            .withColumnsRenamed({SESSION: "sid", "level": "game_level"}))


@query("sigmoid", "WITH " + SCORES + "SELECT id, " + r("1.0e0/(1.0e0+exp(-(4*p1-2)))", "p", 9) + " FROM s")
def sigmoid(spark, sf):
    return rounded(scores(spark, sf).select("id", C.sigmoid(4 * F.col("p1") - 2).alias("p")), 9)


@query("balanced_weight", "WITH " + LABELS + "SELECT session, level, correct, "
       + r("(SELECT count(*) FROM lab)*1.0e0/((SELECT count(DISTINCT correct) FROM lab)"
           "*count(*) OVER (PARTITION BY correct))", "weight", 9) + " FROM lab")
def balanced_weight(spark, sf):
    labels = parsed_labels(spark, sf).select("session", "level", "correct")
    return rounded(L.balanced_weights(labels), 9)
