"""Queries for joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from playtrace.operators import labels as L
from playtrace.operators import metrics as M
from playtrace.operators import profile as P
from playtrace.operators import sessions as W
from playtrace.operators import sketches as K
from playtrace.operators import sparse as B
from playtrace.operators import stats as A
from playtrace.operators.features import (
    as_arrays, carry_forward, feature_columns, features_long, session_features, stat_names, wide_values,
)
from playtrace.operators.modelsel import mean_importance, top_half
from playtrace.operators.vocab import build_vocab, encode_columns
from playtrace.plans.skew import bounded_broadcast
from playtrace.schema import EVENT_SCHEMA, KEYS, LANDMARKS, PHASE, PHASES, SESSION, word_key
from playtrace.sources import tables as S
from workload.inputs import event_log, parsed_labels, question_labels, scores, scores_long, table
from workload.registry import (
    DIFFS, GLOG, GRID, LABELS, MACRO_F1, QLABELS, SCORES, SQL, SCORES_LONG, TALL, VOCAB, VOCAB_COLUMNS, category_sql, cells,
    glog, melt_sql, query, r, rounded, sweep_sql,
)
from workload.scalar import NUMERIC, NUMERIC_LONG, scratch

SG = "session_id, level_group"
WORDS = ["that", "this", "it", "you", "find", "found", "Found", "notebook", "Wells", "wells", "help",
         "need", "Oh", "Ooh", "Jo", "flag", "can", "and", "is", "the", "to"]


def diffed(spark, sf, variant="plain"):
    log, hot = event_log(spark, sf, variant)
    return W.with_differences(log, hot), hot


def stored_vocab(spark, log, by_phase=True):
    """The vocabulary as a table written once, as feature builds read it."""
    path = scratch(spark, "vocab")
    S.write_vocab(build_vocab(log, by_phase=by_phase), path)
    return S.read_table(spark, path)


# Joins.

@query("join_label_features", "WITH " + LABELS + GLOG.replace("WITH e AS", ", e AS", 1)
       + ", f AS (SELECT session_id AS session, level_group, count(*) AS nrows, CAST(sum(elapsed_time) AS BIGINT) AS elapsed_time_sum"
         " FROM glog GROUP BY session_id, level_group)"
         " SELECT lab.session, level, level_group, correct, nrows, elapsed_time_sum FROM lab JOIN f USING (session, level_group)")
def join_label_features(spark, sf):
    log, _ = event_log(spark, sf)
    features = log.groupBy(*KEYS).agg(
        F.count("index").alias("nrows"), F.sum("elapsed_time").alias("elapsed_time_sum"))
    out = L.join_features(parsed_labels(spark, sf), features, strict=True)
    return out.select("session", "level", PHASE, "correct", "nrows", "elapsed_time_sum")


@query("left_join_sequences", "WITH " + LABELS + glog("missing_phase").replace("WITH e AS", ", e AS", 1)
       + """, seq AS (SELECT session_id, level_group,
    array_to_string(list(CAST(level AS VARCHAR) ORDER BY "index", elapsed_time, event_id), ',') AS levels
    FROM glog GROUP BY session_id, level_group)
, ll AS (SELECT session AS session_id, level_group, array_to_string(list(CAST(correct AS VARCHAR) ORDER BY level), ',') AS correct
    FROM lab GROUP BY session, level_group)
SELECT ll.session_id, ll.level_group, correct, levels
FROM ll LEFT JOIN seq ON ll.session_id = seq.session_id AND ll.level_group = seq.level_group""")
def left_join_sequences(spark, sf):
    log, _ = event_log(spark, sf, "missing_phase")
    lists = W.session_sequences(log, ["level"], KEYS)
    labels = L.label_lists(parsed_labels(spark, sf), [PHASE])
    return labels.join(lists, KEYS, "left").select(
        *KEYS, F.array_join("correct", ",").alias("correct"), F.array_join("level", ",").alias("levels"))


_BASIC = ["elapsed_sum", "elapsed_mean", "elapsed_max", "elapsed_min"]


@query("carry_forward", glog("missing_phase") + ", f AS (SELECT session_id, level_group, CAST(sum(elapsed_time) AS BIGINT) AS elapsed_sum,"
       " avg(elapsed_time) AS elapsed_mean, max(elapsed_time) AS elapsed_max, min(elapsed_time) AS elapsed_min"
       " FROM glog GROUP BY session_id, level_group) SELECT f2.session_id, "
       + ", ".join(f"{'round(' if c.endswith('mean') else ''}f{g}.{c}{', 4) + 0.0' if c.endswith('mean') else ''} AS g{g}_{c}"
                   for g in range(3) for c in _BASIC)
       + " FROM (SELECT * FROM f WHERE level_group='13-22') f2"
         " LEFT JOIN (SELECT * FROM f WHERE level_group='0-4') f0 ON f0.session_id = f2.session_id"
         " LEFT JOIN (SELECT * FROM f WHERE level_group='5-12') f1 ON f1.session_id = f2.session_id")
def carry_forward_query(spark, sf):
    log, _ = event_log(spark, sf, "missing_phase")
    by_phase = {p: A.elapsed_basic(log.where(F.col(PHASE) == p)) for p in PHASES}
    return rounded(carry_forward(by_phase)["13-22"])


@query("semi_join_sample", GLOG + "SELECT session_id, event_id FROM glog WHERE session_id IN"
       " (SELECT session_id FROM glog GROUP BY session_id HAVING count(*) >= 65)")
def semi_join_sample(spark, sf):
    log, _ = event_log(spark, sf)
    long_sessions = log.groupBy(SESSION).count().where("count >= 65")
    return L.sample_sessions(log, long_sessions).select(SESSION, "event_id")


_DUP = glog("duplicated") + ", c AS (SELECT *, count(*) OVER (PARTITION BY session_id, \"index\") AS n FROM glog)"


@query("anti_join_duplicates", _DUP + " SELECT session_id, \"index\", event_id FROM c WHERE session_id NOT IN"
       " (SELECT session_id FROM c WHERE n > 1)")
def anti_join_duplicates(spark, sf):
    log, _ = event_log(spark, sf, "duplicated")
    return W.drop_sessions_with_duplicates(log).select(SESSION, "index", "event_id")


@query("align_models", "WITH " + SCORES + "SELECT id, level, fold, y, " + ", ".join(r(f"p{i}", f"p{i}", 9) for i in (1, 2, 3, 4))
       + " FROM s")
def align_models(spark, sf):
    return rounded(L.align_models(scores_long(spark, sf), ["p1", "p2", "p3", "p4"], ["id", "level", "fold", "y"]), 9)


@query("broadcast_vocab", GLOG + VOCAB + "SELECT g.event_id, g.room_fqid, v.pos + 1 AS room_id FROM glog g"
       " LEFT JOIN vocab v ON v.level_group = g.level_group AND v.\"column\" = 'room_fqid' AND v.value = g.room_fqid")
def broadcast_vocab(spark, sf):
    log, _ = event_log(spark, sf)
    return encode_columns(log, stored_vocab(spark, log), {"room_fqid": "room_id"}).select("event_id", "room_fqid", "room_id")


@query("session_group_grid", GLOG + "SELECT s.session_id, g.step, g.level_group FROM (SELECT DISTINCT session_id FROM glog) s"
       " CROSS JOIN (VALUES (0, '0-4'), (1, '5-12'), (2, '13-22')) g(step, level_group)")
def session_group_grid(spark, sf):
    return L.session_phase_grid(event_log(spark, sf)[0], PHASES)


# Aggregations for features.

@query("agg_nrows", GLOG + f"SELECT {SG}, count(\"index\") AS nrows FROM glog GROUP BY {SG}")
def agg_nrows(spark, sf):
    return event_log(spark, sf)[0].groupBy(*KEYS).agg(F.count("index").alias("nrows"))


@query("agg_word_count", "SELECT conv_id, " + ", ".join(
    f"count(*) FILTER (contains(text, '{w}')) AS word_{word_key(w)}" for w in WORDS) + " FROM conversations GROUP BY conv_id")
def agg_word_count(spark, sf):
    return table(spark, sf, "conversations").groupBy("conv_id").agg(*A.word_count_exprs())


def word_time_sql(w: str) -> list[str]:
    k, f = word_key(w), f"FILTER (contains(text, '{w}'))"
    return [r(f"avg(elapsed_time_diff) {f}", f"word_mean_{k}", 3), r(f"stddev_samp(elapsed_time_diff) {f}", f"word_std_{k}", 3),
            f"max(elapsed_time_diff) {f} AS word_max_{k}", f"CAST(sum(elapsed_time_diff) {f} AS BIGINT) AS word_sum_{k}",
            r(f"median(elapsed_time_diff) {f}", f"word_median_{k}", 3)]


@query("agg_word_time", GLOG + DIFFS + f"SELECT {SG}, " + ", ".join(x for w in WORDS for x in word_time_sql(w))
       + f" FROM d GROUP BY {SG}")
def agg_word_time(spark, sf):
    d, hot = diffed(spark, sf)
    return rounded(A.word_times(d, hot=hot), 3)


@query("agg_nunique", GLOG + f"SELECT {SG}, " + ", ".join(
    f"count(DISTINCT {category_sql(c)}) AS {c}_nunique" for c in ["event_name", "fqid", "room_fqid", "text"])
       + f" FROM glog GROUP BY {SG}")
def agg_nunique(spark, sf):
    return A.nunique(event_log(spark, sf)[0])


@query("agg_category_count", GLOG + DIFFS + TALL + f"SELECT {SG}, \"column\", value, n FROM tall")
def agg_category_count(spark, sf):
    d, _ = diffed(spark, sf)
    return A.tall_stats(d, metrics=[])


_STATS = [f"{m}_{s}" for m in ("elapsed_time_diff", "hover_duration") for s in ("sum", "mean", "std", "max", "min")]


@query("agg_category_stats", GLOG + DIFFS + TALL + f"SELECT {SG}, \"column\", value, n, "
       + ", ".join(r(f"CAST({s} AS DOUBLE)", s, 3) for s in _STATS) + " FROM tall")
def agg_category_stats(spark, sf):
    d, _ = diffed(spark, sf)
    return rounded(A.tall_stats(d), 3)


@query("agg_elapsed_sum", GLOG + f"SELECT {SG}, CAST(sum(elapsed_time) AS BIGINT) AS elapsed_time_sum FROM glog GROUP BY {SG}")
def agg_elapsed_sum(spark, sf):
    return event_log(spark, sf)[0].groupBy(*KEYS).agg(F.sum("elapsed_time").alias("elapsed_time_sum"))


@query("agg_numeric_stats", GLOG + DIFFS + f"SELECT {SG}, " + ", ".join(
    x for c in NUMERIC for x in (
        r(f"avg({c})", f"{c}_mean", 3), r(f"stddev_samp({c})", f"{c}_std", 3), r(f"CAST(sum({c}) AS DOUBLE)", f"{c}_sum", 3)))
       + f" FROM d GROUP BY {SG}")
def agg_numeric_stats(spark, sf):
    d, _ = diffed(spark, sf)
    out = d.groupBy(*KEYS).agg(*A.numeric_exprs())
    return rounded(out.withColumn("elapsed_time_diff_sum", F.col("elapsed_time_diff_sum").cast("double")), 3)


def quantile_sql(c: str, q: str) -> str:
    return (f"(list({c} ORDER BY {c}) FILTER ({c} IS NOT NULL))"
            f"[1 + CAST(round({q} * (count({c}) - 1)) AS INT)]")


QS = ["0.1", "0.2", "0.5", "0.75"]


def q_name(c: str, q: str) -> str:
    return f"{c}_qtile_{q.replace('.', '_')}"


@query("agg_quantile_nearest", GLOG + DIFFS + f"SELECT {SG}, " + ", ".join(
    r(f"CAST({quantile_sql(c, q)} AS DOUBLE)", q_name(c, q)) for c in NUMERIC for q in QS) + f" FROM d GROUP BY {SG}")
def agg_quantile_nearest(spark, sf):
    d, hot = diffed(spark, sf)
    out = A.quantiles_nearest(d, hot=hot)
    return rounded(out.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in out.columns[2:]]))


_MARK_SQL = {
    "logbook_bingo": "(text = 'Here''s the log book.' OR fqid = 'logbook.page.bingo')",
    "reader_bingo": "((event_name = 'navigate_click' AND fqid = 'reader') OR fqid = 'reader.paper2.bingo')",
    "journals_bingo": "((event_name = 'navigate_click' AND fqid = 'journals') OR fqid = 'journals.pic_2.bingo')",
    "reader_flag": "((event_name = 'navigate_click' AND fqid = 'reader_flag')"
                   " OR fqid = 'tunic.library.microfiche.reader_flag.paper2.bingo')",
    "journals_flag": "((event_name = 'navigate_click' AND fqid = 'journals_flag') OR fqid = 'journals_flag.pic_0.bingo')",
}
_MARK_PHASE = {"logbook_bingo": "5-12", "reader_bingo": "5-12", "journals_bingo": "5-12",
               "reader_flag": "13-22", "journals_flag": "13-22"}


def span_sql(m: str, c: str) -> str:
    col = f'"{c}"'
    return f"coalesce(CAST(max({col}) FILTER {_MARK_SQL[m].join(['(', ')'])} - min({col}) FILTER {_MARK_SQL[m].join(['(', ')'])} AS DOUBLE), 0.0e0)"


@query("agg_sketches", GLOG + DIFFS + " SELECT session_id, level_group, true AS quantiles, true AS distinct_counts FROM d GROUP BY session_id, level_group")
def agg_sketches(spark, sf):
    """Quantiles and distinct counts of each session and phase from sketches stored by a third key and merged, against the exact ones."""
    d, hot = diffed(spark, sf)
    parts = K.sketches(d.withColumn("_part", F.pmod(F.col("event_id"), F.lit(4))), keys=[*KEYS, "_part"])
    path = scratch(spark, "sketches")
    S.write_table(parts, path)
    near = K.approximate(K.merged(S.read_table(spark, path)))
    ranks = d.join(near.select(*KEYS, "elapsed_time_diff_qtile_0_5"), KEYS).groupBy(*KEYS).agg(
        (F.count_if(F.col("elapsed_time_diff") <= F.col("elapsed_time_diff_qtile_0_5")) / F.count("elapsed_time_diff")).alias("upto"),
        (F.count_if(F.col("elapsed_time_diff") < F.col("elapsed_time_diff_qtile_0_5")) / F.count("elapsed_time_diff")).alias("below"))
    exact = A.nunique(d).withColumnsRenamed({f"{c}_nunique": f"_{c}" for c in ("event_name", "fqid", "room_fqid", "text")})
    close = F.lit(True)
    for c in ("event_name", "fqid", "room_fqid", "text"):
        close = close & (F.abs(F.col(f"{c}_nunique") / F.col(f"_{c}") - 1) < 0.1)
    out = near.join(ranks, KEYS).join(exact, KEYS)
    middle = F.coalesce((F.col("upto") > 0.45) & (F.col("below") < 0.55), F.col("elapsed_time_diff_qtile_0_5").isNull())
    return out.select(*KEYS, middle.alias("quantiles"), close.alias("distinct_counts"))


@query("agg_landmark_span", GLOG + f"SELECT {SG}, " + ", ".join(
    f"{span_sql(m, c)} AS {m}_span_{c}" for m in _MARK_SQL for c in ("elapsed_time", "index")) + f" FROM glog GROUP BY {SG}")
def agg_landmark_span(spark, sf):
    return event_log(spark, sf)[0].groupBy(*KEYS).agg(*A.span_exprs(LANDMARKS))


@query("vocab_by_group", GLOG + VOCAB + "SELECT * FROM vocab")
def vocab_by_group(spark, sf):
    return build_vocab(event_log(spark, sf)[0])


@query("vocab_global", GLOG + ", vals AS (SELECT DISTINCT * FROM ("
       + melt_sql("glog", "1 AS one", VOCAB_COLUMNS, lambda c: f"CAST({c} AS VARCHAR)")
       + ") WHERE value IS NOT NULL) SELECT \"column\", value,"
         " CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1 AS INT) AS pos FROM vals")
def vocab_global(spark, sf):
    return build_vocab(event_log(spark, sf)[0], by_phase=False)


# Profiles.

_ALL = ["session_id", "index", "elapsed_time", "event_name", "name", "level", "page", "room_coor_x", "room_coor_y",
        "screen_coor_x", "screen_coor_y", "hover_duration", "text", "fqid", "room_fqid", "text_fqid", "fullscreen", "hq",
        "music", "level_group"]


@query("null_ratio", GLOG + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r(f'avg(CASE WHEN \"{c}\" IS NULL THEN 1.0e0 ELSE 0.0e0 END)', 'null_ratio', 9)},"
    f" avg(CASE WHEN \"{c}\" IS NULL THEN 1.0e0 ELSE 0.0e0 END) > 0.9 AS mostly_null FROM glog" for c in _ALL))
def null_ratio(spark, sf):
    return rounded(P.null_ratio(event_log(spark, sf)[0], _ALL), 9)


@query("constant_columns", GLOG + ", c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT \"{c}\") + CASE WHEN count(\"{c}\") < count(*) THEN 1 ELSE 0 END AS n FROM glog"
    for c in [*_ALL, "event_id"]) + ") SELECT \"column\" FROM c WHERE n = 1")
def constant_columns(spark, sf):
    return P.constant_columns(event_log(spark, sf)[0], [*_ALL, "event_id"])


@query("collect_sequence", GLOG + "SELECT session_id,"
       " array_to_string(list(event_name ORDER BY \"index\", elapsed_time, event_id), ',') AS event_name,"
       " array_to_string(list(CAST(level AS VARCHAR) ORDER BY \"index\", elapsed_time, event_id), ',') AS level"
       " FROM glog GROUP BY session_id")
def collect_sequence(spark, sf):
    out = W.session_sequences(event_log(spark, sf)[0], ["event_name", "level"])
    return out.select(SESSION, F.array_join("event_name", ",").alias("event_name"),
                      F.array_join("level", ",").alias("level"))


@query("nunique_sessions", GLOG + "SELECT level_group, level, count(DISTINCT session_id) AS n_sessions, count(*) AS n_rows"
       " FROM glog GROUP BY level_group, level")
def nunique_sessions(spark, sf):
    return P.nunique_sessions(event_log(spark, sf)[0], [PHASE, "level"])


@query("value_counts", GLOG + "SELECT level_group, page, count(*) AS n, "
       + r("count(*)*1.0e0/sum(count(*)) OVER (PARTITION BY level_group)", "freq", 9)
       + ", 'within' AS scope FROM glog WHERE page IS NOT NULL GROUP BY level_group, page UNION ALL SELECT NULL, page, count(*), "
       + r("count(*)*1.0e0/sum(count(*)) OVER ()", "freq", 9) + ", 'all' FROM glog WHERE page IS NOT NULL GROUP BY page")
def value_counts(spark, sf):
    log, _ = event_log(spark, sf)
    within = P.value_counts(log, "page", [PHASE]).withColumn("scope", F.lit("within"))
    overall = P.value_counts(log, "page").withColumn(PHASE, F.lit(None).cast("string")).withColumn("scope", F.lit("all"))
    return rounded(within.unionByName(overall), 9)


# The numeric and the category columns that are profiled.
_DESCRIBED = ["elapsed_time", "level", "page", "room_coor_x", "room_coor_y", "screen_coor_x", "screen_coor_y", "hover_duration",
              "fullscreen", "hq", "music"]


@query("describe_table", GLOG + ", num AS (" + melt_sql("glog", "1 AS one", _DESCRIBED, lambda c: f"CAST({c} AS DOUBLE)")
       + ") SELECT \"column\", count(value) AS n, " + ", ".join([
           r("avg(value)", "mean", 3), r("stddev_samp(value)", "std", 3), r("min(value)", "min", 3),
           r("quantile_cont(value, 0.25)", "q25", 3), r("quantile_cont(value, 0.5)", "q50", 3),
           r("quantile_cont(value, 0.75)", "q75", 3), r("max(value)", "max", 3)])
       + " FROM num WHERE value IS NOT NULL GROUP BY \"column\"")
def describe_table(spark, sf):
    return rounded(P.describe_numeric(event_log(spark, sf)[0], _DESCRIBED), 3)


_CATS = ["event_name", "name", "text", "fqid", "room_fqid", "room_fqid_0", "room_fqid_1", "room_fqid_2", "text_fqid", "level_group"]
#: The log with the parts of the room as columns of their own, as ``gparts``.
_PARTS = ", gparts AS (SELECT *, " + ", ".join(f"split_part(room_fqid, '.', {i + 1}) AS room_fqid_{i}" for i in range(3)) + " FROM glog)"


def with_room_parts(log):
    return log.withColumns({f"room_fqid_{i}": F.split_part("room_fqid", F.lit("."), F.lit(i + 1)) for i in range(3)})


@query("describe_categories", GLOG + _PARTS + ", c AS (" + melt_sql("gparts", "1 AS one", _CATS, lambda c: c) + ")"
       ", n AS (SELECT \"column\", value, count(*) AS n FROM c WHERE value IS NOT NULL GROUP BY \"column\", value)"
       " SELECT \"column\", CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\","
       " first(value ORDER BY n DESC, value) AS top, max(n) AS freq FROM n GROUP BY \"column\"")
def describe_categories(spark, sf):
    return P.describe_categories(with_room_parts(event_log(spark, sf)[0]), _CATS)


@query("column_means", GLOG + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r(f'avg({c})', 'mean', 3)} FROM glog" for c in _DESCRIBED))
def column_means(spark, sf):
    return rounded(P.column_means(event_log(spark, sf)[0], _DESCRIBED), 3)


@query("session_extent", GLOG + ", x AS (SELECT session_id, max(\"index\") AS max_index, min(level) AS min_level,"
       " max(level) AS max_level FROM glog GROUP BY session_id)"
       " SELECT 'max_index' AS measure, max_index AS value, count(*) AS n_sessions FROM x GROUP BY max_index"
       " UNION ALL SELECT 'min_level', min_level, count(*) FROM x GROUP BY min_level"
       " UNION ALL SELECT 'max_level', max_level, count(*) FROM x GROUP BY max_level")
def session_extent(spark, sf):
    return P.extent_distributions(event_log(spark, sf)[0])


@query("histogram", GLOG + """, x AS (SELECT least(greatest(elapsed_time, 0), 10000000)/10000.0e0 AS x FROM glog)
, lim AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
, h AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x-lo)/((hi-lo)/100)), 99) END AS INT) AS bin, count(*) AS n
  FROM x CROSS JOIN lim GROUP BY 1)
SELECT CAST(g.i AS INT) AS bin, round(lim.lo + g.i*((lim.hi-lim.lo)/100), 6) + 0.0 AS bin_from, coalesce(h.n, 0) AS n
FROM (SELECT unnest(range(100)) AS i) g CROSS JOIN lim LEFT JOIN h ON h.bin = g.i""")
def histogram(spark, sf):
    log, _ = event_log(spark, sf)
    t = log.select((F.least(F.greatest("elapsed_time", F.lit(0)), F.lit(10_000_000)) / 10000.0).alias("t"))
    return rounded(P.histogram(t, "t", 100), 6)


@query("level_profile", GLOG + "SELECT session_id, level, " + r("avg(elapsed_time)", "mean", 3) + ", "
       + r("stddev_samp(elapsed_time)", "std", 3) + ", min(elapsed_time) AS min, max(elapsed_time) AS max,"
       " first(elapsed_time ORDER BY \"index\", elapsed_time, event_id) AS first,"
       " last(elapsed_time ORDER BY \"index\", elapsed_time, event_id) AS last FROM glog GROUP BY session_id, level")
def level_profile(spark, sf):
    return rounded(P.level_profile(event_log(spark, sf)[0]), 3)


@query("pivot_first", glog("replay") + "SELECT session_id, \"index\", " + ", ".join(
    f"first(elapsed_time ORDER BY elapsed_time, event_id) FILTER (level = {v}) AS level_{v}" for v in range(23))
       + " FROM glog GROUP BY session_id, \"index\"")
def pivot_first(spark, sf):
    return P.pivot_first(event_log(spark, sf, "replay")[0], list(range(23)))


@query("elapsed_basic", GLOG + f"SELECT {SG}, CAST(sum(elapsed_time) AS BIGINT) AS elapsed_sum, "
       + r("avg(elapsed_time)", "elapsed_mean")
       + f", max(elapsed_time) AS elapsed_max, min(elapsed_time) AS elapsed_min FROM glog GROUP BY {SG}")
def elapsed_basic(spark, sf):
    return rounded(A.elapsed_basic(event_log(spark, sf)[0]))


_LABEL_COLUMNS = {"session_id": "string", "correct": "int"}


@query("table_profile", GLOG + ", ql AS (" + QLABELS + ") "
       + " UNION ALL ".join(
           [f"SELECT 'events' AS \"table\", count(*) AS n_rows, '{c}' AS \"column\", '{t}' AS type, count(\"{c}\") AS non_null FROM glog"
            for c, t in ((f.name, f.dataType.simpleString()) for f in EVENT_SCHEMA.fields)]
           + [f"SELECT 'labels', count(*), '{c}', '{t}', count({c}) FROM ql" for c, t in _LABEL_COLUMNS.items()]))
def table_profile(spark, sf):
    log, _ = event_log(spark, sf)
    return P.table_profile({
        "events": log.select(*[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields]), "labels": question_labels(spark, sf)})


@query("distinct_values", GLOG + "SELECT DISTINCT level_group, level FROM glog")
def distinct_values(spark, sf):
    return P.distinct_values(event_log(spark, sf)[0], "level", [PHASE])


# Metrics.

@query("macro_f1", "WITH " + SCORES + ", c AS (SELECT " + cells("p1", t="0.5e0") + f" FROM s) SELECT tp, fp, fn, tn, {r(MACRO_F1, 'macro_f1', 9)} FROM c")
def macro_f1(spark, sf):
    return rounded(M.macro_f1(scores(spark, sf), 0.5, p="p1"), 9)


@query("threshold_sweep", "WITH " + SCORES + GRID + sweep_sql()
       + "SELECT CAST(i AS INT) AS i, " + r("t", "threshold", 9) + ", tp, fp, fn, tn, " + r("score", "score", 9) + " FROM sw")
def threshold_sweep(spark, sf):
    return rounded(M.threshold_sweep(scores(spark, sf), p="p1"), 9)


_BEST_BY_LEVEL = (", best AS (SELECT level, max(score) AS score FROM sw GROUP BY level)"
                  " SELECT sw.level, " + r("sw.score", "score", 9) + ", " + r("min(t)", "threshold", 9)
                  + " FROM sw JOIN best ON sw.level = best.level AND sw.score = best.score GROUP BY sw.level, sw.score")


@query("threshold_sweep_by_level", "WITH " + SCORES + GRID + sweep_sql("level", p="p3") + _BEST_BY_LEVEL)
def threshold_sweep_by_level(spark, sf):
    sweep = M.threshold_sweep(scores(spark, sf), ["level"], p="p3")
    return rounded(M.best_threshold(sweep, ["level"]), 9)


@query("argmax_first", "WITH " + SCORES + GRID + sweep_sql("level", p="p2", op=">") + _BEST_BY_LEVEL)
def argmax_first(spark, sf):
    sweep = M.threshold_sweep(scores(spark, sf), ["level"], p="p2", strict=True)
    return rounded(M.best_threshold(sweep, ["level"]), 9)


@query("log_loss", "WITH " + SCORES + ", q AS (SELECT level, y, least(greatest(p1, 1e-15), 1 - 1e-15) AS q FROM s)"
       " SELECT level, " + r("avg(-(y*ln(q) + (1-y)*ln(1-q)))", "log_loss", 6) + " FROM q GROUP BY level")
def log_loss(spark, sf):
    return rounded(M.log_loss(scores(spark, sf), ["level"], p="p1"), 6)


@query("roc_auc", "WITH " + SCORES + """, pairs AS (SELECT a.level, sum(CASE WHEN a.p1 > b.p1 THEN 1.0e0 WHEN a.p1 = b.p1 THEN 0.5e0 ELSE 0 END) AS wins
  FROM s a JOIN s b ON a.level = b.level AND a.y = 1 AND b.y = 0 GROUP BY a.level)
, n AS (SELECT level, CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1-y) AS BIGINT) AS n_neg FROM s GROUP BY level)
SELECT n.level, n_pos, n_neg, round(wins/(n_pos*n_neg), 9) + 0.0 AS auc FROM n LEFT JOIN pairs ON n.level = pairs.level""")
def roc_auc(spark, sf):
    return rounded(M.roc_auc(scores(spark, sf), ["level"], p="p1"), 9)


@query("blend_mean", "WITH " + SCORES + SCORES_LONG + "SELECT id, level, " + r("avg(p)", "p", 9) + " FROM sl GROUP BY id, level")
def blend_mean(spark, sf):
    return rounded(M.blend_mean(scores_long(spark, sf), ["id", "level"]), 9)


#: Separation of the classes by each model, per level and fold: a gain for the importance queries.
_GAIN = SCORES + SCORES_LONG + (
    ", gain AS (SELECT level, fold, model AS feature, abs(avg(p) FILTER (y = 1) - avg(p) FILTER (y = 0)) AS gain"
    " FROM sl GROUP BY level, fold, model)"
    ", imp AS (SELECT level, feature, round(avg(gain), 9) + 0.0 AS gain FROM gain WHERE gain IS NOT NULL GROUP BY level, feature)")


def gains(spark, sf):
    y, p = F.col("y"), F.col("p")
    separation = F.abs(F.avg(F.when(y == 1, p)) - F.avg(F.when(y == 0, p)))
    return (scores_long(spark, sf).groupBy("level", "fold", F.col("model").alias("feature"))
            .agg(separation.alias("gain")).where(F.col("gain").isNotNull()))


@query("importance_mean", "WITH " + _GAIN + " SELECT * FROM imp")
def importance_mean(spark, sf):
    return rounded(mean_importance(gains(spark, sf)), 9)


@query("top_half_features", "WITH " + _GAIN + ", rk AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY gain DESC, feature) AS rank,"
       " count(*) OVER (PARTITION BY level) AS n FROM imp) SELECT level, feature, gain, CAST(rank AS INT) AS rank FROM rk"
       " WHERE rank <= floor(n*0.5)")
def top_half_features(spark, sf):
    return top_half(rounded(mean_importance(gains(spark, sf)), 9))


# Windows.

@query("time_diff", GLOG + DIFFS + "SELECT event_id, elapsed_time_diff FROM d")
def time_diff(spark, sf):
    return diffed(spark, sf)[0].select("event_id", "elapsed_time_diff")


@query("coord_diff", GLOG + DIFFS + "SELECT event_id, location_x_diff, location_y_diff FROM d")
def coord_diff(spark, sf):
    return diffed(spark, sf)[0].select("event_id", "location_x_diff", "location_y_diff")


_REPLAY = glog("replay") + """, f AS (SELECT *, level - lag(level) OVER w AS ld FROM glog
    WINDOW w AS (PARTITION BY session_id ORDER BY "index", elapsed_time, event_id))
, g AS (SELECT *, CAST(sum(least(coalesce(ld, 0), 0)) OVER (PARTITION BY session_id ORDER BY "index", elapsed_time, event_id
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS reversal_sum FROM f)
"""


@query("first_play_only", _REPLAY + "SELECT session_id, \"index\", level, event_id FROM g WHERE reversal_sum = 0")
def first_play_only(spark, sf):
    log, hot = event_log(spark, sf, "replay")
    return W.first_play_only(log, hot).select(SESSION, "index", "level", "event_id")


@query("running_sum", _REPLAY + "SELECT event_id, reversal_sum FROM g")
def running_sum(spark, sf):
    log, hot = event_log(spark, sf, "replay")
    return W.with_reversals(log, hot).select("event_id", "reversal_sum")


@query("monotonic_check", glog("shuffled") + """, f AS (SELECT session_id, "index" < lag("index") OVER (PARTITION BY session_id ORDER BY event_id) AS falls
  FROM glog) SELECT DISTINCT session_id FROM f WHERE falls""")
def monotonic_check(spark, sf):
    log, hot = event_log(spark, sf, "shuffled")
    return W.non_monotonic_sessions(log, "index", hot=hot)


@query("reversal_flag", _REPLAY + "SELECT event_id, CASE WHEN ld < 0 THEN 'reversed' ELSE 'not_reversed' END AS is_reversed FROM g")
def reversal_flag(spark, sf):
    log, hot = event_log(spark, sf, "replay")
    return W.reversal_flag(log, hot).select("event_id", "is_reversed")


@query("duplicate_keys", _DUP + " SELECT session_id, \"index\", event_id FROM c WHERE n > 1")
def duplicate_keys(spark, sf):
    log, _ = event_log(spark, sf, "duplicated")
    return W.duplicate_keys(log).select(SESSION, "index", "event_id")


_TAIL = GLOG + """, t AS (SELECT *, CAST(row_number() OVER (PARTITION BY session_id ORDER BY "index" DESC, elapsed_time DESC, event_id DESC) AS INT)
    AS tail_rank FROM glog)
"""


@query("tail_n", _TAIL + "SELECT session_id, event_id, tail_rank FROM t WHERE tail_rank <= 10")
def tail_n(spark, sf):
    return W.tail_n(event_log(spark, sf)[0], 10).select(SESSION, "event_id", "tail_rank")


@query("recency_weight", _TAIL + "SELECT session_id, event_id, "
       + r("(count(*) OVER (PARTITION BY session_id) - tail_rank + 1)*1.0e0/count(*) OVER (PARTITION BY session_id)", "weight", 9)
       + " FROM t WHERE tail_rank <= 50")
def recency_weight(spark, sf):
    return rounded(W.with_recency_weight(event_log(spark, sf)[0], 50).select(SESSION, "event_id", "weight"), 9)


# Sort, limit, top-k.

@query("sort_events", GLOG + "SELECT session_id, elapsed_time, event_id FROM glog ORDER BY session_id, elapsed_time, event_id")
def sort_events(spark, sf):
    log, _ = event_log(spark, sf)
    return W.sort_events(log.select(SESSION, "elapsed_time", "event_id"), [SESSION, "elapsed_time", "event_id"])


@query("limit_rows", GLOG + "SELECT event_id, session_id FROM glog ORDER BY event_id LIMIT 100")
def limit_rows(spark, sf):
    return W.first_rows(event_log(spark, sf)[0].select("event_id", SESSION), 100, ["event_id"])


@query("top_bottom_values", GLOG + _PARTS + ", c AS (SELECT \"column\", value, count(*) AS n FROM ("
       + melt_sql("gparts", "1 AS one", _CATS, lambda c: c)
       + ") WHERE value IS NOT NULL GROUP BY \"column\", value)"
         ", rk AS (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS t,"
         " row_number() OVER (PARTITION BY \"column\" ORDER BY n, value) AS b FROM c)"
         " SELECT \"column\", value, n, CAST(t AS INT) AS rank, 'top' AS side FROM rk WHERE t <= 10"
         " UNION ALL SELECT \"column\", value, n, CAST(b AS INT), 'bottom' FROM rk WHERE b <= 10")
def top_bottom_values(spark, sf):
    return P.top_bottom_values(with_room_parts(event_log(spark, sf)[0]), _CATS)


@query("first_seen_order", GLOG + "SELECT session_id, min(event_id) AS first_seen FROM glog GROUP BY session_id ORDER BY first_seen")
def first_seen_order(spark, sf):
    return W.first_seen_order(event_log(spark, sf)[0])


# Set operations.

@query("union_folds", "WITH " + SCORES + "SELECT id, fold, y, " + r("p1", "p", 9) + " FROM s")
def union_folds(spark, sf):
    """Folds are folders of one table: reading it is their union, in one scan."""
    path = scratch(spark, "folds")
    S.write_folds(scores(spark, sf).select("id", "fold", "y", F.col("p1").alias("p")), path)
    return rounded(S.read_table(spark, path).withColumn("fold", F.col("fold").cast("long")).select("id", "fold", "y", "p"), 9)


@query("session_overlap", glog("missing_phase") + ", lhs AS (SELECT DISTINCT session_id FROM glog WHERE level_group = '0-4')"
       ", rhs AS (SELECT DISTINCT session_id FROM glog WHERE level_group = '13-22')"
       " SELECT (SELECT count(*) FROM lhs) AS n_left, (SELECT count(*) FROM rhs) AS n_right,"
       " (SELECT count(*) FROM lhs JOIN rhs USING (session_id)) AS n_both")
def session_overlap(spark, sf):
    log, _ = event_log(spark, sf, "missing_phase")
    return P.session_overlap(log.where(F.col(PHASE) == "0-4"), log.where(F.col(PHASE) == "13-22"))


@query("fold_complement", "WITH " + SCORES + "SELECT h.fold, count(*) AS n_train, CAST(sum(s.y) AS BIGINT) AS pos_train"
       " FROM (SELECT unnest(range(5)) AS fold) h JOIN s ON s.fold <> h.fold GROUP BY h.fold")
def fold_complement(spark, sf):
    per_fold = scores(spark, sf).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    total = per_fold.agg(F.struct(F.sum("n").alias("n"), F.sum("pos").alias("pos"))).scalar()
    out = per_fold.withColumn("_t", total)
    return out.select("fold", (F.col("_t.n") - F.col("n")).alias("n_train"), (F.col("_t.pos") - F.col("pos")).alias("pos_train"))


# The feature step.

def flat_long_sql() -> str:
    """Every flat feature as name and value, per session and phase."""
    pairs = [("nrows", "count(\"index\")"), ("elapsed_time_sum", "sum(elapsed_time)")]
    for w in WORDS:
        k, f = word_key(w), f"FILTER (contains(text, '{w}'))"
        pairs += [(f"word_{k}", f"count(*) {f}"), (f"word_mean_{k}", f"avg(elapsed_time_diff) {f}"),
                  (f"word_std_{k}", f"stddev_samp(elapsed_time_diff) {f}"), (f"word_max_{k}", f"max(elapsed_time_diff) {f}"),
                  (f"word_sum_{k}", f"sum(elapsed_time_diff) {f}"), (f"word_median_{k}", f"median(elapsed_time_diff) {f}")]
    for c in NUMERIC:
        pairs += [(f"{c}_mean", f"avg({c})"), (f"{c}_std", f"stddev_samp({c})"), (f"{c}_sum", f"sum({c})")]
        pairs += [(q_name(c, q), quantile_sql(c, q)) for q in QS]
    pairs += [(f"{c}_nunique", f"count(DISTINCT {category_sql(c)})") for c in ["event_name", "fqid", "room_fqid", "text"]]
    marks = [(f"{m}_span_{c}", f"CASE WHEN level_group = '{_MARK_PHASE[m]}' THEN {span_sql(m, c)} END")
             for m in _MARK_SQL for c in ("elapsed_time", "index")]
    names = ", ".join(f"'{n}'" for n, _ in pairs + marks)
    values = ", ".join(f"CAST({e} AS DOUBLE)" for _, e in pairs + marks)
    return f"SELECT {SG}, unnest([{names}]) AS feature, unnest([{values}]) AS value FROM d GROUP BY {SG}"


CATS_IN_ORDER = ["event_name", "name", "fqid", "room_fqid", "text_fqid", "level", "page"]
FEATURES_LONG = DIFFS + TALL + VOCAB + (
    ", slots AS (SELECT level_group, \"column\", value FROM vocab WHERE \"column\" <> 'text' UNION ALL "
    + " UNION ALL ".join(f"SELECT unnest(['0-4', '5-12', '13-22']), '{c}', '{c}_null'" for c in CATS_IN_ORDER) + ")"
    ", who AS (SELECT DISTINCT session_id, level_group FROM d)"
    ", cells AS (SELECT w.session_id, w.level_group, regexp_replace(concat(s.\"column\", '_', s.value), '[^A-Za-z0-9_]+', '_', 'g') AS stem,"
    " coalesce(t.n, 0) AS n, " + ", ".join(f"t.{s}" for s in _STATS)
    + " FROM who w JOIN slots s ON s.level_group = w.level_group LEFT JOIN tall t ON t.session_id = w.session_id"
      " AND t.level_group = w.level_group AND t.\"column\" = s.\"column\" AND t.value = s.value)"
      ", catlong AS (SELECT session_id, level_group, concat(stem, '_', unnest(['count', "
    + ", ".join(f"'{s}'" for s in _STATS) + "])) AS feature, unnest([CAST(n AS DOUBLE), "
    + ", ".join(f"CAST({s} AS DOUBLE)" for s in _STATS) + "]) AS value FROM cells)"
    + ", feats AS (SELECT * FROM catlong UNION ALL " + flat_long_sql() + ")\n")


def all_features(spark, sf, variant="plain"):
    log, hot = event_log(spark, sf, variant)
    vocab = stored_vocab(spark, log)
    return {p: session_features(log, p, vocab, hot=hot) for p in PHASES}


def flagship(spark, sf):
    """All features of the last phase."""
    log, hot = event_log(spark, sf)
    return session_features(log, "13-22", stored_vocab(spark, log), hot=hot)


@query("build_session_features", GLOG + FEATURES_LONG + f"SELECT {SG}, feature, " + r("value", "value", 3)
       + " FROM feats WHERE value IS NOT NULL")
def build_session_features(spark, sf):
    parts = [features_long(f) for f in all_features(spark, sf).values()]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 3)


@query("build_session_features_wide", GLOG + FEATURES_LONG + f"SELECT {SG}, CAST(count(value) AS INT) AS n_values,"
       " CAST(sum(CAST(CAST(round(value, 3) AS DECIMAL(20, 3))*1000 AS BIGINT)) AS BIGINT) AS thousandths"
       f" FROM feats GROUP BY {SG}")
def build_session_features_wide(spark, sf):
    """Every column of the wide rows of all phases: how many have a value, and the exact sum of the rounded values."""
    exact = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, v: s + (F.round(v, 3).cast("decimal(20,3)") * 1000).cast("bigint"))
    parts = []
    for wide in all_features(spark, sf).values():
        values, _ = as_arrays(feature_columns(wide))
        rows = wide.select(*KEYS, F.filter(values, lambda v: v.isNotNull()).alias("v"))
        parts.append(rows.select(*KEYS, F.size("v").alias("n_values"), exact.alias("thousandths")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def named_profile(log, vocab, phase, hot, folds=None):
    """The profile of a phase's block, under the names of its wide columns; without rows for values that nothing has."""
    values = wide_values(vocab, phase)
    names = [(v.column, v.value, i, n) for v in values for i, n in enumerate(stat_names(v))]
    names += [(B.FLAT, "", i, n) for i, n in enumerate(B.flat_names(log, phase))]
    named = log.sparkSession.createDataFrame(names, "column string, value string, stat int, feature string")
    profiled = B.pruned(B.profile(B.block(log, phase, hot), folds))
    return profiled.join(bounded_broadcast(named), ["column", "value", "stat"], "right").withColumn(PHASE, F.lit(phase))


@query("prune_features", GLOG + FEATURES_LONG + ", catalog AS (SELECT level_group, feature, CASE"
       " WHEN count(value) = 0 OR (count(value) = count(*) AND min(value) = max(value)) THEN 'constant'"
       " WHEN 1.0e0 - count(value)*1.0e0/count(*) > 0.9 THEN 'null_ratio' END AS reason"
       " FROM feats WHERE feature NOT LIKE '%\\_span\\_%' ESCAPE '\\' OR (level_group, feature) IN ("
       + ", ".join(f"('{_MARK_PHASE[m]}', '{m}_span_{c}')" for m in _MARK_SQL for c in ("elapsed_time", "index"))
       + ") GROUP BY level_group, feature)"
       " SELECT level_group, feature, reason IS NULL AS kept, reason FROM catalog")
def prune_features_query(spark, sf):
    """Profiled tall, before anything is wide. A null token that no row needs is a column of nothing, and constant."""
    log, hot = event_log(spark, sf)
    vocab = stored_vocab(spark, log)
    parts = [named_profile(log, vocab, p, hot) for p in PHASES]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    reason = F.when(F.col("n").isNull(), "constant").otherwise(F.col("reason"))
    return out.select(PHASE, "feature", reason.isNull().alias("kept"), reason.alias("reason"))


@query("prune_by_fold", GLOG + FEATURES_LONG + ", f AS (SELECT level_group, session_id % 5 AS fold, feature, count(*) AS n, count(value) AS present,"
       " min(value) AS low, max(value) AS high FROM feats WHERE feature NOT LIKE '%\\_span\\_%' ESCAPE '\\'"
       " OR (level_group, feature) IN ("
       + ", ".join(f"('{_MARK_PHASE[m]}', '{m}_span_{c}')" for m in _MARK_SQL for c in ("elapsed_time", "index"))
       + ") GROUP BY level_group, session_id % 5, feature)"
       ", o AS (SELECT f.level_group, k.fold, f.feature, sum(n) AS n, sum(present) AS present, min(low) AS low, max(high) AS high"
       " FROM f JOIN (SELECT unnest(range(5)) AS fold) k ON f.fold <> k.fold GROUP BY f.level_group, k.fold, f.feature)"
       " SELECT level_group, CAST(fold AS INT) AS fold, feature, NOT (present = 0 OR (present = n AND low = high) OR 1.0e0 - present*1.0e0/n > 0.9)"
       " AS kept FROM o")
def prune_by_fold(spark, sf):
    """What each fold's training sessions would keep, for all folds from one pass over the tall statistics."""
    log, hot = event_log(spark, sf)
    vocab = stored_vocab(spark, log)
    folds = log.select(SESSION).distinct().withColumn("fold", (F.col(SESSION) % 5).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.lit(4)))
    parts = []
    for p in PHASES:
        named = named_profile(log, vocab, p, hot, folds)
        bare = named.where("fold IS NULL").withColumn("fold", each)  # columns of nothing, in no fold's profile
        parts.append(named.where("fold IS NOT NULL").unionByName(bare).select(PHASE, "fold", "feature", F.coalesce("kept", F.lit(False)).alias("kept")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("concat_features", GLOG + NUMERIC_LONG + "SELECT session_id, concat('g', CASE level_group WHEN '0-4' THEN 0 WHEN '5-12' THEN 1 ELSE 2 END,"
       " '_', feature) AS feature, " + r("value", "value", 3) + " FROM nl WHERE feature NOT IN ('zero', 'empty') AND value IS NOT NULL"
       " AND session_id IN (SELECT session_id FROM nl WHERE level_group = '13-22')")
def concat_features(spark, sf):
    """All numeric columns of the phases side by side, as one narrow table."""
    d, _ = diffed(spark, sf)
    by_phase = {p: d.where(F.col(PHASE) == p).groupBy(*KEYS).agg(*A.numeric_exprs()) for p in PHASES}
    wide = carry_forward(by_phase)["13-22"]
    values, names = as_arrays([c for c in wide.columns if c != SESSION])
    tall = wide.select(SESSION, F.posexplode(values).alias("_i", "value")).where(F.col("value").isNotNull())
    return rounded(tall.select(SESSION, F.get(names, F.col("_i")).alias("feature"), "value"), 3)


@query("bucketed_carry_forward", SQL["carry_forward"])
def bucketed_carry_forward(spark, sf):
    """Phases stored by buckets of their sessions, carried forward without dealing any of them again."""
    log, _ = event_log(spark, sf, "missing_phase")
    stored = {}
    for i, p in enumerate(PHASES):
        name = f"phase_{i}_{uuid.uuid4().hex}"
        stored[p] = S.write_bucketed(A.elapsed_basic(log.where(F.col(PHASE) == p)), name, scratch(spark, name))
    return rounded(carry_forward(stored)["13-22"])
