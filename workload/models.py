"""Queries for sequences, embeddings, models, stacking and streams."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from playtrace.functions.arrays import pad_left, pad_right
from playtrace.operators import cooccurrence as C
from playtrace.operators import labels as L
from playtrace.operators import metrics as M
from playtrace.operators import model_table as X
from playtrace.operators import sequences as Q
from playtrace.operators import stacking as K
from playtrace.operators import stats as A
from playtrace.operators import training as T
from playtrace.operators.features import carry_forward, features_long, session_features
from playtrace.operators.modelsel import mean_importance, top_half
from playtrace.operators.sessions import last_values, session_sequences, with_differences
from playtrace.plans.training import Layout, StoredRun, score, train
from playtrace.schema import KEYS, PHASE, PHASES, SESSION
from playtrace.sources import models as SM
from playtrace.sources import tables as S
from playtrace.streaming import files as SF
from playtrace.streaming.scoring import FeatureStore, score_stream
from workload.inputs import event_log, parsed_labels, question_labels, scores, scores_long, table
from workload.registry import (
    FOLDS, GLOG, LABELS, SCORES, VOCAB, glog, query, r, rounded,
)
from workload.relational import FEATURES_LONG, SG, stored_vocab
from workload.scalar import NUMERIC, scratch

# Sequences.

_IN_ORDER = "ORDER BY \"index\", elapsed_time, event_id"
_LISTS = GLOG + (f", seq AS (SELECT session_id, level_group, list(level {_IN_ORDER}) AS a FROM glog"
                 " GROUP BY session_id, level_group)")


@query("pad_left", _LISTS + " SELECT session_id, level_group, array_to_string(list_concat("
       "list_transform(range(greatest(0, 20 - len(a))), lambda x: -1), a[greatest(1, len(a) - 19):len(a)]), ',') AS levels FROM seq")
def pad_left_query(spark, sf):
    recent = last_values(event_log(spark, sf)[0], ["level"], 20, KEYS)
    return recent.select(*KEYS, F.array_join(pad_left(F.col("level"), 20, F.lit(-1)), ",").alias("levels"))


@query("pad_right", _LISTS + " SELECT session_id, level_group, array_to_string(list_concat(a,"
       " list_transform(range(greatest(0, 30 - len(a))), lambda x: -1)), ',') AS levels FROM seq")
def pad_right_query(spark, sf):
    lists = session_sequences(event_log(spark, sf)[0], ["level"], KEYS)
    return lists.select(*KEYS, F.array_join(pad_right(F.col("level"), 30, F.lit(-1)), ",").alias("levels"))


@query("flatten", GLOG + """SELECT session_id, string_agg(text, '|' ORDER BY CASE level_group WHEN '0-4' THEN 0 WHEN '5-12' THEN 1 ELSE 2 END,
    "index", elapsed_time, event_id) AS texts FROM glog WHERE text IS NOT NULL GROUP BY session_id""")
def flatten_query(spark, sf):
    """The lists of a session's phases, one after another, as one list."""
    log = event_log(spark, sf)[0].where(F.col("text").isNotNull())
    lists = session_sequences(log, ["text"], KEYS)
    number = F.array_position(F.array(*map(F.lit, PHASES)), F.col(PHASE))
    whole = lists.groupBy(SESSION).agg(F.sort_array(F.collect_list(F.struct(number.alias("i"), "text"))).alias("lists"))
    return whole.select(SESSION, F.array_join(F.flatten("lists.text"), "|").alias("texts"))


_SEQ_N = 20
_SEQ_COLUMNS = ["event_name", "level", "fqid", "room_fqid"]


def _padded(column: str) -> str:
    a = f"list({column} {_IN_ORDER})"
    return f"array_to_string(list_concat(list_transform(range({_SEQ_N} - len({a})), lambda x: 0), {a}), ',')"


@query("sequence_dataset", "WITH " + LABELS + GLOG.replace("WITH e AS", ", e AS", 1) + VOCAB
       + ", sz AS (SELECT level_group, \"column\", CAST(count(*) AS INT) AS size FROM vocab GROUP BY level_group, \"column\")"
       + ", t AS (SELECT *, row_number() OVER (PARTITION BY session_id, level_group ORDER BY \"index\" DESC, elapsed_time DESC, event_id DESC) AS rn"
         " FROM glog)"
       + ", coded AS (SELECT t.session_id, t.level_group, t.\"index\", t.elapsed_time, t.event_id, least(greatest(t.elapsed_time, 0), 3600000) AS time, "
       + ", ".join(f"CASE WHEN t.{c} IS NULL THEN (SELECT size FROM sz WHERE \"column\" = '{c}' AND sz.level_group = t.level_group) + 1"
                   f" ELSE v{i}.pos + 1 END AS {c}_id" for i, c in enumerate(_SEQ_COLUMNS))
       + " FROM t " + " ".join(
           f"LEFT JOIN vocab v{i} ON v{i}.level_group = t.level_group AND v{i}.\"column\" = '{c}' AND v{i}.value = CAST(t.{c} AS VARCHAR)"
           for i, c in enumerate(_SEQ_COLUMNS)) + f" WHERE rn <= {_SEQ_N})"
       + ", lists AS (SELECT session_id, level_group, " + _padded("time") + " AS elapsed_clipped, "
       + ", ".join(f"{_padded(c + '_id')} AS {c}_id" for c in _SEQ_COLUMNS) + " FROM coded GROUP BY session_id, level_group)"
       + ", ll AS (SELECT session AS session_id, level_group, array_to_string(list(correct ORDER BY level), ',') AS correct FROM lab"
         " GROUP BY session, level_group)"
         " SELECT ll.session_id, ll.level_group, correct, elapsed_clipped, " + ", ".join(f"{c}_id" for c in _SEQ_COLUMNS)
       + " FROM ll LEFT JOIN lists ON ll.session_id = lists.session_id AND ll.level_group = lists.level_group")
def sequence_dataset(spark, sf):
    log, _ = event_log(spark, sf)
    vocab, labels = stored_vocab(spark, log), parsed_labels(spark, sf)
    parts = [Q.sequence_dataset(log, labels, vocab, p, _SEQ_N).withColumn(PHASE, F.lit(p)) for p in PHASES]
    ids = [f"{c}_id" for c in _SEQ_COLUMNS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        *KEYS, F.array_join("correct", ",").alias("correct"),
        F.array_join(F.col("elapsed_clipped").cast("array<bigint>"), ",").alias("elapsed_clipped"),
        *[F.array_join(c, ",").alias(c) for c in ids])


_VECTORS = """, norm AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)*CAST(x AS DOUBLE)))) AS len
    FROM embeddings)
, unitv AS (SELECT vec_id, i, CASE WHEN len = 0 THEN 0.0e0 ELSE CAST(embedding[i] AS DOUBLE)/len END AS x
    FROM norm CROSS JOIN (SELECT unnest(range(1, 65)) AS i))
, tail AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY "index" DESC, elapsed_time DESC, event_id DESC) AS tail_rank FROM glog)
"""


def _embedding_sql(n: int, weight: str) -> str:
    return GLOG + _VECTORS + (
        f", w AS (SELECT session_id, k, {weight} AS weight FROM tail WHERE tail_rank <= {n})"
        ", emb AS (SELECT w.session_id, CAST(i - 1 AS INT) AS dim, sum(weight*x)/sum(weight) AS value"
        " FROM w JOIN unitv ON unitv.vec_id = w.k GROUP BY w.session_id, i"
        " UNION ALL SELECT session_id, NULL, NULL FROM (SELECT DISTINCT session_id FROM w) WHERE session_id NOT IN"
        " (SELECT session_id FROM w JOIN embeddings ON vec_id = k))")


_RECENCY = "(count(*) OVER (PARTITION BY session_id) - tail_rank + 1)*1.0e0/count(*) OVER (PARTITION BY session_id)"


def event_embedding(spark, sf, n, weighted):
    log, _ = event_log(spark, sf)
    return Q.tail_embedding(log, table(spark, sf, "embeddings"), "k", n, weighted, word="vec_id", vector="embedding")


def by_dimension(embeddings):
    return embeddings.select(SESSION, F.posexplode_outer("embedding").alias("dim", "value"))


@query("mean_embedding", _embedding_sql(10, "1.0e0") + " SELECT session_id, dim, " + r("value", "value", 6) + " FROM emb")
def mean_embedding(spark, sf):
    return rounded(by_dimension(event_embedding(spark, sf, 10, False)), 6)


@query("weighted_embedding", _embedding_sql(50, _RECENCY) + " SELECT session_id, dim, " + r("value", "value", 6) + " FROM emb")
def weighted_embedding(spark, sf):
    return rounded(by_dimension(event_embedding(spark, sf, 50, True)), 6)


@query("expand_vector", _embedding_sql(10, "1.0e0") + " SELECT session_id, "
       + ", ".join(r(f"max(value) FILTER (dim = {i})", f"embedding_{i}", 6) for i in range(64)) + " FROM emb GROUP BY session_id")
def expand_vector(spark, sf):
    return rounded(Q.expand_vector(event_embedding(spark, sf, 10, False), "embedding", 64, "embedding"), 6)


@query("train_embedding", GLOG + "SELECT DISTINCT text AS word, 8 AS dims, true AS finite FROM glog WHERE text IS NOT NULL")
def train_embedding(spark, sf):
    """Each token has a vector; its numbers come from random starts, so the twin knows their count only."""
    log, hot = event_log(spark, sf)
    vectors = Q.train_embedding(log, "text", hot=hot).getVectors().select("word", vector_to_array("vector").alias("v"))
    return vectors.select("word", F.size("v").alias("dims"), F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6)).alias("finite"))


@query("similar_tokens", "WITH c AS (SELECT a.vec_id AS token, b.vec_id AS word, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),"
       " CAST(b.embedding AS DOUBLE[])) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"
       ", rk AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY similarity DESC, word) AS rank FROM c)"
       " SELECT token, word, " + r("similarity", "similarity", 6) + ", CAST(rank AS INT) AS rank FROM rk WHERE rank <= 5")
def similar_tokens(spark, sf):
    """The nearest tokens of every token of a table of vectors."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vector"))
    return rounded(Q.similar_tokens(vectors), 6)


_WINDOW = 5


@query("token_information", GLOG + ", t AS (SELECT session_id, room_fqid AS token, row_number() OVER (PARTITION BY session_id"
       " ORDER BY \"index\", elapsed_time, event_id) AS i FROM glog WHERE room_fqid IS NOT NULL)"
       f", p AS (SELECT x.token AS a, y.token AS b FROM t x JOIN t y ON x.session_id = y.session_id AND y.i BETWEEN x.i + 1 AND x.i + {_WINDOW})"
       ", c AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) GROUP BY a, b)"
       ", s AS (SELECT a, sum(n) AS s FROM c GROUP BY a)"
       " SELECT c.a, c.b, c.n, " + r("greatest(0.0e0, ln(c.n*1.0e0*(SELECT sum(n) FROM c)/(sa.s*sb.s)))", "m", 6)
       + " FROM c JOIN s sa ON sa.a = c.a JOIN s sb ON sb.a = c.b")
def token_information(spark, sf):
    """Co-occurrence counts of the rooms and their positive information, from which token vectors are factored."""
    log, hot = event_log(spark, sf)
    counts = C.pair_counts(log, "room_fqid", _WINDOW, hot=hot)
    m = C.positive_information(counts)
    return rounded(counts.join(m, ["a", "b"], "left").select("a", "b", "n", F.coalesce("m", F.lit(0.0)).alias("m")), 6)


@query("token_vectors", GLOG + "SELECT DISTINCT fqid AS word, 8 AS dims, true AS finite FROM glog WHERE fqid IS NOT NULL")
def token_vectors(spark, sf):
    """Vectors factored from the counts; tests hold them against a dense factorisation."""
    log, hot = event_log(spark, sf)
    vectors = C.token_vectors(log, "fqid", hot=hot)
    return vectors.select("word", F.size("vector").alias("dims"), F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6)).alias("finite"))


@query("nearest_vectors", "WITH q AS (SELECT vec_id AS token, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 100 = 0)"
       ", c AS (SELECT token, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), e) AS similarity FROM embeddings"
       " CROSS JOIN q WHERE vec_id <> token)"
       ", rk AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY similarity DESC, vec_id) AS rank FROM c)"
       " SELECT token, vec_id, " + r("similarity", "similarity", 6) + ", CAST(rank AS INT) AS rank FROM rk WHERE rank <= 5")
def nearest_vectors(spark, sf):
    return rounded(Q.nearest_vectors(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, 5, "vec_id", "embedding"), 6)


# Folds, training and selection.

@query("stratified_group_kfold", "WITH " + LABELS + FOLDS + "SELECT session, fold FROM folds")
def stratified_group_kfold(spark, sf):
    return L.group_folds(parsed_labels(spark, sf))


LEVELS = list(range(1, 19))
N_FOLDS = 5
#: Learners of the model queries, for all questions and folds. The boosted one has the reference's settings but for its L1 penalty, with
#: which small tables have no split; its trees end by patience.
SPECS = [
    T.ModelSpec("gbt", "boosted", {
        "maxIter": 1000, "maxDepth": 4, "stepSize": 0.02, "subsamplingRate": 0.8, "featureSubset": 0.5, "l2": 10.0, "patience": 50, "seed": 42},
        balanced=True),
    T.ModelSpec("logistic", "logistic", {"maxIter": 5, "regParam": 0.1}),
]
_ROWS: dict[tuple, tuple] = {}
_FITS: dict[tuple, dict] = {}

#: Each label with its fold, as ``fl``; follows ``LABELS`` and ``FOLDS``.
_FOLDED = ", fl AS (SELECT lab.*, folds.fold FROM lab JOIN folds ON folds.session = lab.session)\n"


def training_rows(spark, sf):
    """Rows for the fits, stored by question: numeric statistics of all phases so far. Made once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ROWS:
        log, hot = event_log(spark, sf)
        d = with_differences(log, hot)
        by_phase = {p: d.where(F.col(PHASE) == p).groupBy(*KEYS).agg(*A.numeric_exprs()) for p in PHASES}
        features = carry_forward(by_phase)["13-22"]
        names = T.feature_names(features)
        labels = parsed_labels(spark, sf)
        labels = L.with_folds(labels, L.group_folds(labels, k=N_FOLDS))
        path = scratch(spark, "rows")
        S.write_table(T.model_rows(labels, T.feature_vector(features, names)), path, ["level"])
        _ROWS[key] = path, names
    path, names = _ROWS[key]
    return S.read_table(spark, path), names


def fitted(spark, sf, spec):
    """Models of all questions and folds; queries on the same input share them."""
    key = (spark.sparkContext.applicationId, sf, spec.name)
    if key not in _FITS:
        _FITS[key] = T.fit_levels(training_rows(spark, sf)[0], spec, LEVELS, range(N_FOLDS), 8)
    return _FITS[key]


_EACH_FIT = "SELECT unnest(range(1, 19)) AS level, f.fold FROM (SELECT unnest(range(5)) AS fold) f"


@query("fit_per_level", f"SELECT CAST(level AS INT) AS level, CAST(fold AS INT) AS fold, 1.0e0 AS gain, true AS positive FROM ({_EACH_FIT})")
def fit_per_level(spark, sf):
    """A model for each question and fold, whose features share its gain."""
    _, names = training_rows(spark, sf)
    gains = T.gains(fitted(spark, sf, SPECS[0]), names, spark)
    return rounded(gains.groupBy("level", "fold").agg(F.sum("gain").alias("gain"), F.bool_and(F.col("gain") > 0).alias("positive")), 6)


@query("early_stop", "WITH " + LABELS + FOLDS + _FOLDED
       + "SELECT level, fold, count(*) AS n, true AS stopped, true AS kept FROM fl GROUP BY level, fold")
def early_stop(spark, sf):
    """The rows that choose each model's trees, whether it stops where patience ends, and whether no other trees are kept."""
    rows, _ = training_rows(spark, sf)
    spec = T.ModelSpec("stopped", "gbt", {"maxIter": 4, "maxDepth": 2, "seed": 42})
    models, best = T.fit_patient(rows, spec, LEVELS, range(N_FOLDS), patience=1, parallelism=8)
    trees = models.groupBy("level", "fold").agg(F.count_distinct("tree").alias("n_trees"))
    n = rows.groupBy("level", "fold").agg(F.count(F.lit(1)).alias("n"))
    out = n.join(best, ["level", "fold"]).join(trees, ["level", "fold"])
    return out.select("level", "fold", "n", F.col("trees").between(1, 4).alias("stopped"), (F.col("n_trees") == F.col("trees")).alias("kept"))


@query("oof_predict", "WITH " + LABELS + FOLDS + _FOLDED
       + "SELECT session, level, fold, 'logistic' AS model, correct AS y, true AS probability FROM fl")
def oof_predict(spark, sf):
    """Every label once, in its own fold."""
    out = T.oof_predict(training_rows(spark, sf)[0], fitted(spark, sf, SPECS[1]), "logistic")
    return out.select("session", "level", "fold", "model", "y", F.col("p").between(0.0, 1.0).alias("probability"))


@query("evaluate_oof", "WITH " + LABELS + "SELECT level, count(*) AS n, 1 AS n_best, true AS in_range FROM lab GROUP BY level"
       " UNION ALL SELECT NULL, count(*), 1, true FROM lab")
def evaluate_oof(spark, sf):
    """Out-of-fold rows, stored by fold and read as one table: the best threshold of each question, and over all of them."""
    path = scratch(spark, "oof")
    S.write_oof(T.oof_predict(training_rows(spark, sf)[0], fitted(spark, sf, SPECS[1]), "logistic"), path)
    oof = S.read_table(spark, path)
    scores_path = scratch(spark, "scores")
    by_level = M.best_threshold(M.threshold_sweep(oof, ["level"]), ["level"])
    over_all = M.best_threshold(M.threshold_sweep(oof))
    S.append_scores(by_level.select(F.concat(F.lit("logistic/"), F.col("level")).alias("scope"), "level", "threshold", "score"), scores_path)
    S.append_scores(over_all.select(F.lit("logistic").alias("scope"), "threshold", "score"), scores_path)
    best = S.read_table(spark, scores_path).groupBy("level").agg(
        F.count(F.lit(1)).alias("n_best"), F.bool_and(F.col("score").between(0.0, 1.0) & F.col("threshold").between(0.0, 1.0)).alias("in_range"))
    n = oof.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    n = n.unionByName(oof.agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit(None).cast("int")))
    return n.join(best, n["level"].eqNullSafe(best["level"])).select(n["level"], "n", F.col("n_best").cast("int").alias("n_best"), "in_range")


@query("save_load_models", "WITH " + LABELS + FOLDS + _FOLDED + "SELECT session, level, fold, true AS same FROM fl")
def save_load_models(spark, sf):
    """Models of all questions and folds, stored as one table and read back, answer as the fitted ones do."""
    rows, names = training_rows(spark, sf)
    path = scratch(spark, "models")
    models = fitted(spark, sf, SPECS[1])
    SM.save_table(X.model_table(models, "logistic", names, spark), path)
    before = T.oof_predict(rows, models, "logistic").withColumnRenamed("p", "p_fitted")
    after = X.oof_scores(rows, X.scorers(SM.load_table(spark, path, ["logistic"]), names)[0]).withColumnRenamed("p", "p_loaded")
    both = before.join(after, ["session", "level", "fold", "model", "y"])
    return both.select("session", "level", "fold", (F.abs(F.col("p_fitted") - F.col("p_loaded")) < 1e-12).alias("same"))


@query("gain_selection", "SELECT CAST(unnest(range(1, 19)) AS INT) AS level, true AS half, true AS ranked, true AS largest")
def gain_selection(spark, sf):
    """Of each question the half of the features with the largest gain; which ones they are depends on the fits."""
    _, names = training_rows(spark, sf)
    used = mean_importance(T.gains(fitted(spark, sf, SPECS[0]), names, spark))
    top, rest = top_half(used), top_half(used, keep="bottom")
    top = top.groupBy("level").agg(F.count("*").alias("n"), F.max("rank").alias("rank"), F.min("gain").alias("least"))
    rest = rest.groupBy("level").agg(F.count("*").alias("n_rest"), F.max("gain").alias("most"))
    return top.join(rest, "level").select(
        "level", (F.col("n_rest") - F.col("n")).isin(0, 1).alias("half"), (F.col("rank") == F.col("n")).alias("ranked"),
        (F.col("least") >= F.col("most")).alias("largest"))


@query("drop_column_selection", "SELECT CAST(unnest(range(1, 19)) AS INT) AS level, true AS marked, f.feature FROM (SELECT unnest(["
       + ", ".join(f"'{c}'" for c in NUMERIC) + "]) AS feature) f")
def drop_column_selection(spark, sf):
    """Every group of every question, marked where leaving it out lowers the loss on the fold that is held out."""
    rows, names = training_rows(spark, sf)
    groups = {c: [i for i, n in enumerate(names) if c in n] for c in NUMERIC}
    spec = T.ModelSpec("logistic", "logistic", {"maxIter": 2, "regParam": 0.1})
    out = T.drop_column_selection(rows, names, spec, LEVELS, 0, groups, 8)
    return out.select("level", "feature", (F.col("drop") == (F.col("log_loss") < F.col("baseline"))).alias("marked"))


@query("hyperparam_search", "SELECT CAST(level AS INT) AS level, CAST(rung AS INT) AS rung, CAST(CASE rung WHEN 0 THEN 3 ELSE 1 END AS INT) AS n_trials,"
       " CAST(rung AS INT) AS n_best, true AS survivors FROM (SELECT unnest(range(1, 19)) AS level), (SELECT unnest(range(2)) AS rung)")
def hyperparam_search(spark, sf):
    """Three trials for every question, of which the best goes on to its whole budget: it had the largest AUC of its rung."""
    rows, _ = training_rows(spark, sf)
    space = {"stepSize": ("log", 0.02, 0.1), "maxIter": ("int", 1, 2), "maxDepth": ("int", 1, 2),
             "subsamplingRate": ("uniform", 0.4, 0.8), "featureSubset": ("uniform", 0.2, 0.6)}
    trials = T.hyperparam_search(rows, LEVELS, 3, space, N_FOLDS, parallelism=8, budgets=(0.5, 1.0))
    on = trials.where("rung = 1").select("level", "trial", F.lit(True).alias("_on"))
    rungs = trials.join(on, ["level", "trial"], "left").groupBy("level", "rung").agg(
        F.count(F.lit(1)).cast("int").alias("n_trials"), F.count_if("best").cast("int").alias("n_best"),
        (F.max(F.when(F.col("_on"), F.col("auc"))) == F.max("auc")).alias("survivors"))
    return rungs


# Stacking.

_INPUTS = ["p1", "p2", "p3", "p4"]


def _ridge_sql() -> str:
    """CTE ``coef`` (level, fold, intercept, c0..c3): centred normal equations, solved by elimination."""
    n = range(4)
    upper = [(i, j) for i in n for j in n if j >= i]
    x = [f"p{i + 1}" for i in n]
    sums = (["count(*)*1.0e0 AS n", "sum(y)*1.0e0 AS sy"] + [f"sum({x[i]}) AS s{i}" for i in n]
            + [f"sum({x[i]}*y) AS sy{i}" for i in n] + [f"sum({x[i]}*{x[j]}) AS s{i}_{j}" for i, j in upper])
    names = [s.split(" AS ")[1] for s in sums]
    sql = f", m AS (SELECT level, fold, {', '.join(sums)} FROM s GROUP BY level, fold)"
    sql += (", tr AS (SELECT m.level, m.fold, " + ", ".join(f"t.{c} - m.{c} AS {c}" for c in names)
            + " FROM m JOIN (SELECT level, " + ", ".join(f"sum({c}) AS {c}" for c in names) + " FROM m GROUP BY level) t"
              " ON t.level = m.level WHERE t.n - m.n > 0)")
    gram = ", ".join(f"s{min(i, j)}_{max(i, j)} - s{i}*s{j}/n + {1.0 if i == j else 0.0} AS a{i}_{j}" for i in n for j in n)
    cross = ", ".join(f"sy{i} - s{i}*sy/n AS a{i}_4" for i in n)
    keep = "level, fold, n, sy, s0, s1, s2, s3"
    sql += f", e0 AS (SELECT {keep}, {gram}, {cross} FROM tr)"
    for p in n:
        cells = [f"a{i}_{j}/a{p}_{p} AS a{i}_{j}" if i == p else f"a{i}_{j} - a{i}_{p}/a{p}_{p}*a{p}_{j} AS a{i}_{j}"
                 for i in n for j in range(5)]
        sql += f", e{p + 1} AS (SELECT {keep}, {', '.join(cells)} FROM e{p})"
    return sql + (", coef AS (SELECT level, fold, sy/n - (a0_4*s0 + a1_4*s1 + a2_4*s2 + a3_4*s3)/n AS intercept, "
                  + ", ".join(f"a{i}_4 AS c{i}" for i in n) + " FROM e4)\n")


@query("stack_ridge", "WITH " + SCORES + _ridge_sql() + "SELECT level, fold, " + r("intercept", "intercept", 6) + ", "
       + ", ".join(r(f"c{i}", f"c{i}", 6) for i in range(4)) + " FROM coef")
def stack_ridge(spark, sf):
    out = K.ridge_stack(scores(spark, sf), _INPUTS)
    return rounded(out.select("level", "fold", "intercept", *[F.col("coef")[i].alias(f"c{i}") for i in range(4)]), 6)


@query("stack_predict", "WITH " + SCORES + _ridge_sql() + "SELECT s.id, s.level, s.fold, s.y, "
       + r("intercept + c0*p1 + c1*p2 + c2*p3 + c3*p4", "p", 6)
       + " FROM s JOIN coef ON coef.level = s.level AND coef.fold = s.fold")
def stack_predict(spark, sf):
    s = scores(spark, sf)
    out = K.apply_stack(s, K.ridge_stack(s, _INPUTS), _INPUTS, ["level", "fold"])
    return rounded(out.select("id", "level", "fold", "y", "p"), 6)


@query("ensemble_score", "WITH " + SCORES + _ridge_sql() + ", e AS (SELECT s.id AS session, s.level,"
       " avg(intercept + c0*p1 + c1*p2 + c2*p3 + c3*p4) AS p FROM s JOIN coef ON coef.level = s.level GROUP BY s.id, s.level)"
       " SELECT session, level, " + r("p", "p", 6) + ", CASE WHEN p >= 0.63e0 THEN 1 ELSE 0 END AS correct FROM e")
def ensemble_score(spark, sf):
    predictions = scores_long(spark, sf).withColumnRenamed("id", "session")
    coefs = K.ridge_stack(scores(spark, sf), _INPUTS)
    return rounded(K.ensemble_score(predictions, coefs, _INPUTS, 0.63), 6)


_RUN_SPECS = [
    T.ModelSpec("ridge_low", "ridge", {"regParam": 0.1}, balanced=True),
    T.ModelSpec("ridge_high", "ridge", {"regParam": 1.0}),
]
_RUNS: dict[tuple, Layout] = {}


def stored_run(spark, sf):
    """The batch run, once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        log, hot = event_log(spark, sf)
        out = Layout(scratch(spark, "run"))
        train(log, question_labels(spark, sf), _RUN_SPECS, out, LEVELS, N_FOLDS, parallelism=8, hot=hot)
        _RUNS[key] = out
    return _RUNS[key]


@query("train_all", "SELECT scope, CAST(level AS INT) AS level, true AS in_range FROM (SELECT unnest(['ridge_low', 'ridge_high', 'stack']) AS scope)"
       " CROSS JOIN (SELECT unnest(range(1, 19)) AS level UNION ALL SELECT NULL)")
def train_all(spark, sf):
    """The scores of a run: each model and the stack, each question and over all."""
    scores_table = S.read_table(spark, stored_run(spark, sf).scores)
    in_range = F.col("score").between(0.0, 1.0) & F.col("threshold").between(0.0, 1.0)
    return scores_table.select("scope", "level", in_range.alias("in_range"))


#: Every question of the run, of every session whose phase has events.
_SCORED = "WITH " + LABELS + GLOG.replace("WITH e AS", ", e AS", 1) + (
    "SELECT session, level, true AS {fact} FROM lab WHERE (session, level_group) IN (SELECT session_id, level_group FROM glog)")


@query("score_run", _SCORED.format(fact="decided"))
def score_run(spark, sf):
    """Predictions of the stored run: vocabulary, catalogue, models, stackers and threshold are read back."""
    run = StoredRun(spark, stored_run(spark, sf), [s.name for s in _RUN_SPECS], N_FOLDS)
    log, hot = event_log(spark, sf)
    out = score(run, log, hot)
    return out.select("session", "level", (F.col("correct") == (F.col("p") >= run.threshold).cast("int")).alias("decided"))


# Streams.

def stream_session(spark):
    """A session of its own for stream settings: as many state partitions as there are cores."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return own


def replayed(spark, sf, variant="plain", slices=1):
    log, hot = event_log(spark, sf, variant)
    stored, path = scratch(spark, "log"), scratch(spark, "stream")
    S.write_events(log, stored)  # by phase, as the replay reads it
    log = S.read_table(spark, stored)
    SF.replay(log, path, slices=slices)
    return log, hot, path


def finished(streaming_query):
    streaming_query.awaitTermination()
    if streaming_query.exception():
        raise streaming_query.exception()


_STREAMED = ["session_id", "index", "elapsed_time", "event_name", "level", "text", "level_group", "event_id"]


@query("stream_source", GLOG + "SELECT " + ", ".join(f'"{c}"' for c in _STREAMED) + " FROM glog")
def stream_source(spark, sf):
    own = stream_session(spark)
    _, _, path = replayed(own, sf)
    out = scratch(spark, "out")
    events = SF.read_stream(own, path, files_per_trigger=4).where(~F.col("is_request")).drop("is_request")
    finished(SF.write_stream(events, out, scratch(spark, "checkpoint")))
    return spark.read.parquet(out).select(*_STREAMED)


@query("stream_sink", GLOG + "SELECT level_group, count(*) AS n, CAST(sum(elapsed_time) AS BIGINT) AS elapsed FROM glog GROUP BY level_group")
def stream_sink(spark, sf):
    own = stream_session(spark)
    _, _, path = replayed(own, sf)
    out = scratch(spark, "out")
    events = SF.read_stream(own, path, files_per_trigger=4).where(~F.col("is_request")).drop("is_request")
    finished(SF.write_stream(events, out, scratch(spark, "checkpoint"), [PHASE]))
    return spark.read.parquet(out).groupBy(PHASE).agg(F.count(F.lit(1)).alias("n"), F.sum("elapsed_time").alias("elapsed"))


def run_stream(spark, sf, featurize_from_log, variant="plain", predict=None, files=4):
    own = stream_session(spark)
    log, _, path = replayed(own, sf, variant)
    out = scratch(spark, "out")
    store = FeatureStore(f"{out}/store")
    finished(score_stream(SF.read_stream(own, path, files_per_trigger=files), store, featurize_from_log(own, log), out,
                          scratch(spark, "checkpoint"), predict))
    return out, store


@query("stream_features", GLOG + FEATURES_LONG + f"SELECT {SG}, feature, " + r("value", "value", 3)
       + " FROM feats WHERE value IS NOT NULL")
def stream_features(spark, sf):
    def featurize_from_log(own, log):
        vocab = stored_vocab(own, log)
        return lambda events, phase: session_features(events, phase, vocab, hot=None)

    out, store = run_stream(spark, sf, featurize_from_log)
    parts = [features_long(spark.read.parquet(store.folder(p)).drop("batch")) for p in PHASES]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 3)


_BASIC = ["elapsed_sum", "elapsed_mean", "elapsed_max", "elapsed_min"]


@query("stateful_carry_forward", glog("missing_phase") + ", f AS (SELECT session_id, level_group, CAST(sum(elapsed_time) AS BIGINT) AS elapsed_sum,"
       " round(avg(elapsed_time), 4) + 0.0 AS elapsed_mean, max(elapsed_time) AS elapsed_max, min(elapsed_time) AS elapsed_min"
       " FROM glog GROUP BY session_id, level_group) SELECT f2.session_id, "
       + ", ".join(f"f{g}.{c} AS g{g}_{c}" for g in range(3) for c in _BASIC)
       + " FROM (SELECT * FROM f WHERE level_group='13-22') f2"
         " LEFT JOIN (SELECT * FROM f WHERE level_group='0-4') f0 ON f0.session_id = f2.session_id"
         " LEFT JOIN (SELECT * FROM f WHERE level_group='5-12') f1 ON f1.session_id = f2.session_id")
def stateful_carry_forward(spark, sf):
    out, _ = run_stream(spark, sf, lambda own, log: (lambda events, phase: A.elapsed_basic(events)), "missing_phase")
    return rounded(spark.read.parquet(f"{out}/rows/phase=2").drop("batch", PHASE))


@query("stream_score", _SCORED.format(fact="as_in_batch"))
def stream_score(spark, sf):
    """The stored run on the stream gives what it gives in batch."""
    run = StoredRun(spark, stored_run(spark, sf), [s.name for s in _RUN_SPECS], N_FOLDS)
    log, hot = event_log(spark, sf)
    out, _ = run_stream(spark, sf, lambda own, log: (lambda events, phase: run.features(events, phase, None)), predict=run.predict, files=1000)
    batch = score(run, log, hot).select("session", "level", F.col("p").alias("_p"), F.col("correct").alias("_correct"))
    both = spark.read.parquet(f"{out}/predictions").join(batch, ["session", "level"], "left")
    same = (F.abs(F.col("p") - F.col("_p")) < 1e-9) & (F.col("correct") == F.col("_correct"))
    return both.select("session", "level", F.coalesce(same, F.lit(False)).alias("as_in_batch"))
