"""The library's inputs, derived from the test tables ``events``, ``labels`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtrace.functions.columns import level_phase
from playtrace.operators.labels import assign_phase, parse_labels
from playtrace.plans.skew import bounded_broadcast, by_heat, find_hot, with_row_number
from playtrace.schema import SESSION

TEXTS = [
    "Here's the log book.", "Oh no, I need to find the notebook!", "Ooh, this flag is it. Found you, Jo!",
    "Can Wells help and that?", "wells found it",
]
FQIDS = [
    None, "logbook.page.bingo", "reader", "reader.paper2.bingo", "journals", "journals.pic_2.bingo", "reader_flag",
    "tunic.library.microfiche.reader_flag.paper2.bingo", "journals_flag", "journals_flag.pic_0.bingo",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number, values):
    expr = F
    for i, v in enumerate(values):
        expr = expr.when(number == i, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def event_log(spark: SparkSession, sf_dir: str, variant: str = "plain") -> tuple[DataFrame, DataFrame | None]:
    """``(event log, hot sessions or None)``. Whether any user is hot is measured once, on the raw table."""
    raw = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    hot = find_hot(raw, ["user_id"])
    e = raw.select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000").alias("ms"))
    key = Window.partitionBy("user_id")

    def ordinary(d: DataFrame) -> DataFrame:
        numbered = with_row_number(d, ["user_id"], ["event_id"], "_rn", total="n", hot=None)
        return numbered.withColumn("start", F.min("ms").over(key))

    def heavy(d: DataFrame) -> DataFrame:
        numbered = with_row_number(d, ["user_id"], ["event_id"], "_rn", total="n", hot=hot)
        return numbered.join(bounded_broadcast(d.groupBy("user_id").agg(F.min("ms").alias("start"))), "user_id")

    b = by_heat(e, ["user_id"], hot, ordinary, heavy).withColumn("idx", (F.col("_rn") - 1).cast("int"))
    n, idx, k, value = F.col("n").cast("int"), F.col("idx"), F.col("k"), F.col("value")
    level = F.floor(idx * 23 / n).cast("int")
    index = idx
    if variant == "replay":
        level = F.floor((idx % 45) * 23 / 45).cast("int")
    elif variant == "shuffled":
        index = (idx - idx % 7 + (idx * 3) % 7).cast("int")
    elif variant == "duplicated":
        index = F.when(F.col("user_id") % 10 == 0, idx - idx % 2).otherwise(idx).cast("int")
    click = k % 8 != 0
    log = b.select(
        F.col("user_id").alias(SESSION), index.alias("index"), (F.col("ms") - F.col("start")).alias("elapsed_time"),
        F.when(F.col("event_type") == "click", "navigate_click").otherwise(F.col("event_type")).alias("event_name"),
        _pick(k % 3, ["basic", "open"]).alias("name"),
        level.alias("level"),
        F.when(k % 5 == 0, (k % 7).cast("double")).alias("page"),
        F.when(click, value * 10 - 500).alias("room_coor_x"),
        F.when(click, 300 - value * 7).alias("room_coor_y"),
        F.when(click, (k * 8).cast("double")).alias("screen_coor_x"),
        F.when(click, ((99 - k) * 6).cast("double")).alias("screen_coor_y"),
        F.when(F.col("event_type") == "view", value * 100).alias("hover_duration"),
        _pick(k % 6, TEXTS).alias("text"),
        _pick(k % 10, FQIDS).alias("fqid"),
        F.concat(F.lit("tunic.loc"), (k % 3).cast("string"), F.lit(".room"), (k % 5).cast("string")).alias("room_fqid"),
        F.when(k % 4 == 0, F.concat(
            F.lit("tunic.loc"), (k % 3).cast("string"), F.lit(".t"), (k % 4).cast("string"))).alias("text_fqid"),
        F.lit(None).cast("int").alias("fullscreen"), F.lit(None).cast("int").alias("hq"),
        F.lit(None).cast("int").alias("music"),
        level_phase(F.floor(idx * 23 / n) if variant == "replay" else level).alias("level_group"),
        "event_id", "k")
    if variant == "missing_phase":
        log = log.where(~((F.col("level_group") == "0-4") & (F.col(SESSION) % 6 == 0)))
    return log, hot if hot is None else hot.withColumnRenamed("user_id", SESSION)


def question_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """18 label rows ``<session>_q<n>`` per user."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("s")).distinct()
    q = F.explode(F.sequence(F.lit(1), F.lit(18)))
    s = F.col("s")
    return users.select("s", q.alias("q")).select(
        F.concat(s.cast("string"), F.lit("_q"), F.col("q").cast("string")).alias("session_id"),
        F.when((s * 7 + F.col("q") * 13) % 10 < 4 + s % 5, 1).otherwise(0).alias("correct"))


def parsed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_phase(parse_labels(question_labels(spark, sf_dir)))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with four pseudo-models ``p1..p4``."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    i = F.col("doc_id")
    return labels.join(documents, "doc_id").select(
        i.alias("id"), (i % 18 + 1).alias("level"), (i % 5).alias("fold"), F.col("quality").alias("y"),
        F.least(F.lit(1.0), F.col("n_chars") / F.lit(4000.0)).alias("p1"),
        ((i * 37 % 101) / F.lit(101.0)).alias("p2"),
        F.least(F.lit(1.0), F.lit(0.6) * F.col("quality") + (i * 17 % 53) / F.lit(106.0)).alias("p3"),
        (F.lit(1.0) - F.col("toxic") * F.lit(0.5) - (i * 29 % 31) / F.lit(93.0)).alias("p4"))


def scores_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same predictions keyed by model."""
    s = scores(spark, sf_dir)
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in ("p1", "p2", "p3", "p4")])
    return s.select("id", "level", "fold", "y", F.inline(pairs))
