"""Registry of queries: a Spark callable and, where SQL can express it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All doubles rounded, as the SQL twins do, so that sums in another order compare equal."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def r(expr: str, alias: str, digits: int = 4) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {alias}"


_HEAD = """WITH e AS (SELECT event_id, user_id, event_type, value,
  CAST(json_extract_string(props,'$.k') AS INT) AS k,
  epoch_us(ts)//1000 AS ms
FROM events)
, b AS (SELECT *,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS idx,
    CAST(count(*) OVER (PARTITION BY user_id) AS INT) AS n,
    ms - min(ms) OVER (PARTITION BY user_id) AS el FROM e)
"""

_GLOG = """, l AS (SELECT *, CAST({level} AS INT) AS lvl, CAST({index} AS INT) AS ix FROM b)
, glog AS (SELECT user_id AS session_id, ix AS "index", el AS elapsed_time,
    CASE event_type WHEN 'click' THEN 'navigate_click' ELSE event_type END AS event_name,
    CASE k%3 WHEN 0 THEN 'basic' WHEN 1 THEN 'open' END AS name,
    lvl AS level,
    CASE WHEN k%5=0 THEN CAST(k%7 AS DOUBLE) END AS page,
    CASE WHEN k%8<>0 THEN value*10-500 END AS room_coor_x,
    CASE WHEN k%8<>0 THEN 300-value*7 END AS room_coor_y,
    CASE WHEN k%8<>0 THEN CAST(k*8 AS DOUBLE) END AS screen_coor_x,
    CASE WHEN k%8<>0 THEN CAST((99-k)*6 AS DOUBLE) END AS screen_coor_y,
    CASE WHEN event_type='view' THEN value*100 END AS hover_duration,
    CASE k%6 WHEN 0 THEN 'Here''s the log book.'
             WHEN 1 THEN 'Oh no, I need to find the notebook!'
             WHEN 2 THEN 'Ooh, this flag is it. Found you, Jo!'
             WHEN 3 THEN 'Can Wells help and that?'
             WHEN 4 THEN 'wells found it' END AS text,
    CASE k%10 WHEN 0 THEN NULL
              WHEN 1 THEN 'logbook.page.bingo'
              WHEN 2 THEN 'reader'
              WHEN 3 THEN 'reader.paper2.bingo'
              WHEN 4 THEN 'journals'
              WHEN 5 THEN 'journals.pic_2.bingo'
              WHEN 6 THEN 'reader_flag'
              WHEN 7 THEN 'tunic.library.microfiche.reader_flag.paper2.bingo'
              WHEN 8 THEN 'journals_flag'
              ELSE 'journals_flag.pic_0.bingo' END AS fqid,
    concat('tunic.loc', CAST(k%3 AS VARCHAR(9)), '.room', CAST(k%5 AS VARCHAR(9))) AS room_fqid,
    CASE WHEN k%4=0 THEN concat('tunic.loc', CAST(k%3 AS VARCHAR(9)), '.t', CAST(k%4 AS VARCHAR(9))) END AS text_fqid,
    CAST(NULL AS INT) AS fullscreen, CAST(NULL AS INT) AS hq, CAST(NULL AS INT) AS music,
    CASE WHEN lvl<=4 THEN '0-4' WHEN lvl<=12 THEN '5-12' ELSE '13-22' END AS level_group,
    event_id, k FROM l{where})
"""


def glog(variant: str = "plain") -> str:
    """``WITH ... glog AS (...)``: the event log as DuckDB CTEs."""
    level, index, where = "(idx*23 - (idx*23) % n)/n", "idx", ""
    if variant == "replay":
        level = "((idx%45)*23 - ((idx%45)*23)%45)/45"
    elif variant == "shuffled":
        index = "idx - idx%7 + (idx*3)%7"
    elif variant == "duplicated":
        index = "CASE WHEN user_id%10=0 THEN idx - idx%2 ELSE idx END"
    elif variant == "missing_phase":
        where = " WHERE NOT (lvl<=4 AND user_id%6=0)"
    return _HEAD + _GLOG.format(level=level, index=index, where=where)


GLOG = glog()

#: The event log with its differences, as ``d``.
DIFFS = """, d AS (SELECT *,
    CAST(least(greatest(coalesce(elapsed_time - lag(elapsed_time) OVER w, 0), 0), 1000000000) AS BIGINT) AS elapsed_time_diff,
    abs(screen_coor_x - lag(screen_coor_x) OVER w) AS location_x_diff,
    abs(screen_coor_y - lag(screen_coor_y) OVER w) AS location_y_diff
  FROM glog WINDOW w AS (PARTITION BY session_id, level_group ORDER BY "index", elapsed_time, event_id))
"""

QLABELS = """SELECT concat(CAST(u.session_id AS VARCHAR(20)), '_q', CAST(q.q AS VARCHAR(20))) AS session_id,
  CASE WHEN (u.session_id*7+q.q*13)%10 < 4+u.session_id%5 THEN 1 ELSE 0 END AS correct
FROM (SELECT DISTINCT user_id AS session_id FROM events) u CROSS JOIN (SELECT unnest(range(1,19)) AS q) q"""

LABELS = f"""ql AS ({QLABELS})
, pl AS (SELECT session_id, correct, CAST(regexp_extract(session_id, '(\\d+)', 1) AS BIGINT) AS session,
    CAST(regexp_extract(session_id, 'q(\\d+)', 1) AS INT) AS level FROM ql)
, lab AS (SELECT *, CASE WHEN level < 4 THEN '0-4' WHEN level < 14 THEN '5-12' ELSE '13-22' END AS level_group FROM pl)
"""

#: Folds of the labels' sessions; follows ``LABELS``.
FOLDS = """, prof AS (SELECT session, count(*) AS n_rows, sum(correct) AS n_pos FROM lab GROUP BY session)
, folds AS (SELECT session, CAST((row_number() OVER (PARTITION BY n_rows, n_pos
      ORDER BY md5(concat('42:', CAST(session AS VARCHAR))), session) - 1 + n_rows + n_pos) % 5 AS INT) AS fold FROM prof)
"""

SCORES = """s AS (SELECT l.doc_id AS id, l.doc_id % 18 + 1 AS level, l.doc_id % 5 AS fold, l.quality AS y,
  least(1.0e0, d.n_chars/4000.0e0) AS p1,
  (l.doc_id*37 % 101)/101.0e0 AS p2,
  least(1.0e0, 0.6e0*l.quality + (l.doc_id*17 % 53)/106.0e0) AS p3,
  1.0e0 - l.toxic*0.5e0 - (l.doc_id*29 % 31)/93.0e0 AS p4
FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""

#: One row per score and model; follows ``SCORES``.
SCORES_LONG = ", sl AS (" + " UNION ALL ".join(
    f"SELECT id, level, fold, y, 'p{i}' AS model, p{i} AS p FROM s" for i in (1, 2, 3, 4)) + ")\n"

GRID = ", grid AS (SELECT i, i*(1.0e0/99) AS t FROM (SELECT unnest(range(100)) AS i))\n"

MACRO_F1 = """((CASE WHEN 2*tp+fp+fn > 0 THEN 2.0e0*tp/(2*tp+fp+fn) ELSE 0 END
   + CASE WHEN 2*tn+fp+fn > 0 THEN 2.0e0*tn/(2*tn+fp+fn) ELSE 0 END)
  / (CASE WHEN 2*tp+fp+fn > 0 THEN 1 ELSE 0 END + CASE WHEN 2*tn+fp+fn > 0 THEN 1 ELSE 0 END))"""


def cells(p: str = "p", y: str = "y", t: str = "t", op: str = ">=") -> str:
    hit = f"{p} {op} {t}"
    return (f"sum(CASE WHEN {hit} THEN {y} ELSE 0 END) AS tp, sum(CASE WHEN {hit} THEN 1-{y} ELSE 0 END) AS fp, "
            f"sum(CASE WHEN {hit} THEN 0 ELSE {y} END) AS fn, sum(CASE WHEN {hit} THEN 0 ELSE 1-{y} END) AS tn")


def sweep_sql(by: str = "", source: str = "s", p: str = "p1", op: str = ">=") -> str:
    """CTE ``sw``: counts and score per threshold; follows ``SCORES`` and ``GRID``."""
    cols = f"{by}, " if by else ""
    return (f", cnt AS (SELECT {cols}i, t, {cells(p, op=op)} FROM {source} CROSS JOIN grid GROUP BY {cols}i, t)\n"
            f", sw AS (SELECT *, {MACRO_F1} AS score FROM cnt)\n")


CATEGORIES = ["event_name", "name", "fqid", "room_fqid", "text_fqid", "level", "page"]


def category_sql(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), '{column}_null')"


def melt_sql(source: str, keep: str, columns: list[str], value=category_sql) -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}, '{c}' AS \"column\", {value(c)} AS value FROM {source}" for c in columns)


_METRIC_STATS = ", ".join(
    f"sum({m}) AS {m}_sum, avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std, max({m}) AS {m}_max, min({m}) AS {m}_min"
    for m in ("elapsed_time_diff", "hover_duration"))

#: Statistics per category value, as ``tall``; follows ``DIFFS``.
TALL = (", cat AS (" + melt_sql("d", "session_id, level_group, elapsed_time_diff, hover_duration", CATEGORIES) + ")\n"
        ", tall AS (SELECT session_id, level_group, \"column\", value, count(*) AS n, " + _METRIC_STATS
        + " FROM cat GROUP BY session_id, level_group, \"column\", value)\n")

VOCAB_COLUMNS = ["event_name", "name", "text", "fqid", "room_fqid", "text_fqid", "page", "level"]

#: Vocabulary per phase, as ``vocab``; follows ``GLOG``.
VOCAB = (", vals AS (SELECT DISTINCT * FROM ("
         + melt_sql("glog", "level_group", VOCAB_COLUMNS, lambda c: f"CAST({c} AS VARCHAR)")
         + ") WHERE value IS NOT NULL)\n"
         ", vocab AS (SELECT level_group, \"column\", value, CAST(row_number() OVER "
         "(PARTITION BY level_group, \"column\" ORDER BY value) - 1 AS INT) AS pos FROM vals)\n")
