"""Run queries and their SQL twins side by side: ``python tests/compare.py <sf_dir> [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else repr(v + 0.0))
    if isinstance(v, int):
        return (3, str(v))
    if hasattr(v, "as_tuple"):
        return (3, str(v))
    return (4, str(v))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, fn, sql, sf_dir):
    """``None`` if both give the same rows, else a short description of the difference."""
    df = fn(spark, sf_dir)
    got = _rows(df.columns, [tuple(x) for x in df.collect()])
    res = con.execute(sql)
    want = _rows([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(got[0], a, b) if x != y][:4]
        return f"{len(bad)} of {len(got[1])} rows differ, e.g. {cells} in {a[:6]}"
    return None


def session(cpus: str = "8"):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, queries[name], oracle[name], sf_dir)
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as ex:  # noqa: BLE001
            problem = f"{type(ex).__name__}: {str(ex)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {'sql ' if name in oracle else 'rows'}"
              f" {time.time() - start:6.1f}s {problem or ''}", flush=True)
    print(f"{len(names or queries)} queries, {failed} failed")
