"""Token vectors, nearest rows and sketches against dense and exact computations."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtrace.operators import cooccurrence as C
from playtrace.operators import sequences as Q
from playtrace.operators import sketches as K
from playtrace.operators.stats import nunique, quantile_name
from playtrace.schema import SESSION


def sessions(spark, n=12, seed=2, longest=60):
    rnd = random.Random(seed)
    given = []
    for s in range(n):
        for i in range(rnd.randint(0, longest)):
            given.append((s, i, i * 10, s * 1000 + i, rnd.choice("aabbccdeeefg") if rnd.random() < 0.9 else None))
    return given, spark.createDataFrame(given, f"{SESSION} long, `index` int, elapsed_time long, event_id long, token string").repartition(4)


def brute_pairs(given, window):
    lists = collections.defaultdict(list)
    for s, i, _, _, token in sorted(given):
        if token is not None:
            lists[s].append(token)
    out = collections.Counter()
    for tokens in lists.values():
        for i, a in enumerate(tokens):
            for b in tokens[i + 1:i + 1 + window]:
                out[a, b] += 1
                out[b, a] += 1
    return out


@pytest.mark.parametrize("piece", [3, 7, 10_000])
def test_pairs_within_a_window(spark, piece):
    given, events = sessions(spark)
    got = {(r["a"], r["b"]): r["n"] for r in C.pair_counts(events, "token", 3, piece=piece, hot=None).collect()}
    assert got == brute_pairs(given, 3)


def test_a_hot_session_counts_as_any_other(spark):
    given, events = sessions(spark, 3, longest=200)
    hot = spark.createDataFrame([(0,), (2,)], f"{SESSION} long")
    got = {(r["a"], r["b"]): r["n"] for r in C.pair_counts(events, "token", 5, piece=16, hot=hot).collect()}
    assert got == brute_pairs(given, 5)


def test_factors_of_the_information(spark):
    given, events = sessions(spark, 40, seed=5)
    counts = brute_pairs(given, 5)
    words = sorted({a for a, _ in counts})
    n = np.array([[counts[a, b] for b in words] for a in words], float)
    with np.errstate(divide="ignore"):
        want = np.maximum(0, np.log(n * n.sum() / np.outer(n.sum(1), n.sum(0))))
    table = C.positive_information(C.pair_counts(events, "token", 5, hot=None))
    got = {(r["a"], r["b"]): r["m"] for r in table.collect()}
    assert {k: pytest.approx(want[words.index(k[0]), words.index(k[1])]) for k in got} == got and len(got) == (want > 0).sum()
    values, vectors = np.linalg.eigh(want)
    order = np.argsort(-np.abs(values))[:2]
    best = vectors[:, order] * np.sqrt(np.abs(values[order]))
    out = {r["word"]: r["vector"] for r in C.factor(table, 2, turns=8).collect()}
    mine = np.array([out.get(w, [0, 0]) for w in words])
    assert np.abs(np.abs(mine.T @ best) - np.abs(best.T @ best)).max() < 1e-3
    again = {r["word"]: r["vector"] for r in C.factor(table.repartition(7), 2, turns=8).collect()}
    assert all(np.allclose(out[w], again[w]) for w in out)


def test_few_or_no_tokens(spark):
    _, events = sessions(spark, 3)
    assert C.token_vectors(events.where("false"), "token").count() == 0
    two = C.token_vectors(events.where("token IN ('a', 'b')"), "token", dim=4).collect()
    assert all(len(r["vector"]) == 4 and all(map(math.isfinite, r["vector"])) for r in two)


@pytest.mark.parametrize("query_bytes", [1 << 20, 2_000])
@pytest.mark.parametrize("kind", ["string", "long"])
def test_nearest_rows_of_all_tokens(spark, monkeypatch, query_bytes, kind):
    monkeypatch.setattr(Q, "CELLS", 500)
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(120, 6))
    x[50:60] = x[40]  # ties
    x[7] = 0
    keys = [f"w{i}" if kind == "string" else i for i in range(len(x))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x)] + [(None if kind == "string" else 999, None)],
                               f"word {kind}, vector array<double>").repartition(5)
    u = x / np.where(np.linalg.norm(x, axis=1) == 0, 1, np.linalg.norm(x, axis=1))[:, None]
    sims = u @ u.T
    got = collections.defaultdict(list)
    for r in Q.nearest_vectors(df, None, 4, query_bytes=query_bytes).orderBy("token", "rank").collect():
        got[r["token"]].append((r["word"], r["similarity"]))
    assert len(got) == len(x)
    for i, k in enumerate(keys):
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (-round(sims[i, j], 12), keys[j]))[:4]
        assert [round(s, 9) for _, s in got[k]] == [round(sims[i, j], 9) for j in order]
    some = Q.similar_tokens(df, [keys[3], keys[55]], 3)
    assert {r["token"] for r in some.collect()} == {keys[3], keys[55]} and some.count() == 6
    assert Q.nearest_vectors(df.where("false")).count() == 0


def test_sketches_merge_and_stay_within_their_bounds(spark):
    rnd = random.Random(9)
    given = [(i % 3, "0-4", rnd.lognormvariate(0, 2) if i % 11 else None, f"t{rnd.randint(0, 3_000)}", i % 2) for i in range(30_000)]
    df = spark.createDataFrame(given, f"{SESSION} long, level_group string, x double, name string, half int")
    keys = [SESSION]
    whole = K.sketches(df, ["x"], ["name"], keys)
    halves = K.sketches(df, ["x"], ["name"], [SESSION, "half"])
    qs = ["0.1", "0.5", "0.9"]
    exact = {r[SESSION]: r["name_nunique"] for r in nunique(df, ["name"], keys).collect()}
    for stored in (whole, K.merged(halves, keys)):
        for r in K.approximate(stored, keys, qs).collect():
            own = sorted(x for s, _, x, _, _ in given if s == r[SESSION] and x is not None)
            for q in qs:
                rank = np.searchsorted(own, r[quantile_name("x", q)]) / len(own)
                assert abs(rank - float(q)) < 0.02
            assert abs(r["name_nunique"] / exact[r[SESSION]] - 1) < 0.08
    assert K.approximate(K.merged(halves, []), [], qs).count() == 1
    empty = K.sketches(df.withColumn("x", F.lit(None).cast("double")), ["x"], ["name"], keys)
    assert K.approximate(empty, keys, qs).first()[quantile_name("x", "0.5")] is None
