"""Near duplicates, language-model scores and the pipeline against brute force, on awkward documents and hot groups."""

import collections
import math
import random
import zlib

import corpus_pipeline
import llm_fixtures as fx
import numpy as np
import pytest
from playtrace.llm import lm, near_dup, packing, queries, vector_dup
from playtrace.llm.components import components
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark).cache()


def union(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(rnd.randint(500, 900), rnd.randint(500, 900)) for _ in range(250)]
    df = spark.createDataFrame([(b, a) for a, b in links] + links[:50] + [(5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    want = union(1000, links)
    assert got == {i: want[i] for pair in links for i in pair if pair[0] != pair[1]}
    assert components(df.where("a < 0")).count() == 0


def shingle_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_roots(rows):
    """A number for each row, equal where texts are connected by equality or by a plain similarity of 0.8."""
    texts = sorted({r[1] or "" for r in rows})
    sets = shingle_sets(texts)
    links = []
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                links.append((a, b))
    root = dict(zip(texts, union(len(texts), links)))
    return [root[t or ""] for _, t, *_ in rows]


def brute_classes(rows):
    """Class id of each row: the smallest id of its class."""
    least, roots = {}, brute_roots(rows)
    for (i, *_), k in zip(rows, roots):
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return [least[k] for k in roots]


def test_near_duplicates(docs):
    got = near_dup.near_duplicates(docs)
    want = collections.Counter(repr((r[0], c)) for r, c in zip(fx.rows(), brute_classes(fx.rows())))
    assert collections.Counter(repr((r["doc_id"], r["class_id"])) for r in got.collect()) == want
    assert {r["doc_id"] for r in got.where("kept").collect()} == set(brute_classes(fx.rows()))


def test_one_document_of_each_class_stays(docs):
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    by_class = collections.Counter(brute_classes(fx.rows()))
    assert collections.Counter(ids)[200] == 1 and not set(range(201, 215)) & set(ids)
    assert 300 not in ids and ids.count(21 + 4) == 1
    assert len(ids) == len(set(brute_roots(fx.rows())))
    assert set(ids) == set(by_class)


def test_a_group_of_near_copies_above_the_tile_size(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 8)
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = []
    for g in range(3):
        base = [word() for _ in range(80)]
        rows.append((1000 * g, " ".join(base), "en", "s", 1))
        for k in range(1, 40):  # each within 0.8 of the base, many not of each other
            own = list(base)
            own[rnd.randrange(80)] = word()
            own[rnd.choice([0, 79, 40])] = word()
            rows.append((1000 * g + k, " ".join(own), "en", "s", 1))
    rows += [(5000 + i, " ".join(word() for _ in range(60)), "en", "s", 1) for i in range(60)]
    want = {r[0]: c for r, c in zip(rows, brute_classes(rows))}
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(fx.documents(spark, rows, False)).collect()}
    assert got == want


def test_copies_with_repeated_lines(spark):
    """Plain similarity above 0.9, weighted similarity about a third."""
    rnd = random.Random(15)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = []
    for g in range(40):
        base = [word() for _ in range(104)]
        rows.append((10 * g, " ".join(base), "en", "s", 1))
        rows.append((10 * g + 1, " ".join(base + base[-20:] * 10), "en", "s", 1))
    want = {r[0]: c for r, c in zip(rows, brute_classes(rows))}
    assert all(want[i] == i // 10 * 10 for i in want)
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(fx.documents(spark, rows, False)).collect()}
    assert got == want


def test_similarity_is_the_weighted_jaccard():
    rnd = random.Random(9)
    idf = near_dup.idf_table(np.clip(np.random.default_rng(0).integers(1, 50, near_dup.SKETCH).astype(float), 1, 50), 50)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))).encode() for _ in range(12)] + [b"x y"]
    weighted, plain = near_dup.similarity(texts, idf)
    one = [near_dup._elements([t]) for t in texts]
    bags = [dict(zip(h.tolist(), (c * idf[(h & np.uint64(near_dup.SKETCH - 1)).astype(int)]).tolist())) for h, _, c in one]
    for a, x in enumerate(bags):
        for b, y in enumerate(bags[:a]):
            low = sum(min(x[k], y[k]) for k in x.keys() & y.keys())
            high = sum(x.values()) + sum(y.values()) - low
            assert weighted[a, b] == pytest.approx(low / high if high else 0, abs=1e-5)
            assert plain[a, b] == pytest.approx(len(x.keys() & y.keys()) / max(len(x.keys() | y.keys()), 1))


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(3)
    h = near_dup.mix64(np.arange(1, 401, dtype=np.uint64))
    agree, expected = [], []
    for _ in range(40):
        x, y = rng.permutation(400)[:300], rng.permutation(400)[:300]
        wx, wy = rng.choice([1.0, 1.5, 3.0], 400), rng.choice([1.0, 1.5, 3.0], 400)
        monkey = near_dup.BANDS, near_dup.ROWS
        near_dup.BANDS, near_dup.ROWS = 40, 1
        try:
            _, a = near_dup.band_keys(h[x], np.zeros(300, np.int64), wx[x])
            _, b = near_dup.band_keys(h[y], np.zeros(300, np.int64), wy[y])
        finally:
            near_dup.BANDS, near_dup.ROWS = monkey
        full = np.zeros((2, 400))
        full[0, x], full[1, y] = wx[x], wy[y]
        agree.append((a == b).mean())
        expected.append(full.min(0).sum() / full.max(0).sum())
    assert np.mean(agree) == pytest.approx(np.mean(expected), abs=0.03)


def test_document_frequencies_hold_at_any_load():
    cells = np.full(near_dup.SKETCH, 140.0)
    cells[7] = 5140
    others = (cells.sum() - cells) / (near_dup.SKETCH - 1)
    assert np.clip(cells - others, 1, 10_000)[7] == pytest.approx(5000, abs=1)
    table = near_dup.idf_table(np.array([1.0, 100, 10_000]), 10_000)
    assert table.tolist() == pytest.approx([2, 1.5, 1])


# vectors

def vectors():
    rng = np.random.default_rng(6)
    out, base = [], rng.normal(size=(40, 16))
    for i in range(120):
        out.append((i, (base[i % 40] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35])).tolist(), i % 3))
    centre = rng.normal(size=16)
    out += [(1000 + i, (centre + rng.normal(size=16) * 0.08).tolist(), 0) for i in range(150)]
    out += [(2000 + i, out[5][1], 1) for i in range(4)] + [(2010, [4 * v for v in out[5][1]], 1), out[7], out[7]]
    out += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 16, 0), (3003, [float("nan")] + [1.0] * 15, 0),
            (3004, [None] + [1.0] * 15, 0), (3005, [float("inf")] + [1.0] * 15, 0), (None, out[9][1], None), (None, None, None),
            (3006, [1.0, 2.0], 0), (3007, [2.0, 4.0], 0), (3008, [1e300, 2e300], 0), (3009, [1.0], 0)]
    return out


@pytest.mark.parametrize("tile", [512, 16])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_dup, "TILE", tile)
    given = vectors()
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int")
    for name in ("digest", "values", "n_links", "class", "key", "copies", "root"):
        df = df.withColumn(name, df.label)
    usable = [x is not None and len(x) > 0 and None not in x and bool(np.isfinite(x).all()) and any(x) for _, x, _ in given]
    links = []
    for a, (_, x, _) in enumerate(given):
        for b in range(a):
            y = given[b][1]
            if usable[a] and usable[b] and len(x) == len(y):
                x1, y1 = np.array(x) / np.abs(x).max(), np.array(y) / np.abs(y).max()
                if x1 @ y1 / np.linalg.norm(x1) / np.linalg.norm(y1) >= 0.9:
                    links.append((a, b))
    degree = collections.Counter(i for pair in links for i in pair)
    root = union(len(given), links)
    least = {}
    for i, (v, _, _) in enumerate(given):
        least[root[i]] = min((x for x in (least.get(root[i]), v) if x is not None), default=None)
    want = [(v, degree[i], least[root[i]], v is not None and v == least[root[i]]) for i, (v, _, _) in enumerate(given)]
    got = [tuple(r) for r in vector_dup.near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()]
    found, all_links = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.97 * all_links <= found <= all_links
    same = sum((collections.Counter(map(repr, got)) & collections.Counter(map(repr, want))).values())
    assert same >= 0.97 * len(want)
    clean = {repr(r) for r in want if r[1] == 0}
    assert clean <= set(map(repr, got))


def test_core_vectors_are_linked_by_their_angle():
    assert math.cos(2 * math.acos(vector_dup.CORE)) > vector_dup.SIMILAR + 1e-4


# language model

def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_language_model(docs, monkeypatch):
    for most in (lm.FREQUENT, 40):  # all words listed, and most of them left to the join
        monkeypatch.setattr(lm.lexicon, "__defaults__", (most,))
        got = lm.fit_and_score(docs).collect()
        counts = collections.Counter()
        for i, t, *_ in fx.rows():
            if not held(i):
                counts.update((t or "").encode().lower().split())
                counts[None] += 1
        total, distinct = sum(counts.values()), len(counts)
        want = collections.Counter()
        for i, t, *_ in fx.rows():
            tokens = (t or "").encode().lower().split() + [None]
            base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
            want[i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 4)] += 1
        assert collections.Counter((
            r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_probabilities_sum_to_one(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["a b", "b c", "c a", "d", "e f g"]) for _ in range(30)), None, None, None) for i in range(40)]
    docs = fx.documents(spark, rows, False)
    lex = lm.lexicon(lm.word_counts(docs.select("text")), 6)
    table = lm.train(docs, lex, rounds=2, shards=2)
    words = "a b c d e f g unseen".split()
    kinds = np.where(lm._look_up(lex, lm._tokens([" ".join(words).encode()])[0]) >= 0, 1, 0)
    assert 0 < kinds.sum() < len(words)
    counts = collections.Counter(" ".join(r[1] for r in rows).split())
    prefix = "a b c a"

    def next_token(text):
        """log10 P of the fifth token of a text, and whether it is listed."""
        tokens, n = lm._tokens([text.encode()])
        at = lm._look_up(lex, tokens)
        features, kind = lm._features(lex, at, n)
        _, z = lm._softmax(table, features)
        known = at[4] >= 0
        return z[4, kind[4]] / math.log(10) + (lex.in_class[at[4]] if known else 0), known

    total = 0.0
    for text, n in [(f"{prefix} {w}", counts[w]) for w in words] + [(prefix, len(rows))]:
        p, known = next_token(text)
        total += 10 ** (p + (0 if known else math.log10((n + 1) / lex.rest)))
    assert total == pytest.approx(1, abs=1e-4)


def test_the_model_beats_the_unigram_on_held_out_documents(spark):
    rnd = random.Random(12)
    tongues = [[f"{c}{i}" for i in range(60)] for c in "abcd"]
    rows = []
    for i in range(700):
        words = tongues[i % 4]
        rows.append((i, " ".join(words[min(int(rnd.expovariate(0.08)), 59)] for _ in range(60)), None, None, None))
    got = [r for r in lm.fit_and_score(fx.documents(spark, rows, False)).collect() if r["held_out"]]
    n = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] for r in got) / n > sum(r["base_score"] for r in got) / n + 0.1


# pipeline and empty tables

def test_pipeline_stages(spark, docs):
    given = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, given, "")
        assert after.columns == docs.columns, name
        given = after.cache()
        assert given.count() > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, given, "").collect()
    want = packing.cut(given, queries.vocabulary()).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in pieces) == collections.Counter(
        (r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "source_mix", "best_fit_pack"]
    assert given.where("text LIKE '%AKIA%'").count() == 0


def test_empty_tables(spark):
    none = fx.documents(spark, [])
    vectors_none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for df in (near_dup.near_duplicates(none), near_dup.drop_near_duplicates(none), vector_dup.near_vectors(vectors_none), lm.fit_and_score(none)):
        assert df.count() == 0


def test_rare_shingles_of_similar_texts_meet():
    """No pair at the threshold, by either measure, is without a rare shingle in common."""
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    frequencies = np.random.default_rng(2).integers(1, 500, near_dup.SKETCH).astype(float)
    idf = near_dup.idf_table(frequencies, 500)
    met = 0
    for _ in range(60):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 80))]
        if rnd.random() < 0.4:
            base += base[:12] * rnd.randint(1, 9)
        texts = []
        for _ in range(12):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            texts.append(" ".join(own).encode())
        weighted, plain = near_dup.similarity(texts, idf)
        h, owner = near_dup.rare_shingles(texts, idf)
        own = [set(h[owner == i].tolist()) for i in range(len(texts))]
        for a in range(len(texts)):
            first = near_dup.similar_to_first([texts[a], *texts], idf)[1:]
            assert np.allclose(np.delete(first, a), np.delete(np.maximum(weighted, plain)[a], a), atol=1e-5)
            for b in range(a):
                if max(weighted[a, b], plain[a, b]) >= near_dup.SIMILAR:
                    met += 1
                    assert own[a] & own[b]
    assert met > 300


def test_texts_that_share_a_passage_only_are_not_dealt(spark):
    """A passage in many documents makes large buckets; their members go before any pair is compared."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(25)] + passage + [word() for _ in range(25)])) for i in range(300)]
    rows += [(1000 + i, " ".join(rows[0][1].split()[:-1] + [word()])) for i in range(3)]
    whole = spark.createDataFrame(rows, "item long, text string")
    members = whole.select("item", F.col("item").alias("class"), F.lit(1).alias("key"), F.lit(0).alias("leader"))
    idf = spark.sparkContext.broadcast(near_dup.idf_table(*near_dup.document_frequencies(whole)))
    assert {r["item"] for r in near_dup.with_rare_partners(members, whole, idf).collect()} == {0, 1000, 1001, 1002}


def test_buckets_of_a_leader_are_one_group_where_they_overlap(spark):
    rows = [(1, 7, i, i) for i in range(20)] + [(2, 7, i, i) for i in range(2, 22)] + [(3, 8, 1, 1), (3, 8, 2, 2), (4, 8, 3, 3), (4, 8, 4, 4)]
    got = near_dup.merged(spark.createDataFrame(rows, "key long, leader long, item long, class long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["key"], set()).add(r["item"])
    assert sorted(map(sorted, groups.values())) == [list(range(22)), [1, 2], [3, 4]] and len(got) == 26


@pytest.mark.parametrize("points", [32, 256, 1024])
def test_pairs_at_the_threshold_share_reference_points(points):
    """Recall at cosine 0.90 does not fall with the number of reference points."""
    rng = np.random.default_rng(points)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    p, x = unit(rng.normal(size=(points, 64))), unit(rng.normal(size=(3000, 64)))
    z = rng.normal(size=x.shape)
    z = unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    k = vector_dup.prefix(points)
    near = [np.argsort(-(v @ p.T), axis=1)[:, :k] for v in (x, y)]
    shared = (near[0][:, :, None] == near[1][:, None, :]).any(axis=2).sum(axis=1)
    assert (shared >= vector_dup.SHARED).mean() > 0.975


def test_vectors_by_many_reference_points(spark, monkeypatch):
    """The whole operator with 1,024 reference points: at least 0.97 of the links found, none that is not one."""
    monkeypatch.setattr(vector_dup, "LEAST_PIVOTS", 1024)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(5000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    z = rng.normal(size=(600, 32))
    z -= (z * base[:600]).sum(axis=1, keepdims=True) * base[:600]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    cosine = rng.uniform(0.9005, 0.95, size=(600, 1))
    x = np.concatenate((base, cosine * base[:600] + np.sqrt(1 - cosine ** 2) * z))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vector_dup.near_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.97 * want.sum() and want.sum() >= 1200
