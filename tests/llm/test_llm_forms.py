"""Toxicity, fill-in-the-middle and importance resampling against brute force or SQL, on awkward documents."""

import hashlib
import random
import re
import zlib

import llm_fixtures as fx
import numpy as np
import pytest
from playtrace.llm import fim, importance, queries, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MARKED = [
    (400, "a <P> b c d", "en", "a", 1), (401, "x <S>", "en", "a", 1), (402, "<M>y z", "en", "a", 1), (403, "<p> <s> q", "en", "a", 1),
    (404, "  \x1f\x00 lead wide tail \n", "en", "a", 1), (405, " \n\t ", "en", "a", 1)]


def rows():
    return fx.rows() + MARKED


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark, rows()).cache()


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t) for i, (_, t, *_) in enumerate(fx.rows(seed=8)[14:40])] + [(99, None)], "item_id long, text string")


def collected(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


# fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size", [5, 64, fim.FRAME])
def test_outputs_of_any_frame_size(docs, size):
    own = [r for r in rows() if size > 5 or len(r[1] or "") < 2_000]
    given = docs if size > 5 else docs.where("text IS NULL OR length(text) < 2000")
    got = collected(fim.transform(fim.store_frames(given, size=size)), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert got == sorted(repr((i, *brute_fim(i, t))) for i, t, *_ in own)
    assert {brute_fim(i, t)[1] for i, t, *_ in own} == {"plain", "psm", "spm"}


def test_digests_from_frames(docs):
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    want = [(i, *brute_fim(i, t)[:4], sha(brute_fim(i, t)[4]), sha(t)) for i, t, *_ in rows()]
    got = fim.digests(fim.store_frames(docs, size=100))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_fim_twin(spark, docs, tmp_path):
    docs.select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    con = fx.duck(documents=(COLUMNS, rows()))
    fx.same_rows(queries.op12(spark, str(tmp_path)), con, queries.SQL["op12_fill_in_middle"])


def test_cuts_of_long_texts():
    rnd = random.Random(6)
    text = "".join(rnd.choice(["ab", "é", "\U0001f600", " ", "\n ", "x" * 50]) for _ in range(60_000))
    data, units = text.encode(), UNIT.findall(text)
    framed = fim.Framed(*fim.to_frames(data))
    assert len(framed.frames) > 5 and framed.units[-1] == len(units) and framed.chars[-1] == len(text)
    for unit in [0, 1, len(units) - 1, len(units), *(rnd.randrange(len(units)) for _ in range(40))]:
        k, at, chars = framed.cut(unit)
        before = "".join(units[:unit])
        assert chars == len(before)
        assert b"".join(framed.span((0, 0, 0), (k, at, chars))) == before.encode()


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_sections_of_pieces_of_any_size(form):
    rnd = random.Random(2)
    text = {m: "".join(rnd.choice("<PSM> ab") for _ in range(rnd.randint(0, 30))) for m in fim.ORDER[form]}
    for mark in ("<P>", "<S>", "<M>"):
        text = {m: t.replace(mark, "") for m, t in text.items()}
    whole = b"".join(m + text[m].encode() for m in fim.ORDER[form])
    for size in (1, 2, 3, 7, 1000):
        pieces = [whole[i:i + size] for i in range(0, len(whole), size)]
        assert b"".join(fim.restored(pieces, form)).decode() == text[fim.PREFIX] + text[fim.MIDDLE] + text[fim.SUFFIX]


def test_no_documents_to_cut(docs):
    assert fim.digests(fim.store_frames(docs.where("false"))).count() == 0


# importance resampling

def test_resampling_twin(spark, docs, benchmark, tmp_path, monkeypatch):
    docs.select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    con = fx.duck(documents=(COLUMNS, rows()), benchmark=(["item_id", "text"], [tuple(r) for r in benchmark.collect()]))
    monkeypatch.setattr(importance, "PART_ROWS", (8, 8))
    fx.same_rows(queries.op13(spark, str(tmp_path)), con, queries.SQL["op13_importance_resample"])


def test_resampling_with_clashing_columns(docs, benchmark):
    got = importance.resample(docs, benchmark)
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"] is not None)
    able = sum(len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t or "")) >= 20 for _, t, *_ in rows())
    assert got.count() == len(rows()) and ranks == list(range(1, able // 10 + 1))


def test_no_documents_and_no_targets(docs, benchmark):
    assert importance.resample(docs.where("false"), benchmark).count() == 0
    assert importance.resample(docs.where("doc_id < 4"), benchmark.where("false")).count() == 3


@pytest.mark.parametrize("ids", [(-5, 5), (-(1 << 63), (1 << 63) - 1), (1 << 40, (1 << 40) + 3000)])
def test_radix_sort(spark, monkeypatch, ids):
    monkeypatch.setattr(importance, "BITS", 5)
    monkeypatch.setattr(importance, "PART_ROWS", (16, 16))
    rnd = random.Random(3)
    given = [(rnd.randint(*ids) if rnd.random() < 0.9 else None, rnd.randint(-40, 200)) for _ in range(700)]
    given += [(ids[0], 7)] * 200 + [(ids[1], 200)]
    df = spark.createDataFrame(given, "doc_id long, score long").repartition(5)
    got = [(r["doc_id"], r["score"]) for r in importance.ranked(df).orderBy("place").collect()]
    assert got == sorted(given, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [r["place"] for r in importance.ranked(df).select("place").orderBy("place").collect()] == list(range(len(given)))


def test_words_of_very_long_texts():
    text = ("é" + "word " * 9 + "x-y Z ") * 40_000
    known = importance._Buckets(101)
    want = [zlib.crc32(w.encode()) % 101 for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    assert np.concatenate(list(importance.features(text.encode(), known))).tolist() == want


# toxicity

def brute_vector(text):
    """Value of each word and beginning of a word, as (bytes, length of the beginning or None)."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    counts = {}
    for w in words:
        for key in [(w, None), *((w[:k], k) for k in toxicity.BEGINNINGS if len(w) > k)]:
            counts[key] = counts.get(key, 0) + 1
    return {key: np.log1p(c) / np.log(10 + len(words)) for key, c in counts.items()}


def hash_of(word, k):
    found = list(toxicity.features([word if k is None else word + b"zzz"]))[0][0]
    return int(found[0 if k is None else 1 + [x for x in toxicity.BEGINNINGS if len(word) + 3 > x].index(k)])


def test_vectors():
    texts = [t or "" for _, t, *_ in rows()] + ["stupid Stupidity, stup " * 3, ("long words stand here " * 10 + "\n") * 8_000]
    picked = sorted({key for t in texts[:40] + texts[-2:] for key in brute_vector(t)}, key=str)[::7][:400]
    hashes = {hash_of(*key): key for key in picked}
    feature = np.sort(np.array(list(hashes), np.uint64))
    owner, at, value = toxicity.vectors([t.encode().lower() for t in texts], toxicity.Known(feature))
    got = {(int(i), hashes[int(feature[a])]): v for i, a, v in zip(owner, at, value)}
    want = {(i, key): v for i, t in enumerate(texts) for key, v in brute_vector(t).items() if key in set(picked)}
    assert got.keys() == want.keys() and len(want) > 300
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_risk_falls_and_negative_risk_is_climbed():
    rnd = np.random.default_rng(5)
    positive = rnd.normal(1.5, 1, (80, 4)).astype(np.float32)
    unlabelled = np.concatenate((rnd.normal(1.5, 1, (200, 4)), rnd.normal(-1.5, 1, (800, 4)))).astype(np.float32)

    def risk(w):
        p, u = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) for x in (positive, unlabelled))
        return 0.2 * (1 - p).mean() + max(0.0, u.mean() - 0.2 * p.mean())

    w = toxicity.fit(positive, unlabelled, 0.2)
    assert risk(w) < 0.05 < risk(np.zeros(5))
    found = unlabelled @ w[:-1] + w[-1] >= 0
    assert found[:200].mean() > 0.9 and found[200:].mean() < 0.05
    doubled = toxicity.fit(positive, unlabelled[::2], 0.2, None, np.full(500, 2.0))
    assert (((unlabelled @ doubled[:-1] + doubled[-1]) >= 0) == found).mean() > 0.97


def toxic_rows(n=900, seed=4):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(30, 150))]
        toxic = rnd.random() < 0.15
        if toxic:
            for _ in range(3 + len(text) // 30):
                text.insert(rnd.randrange(len(text)), rnd.choice(["vilest", "Rotten!", "gruberac" + rnd.choice(words), "gruberac" + rnd.choice(words)]))
        docs.append((i, " ".join(text), "en", "a", 1))
        if rnd.random() < 0.7:
            labels.append((i, 1, int(toxic)))
        docs[-1] += (toxic,)
    return docs, labels


def test_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 300)  # several classifiers
    given, marks = toxic_rows()
    truth = {r[0]: r[5] for r in given}
    extra = [(5_000, None, None, None, None), (5_001, "", "en", "a", 0), (None, "vilest rotten " * 5, None, None, None)]
    docs = fx.documents(spark, [r[:5] for r in given] + extra + [given[0][:5]] * 400)
    labels = spark.createDataFrame([*marks, (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.fit_and_score(docs, labels).collect()
    assert len(got) == len(given) + 403
    by_id = {r["doc_id"]: r for r in got}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in by_id.values() if r["held_out"] and r["doc_id"] in truth]
    toxic = [r["predicted"] for r in held if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.05 and len(toxic) > 15
    assert by_id[None]["predicted"] == 1 and by_id[5_000]["score"] == by_id[5_001]["score"] < 0.5
    # labels of the held-out fold change nothing
    turned = spark.createDataFrame(
        [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks], labels.schema)
    again = {r["doc_id"]: r["score"] for r in toxicity.fit_and_score(docs.repartition(7), turned).collect()}
    assert all(again[i] == pytest.approx(by_id[i]["score"], abs=1e-3) for i in by_id)


def test_no_confirmed_texts(spark, docs):
    none = spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, none.where("false")):
        assert {r["score"] for r in toxicity.fit_and_score(docs, labels).collect()} == {0.0}
    assert toxicity.fit_and_score(docs.where("false"), none).count() == 0
