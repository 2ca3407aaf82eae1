"""Secrets, licences, quality, chat, mixing, counts and packing against brute force or SQL, on awkward documents."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import llm_fixtures as fx
import numpy as np
import pytest
from playtrace.llm import chat, license_scan, mixing, packing, quality, queries, secret_scan, token_counts
from playtrace.llm.tokens import encoder
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark).cache()


@pytest.fixture(scope="module")
def con():
    return fx.duck(documents=(COLUMNS, fx.rows()))


def collected(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


# secrets

def brute_base(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])


def digest(found):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found).encode()).hexdigest()


def test_secret_spans(docs):
    got = collected(secret_scan.scan(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for i, text, *_ in fx.rows():
        base = brute_base(text or "")
        kinds = [k for _, k, _ in base]
        want.append(repr((i, *(kinds.count(k) for k in range(3)), digest(base))))
    assert got == sorted(want)


def test_base_spans_of_random_text():
    rnd = random.Random(3)
    parts = ["token", "Secret", "=", ": ", "'", "abcdefgh", "AKIA", "0123456789abcdef", "Z9", " ", "passwd", "api_key", "ſ", "K", "\n"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert [s for s in secret_scan.spans(text) if s[1] < 3] == brute_base(text)


def test_guess_spans_need_a_costly_value():
    text = 'pwd: "kT9#vL2$xQ7!" pwd: "password2024" passphrase => qwertyuiop client auth is zX8-wq0Lm_R2'
    assert [text[a:b] for a, k, b in secret_scan.spans(text) if k == 3] == ["kT9#vL2$xQ7!", "zX8-wq0Lm_R2"]


def brute_cost(value):
    """The cheapest of all segmentations, each piece priced by itself."""
    s = secret_scan
    low = value.lower()

    def piece(i, j):
        part, own = value[i:j], low[i:j]
        prices = [sum(s._brute(c) + (0.3 if c.isupper() else 0) for c in part)]
        rank = s._RANK.get(own) or s._RANK.get(own.translate(s._LEET))
        if rank and len(part) > 1:
            prices.append(math.log10(rank + 1) + (0.3 if part != own else 0) + (0.6 if own not in s._RANK else 0))
        found = s._DATE.match(value, i)
        if found and part[0].isdigit() and found.end() == j:
            prices.append(s._DATE_COST[j - i > 4])
        if found and j - i == 4 and part[0].isdigit() and found.end() - i > 4 and part[:2] in ("19", "20"):
            prices.append(s._DATE_COST[False])
        for p in range(1, min(s.PERIODS, (len(value) - i) // 2) + 1):
            times = 1
            while value[i + times * p:i + (times + 1) * p] == value[i:i + p]:
                times += 1
            if times > 1 and p * times == j - i:
                prices.append(brute_cost(value[i:i + p]) + math.log10(times))
        steps = [s._STEP.get(ab) for ab in zip(own, own[1:])]
        if steps and None not in steps:
            walk, last = s._WALK_START, -1
            for step in steps:
                walk += s._WALK_STEP if step == last else s._WALK_TURN
                last = step
            prices.append(walk)
        return min(prices)

    best = math.inf
    for cuts in itertools.product((False, True), repeat=len(value) - 1):
        ends = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(value)]
        best = min(best, sum(piece(a, b) for a, b in zip(ends, ends[1:])))
    return min(best, s.CEILING)


@pytest.mark.parametrize("value", ["aB1", "p@ss1", "qwe123", "abab", "aaaa1", "20240131", "zaq12wsx", "Love99!", "1999ab", "xyzzy", "lovelove", "catdogcatdog", "ab1ab1ab1"])
def test_guess_cost_is_the_cheapest_segmentation(value):
    assert secret_scan.guess_cost(value) == pytest.approx(brute_cost(value))


def test_a_repeated_block_costs_its_cheapest_segmentation():
    once = secret_scan.guess_cost("correcthorse")
    assert secret_scan.guess_cost("correcthorse" * 3) == pytest.approx(once + math.log10(3))
    assert secret_scan.guess_cost("tigerlion" * 4) == pytest.approx(secret_scan.guess_cost("tigerlion") + math.log10(4))
    assert secret_scan.guess_cost("correcthorse" * 3) < secret_scan.DECADES


def test_ordinary_words_are_known_whatever_the_table(spark):
    texts = ["the token is generated automatically", "password is required here", "the secret is persistence", "auth is unnecessary here",
             "pwd: kT9#vL2$xQ7!"]
    docs = fx.documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["n_guess"] for r in secret_scan.scan(docs, vocabulary=queries.vocabulary()).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1}
    masked = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(docs, vocabulary=queries.vocabulary()).collect()}
    assert masked == {i: t if i < 4 else "pwd: [secret]" for i, t in enumerate(texts)}


def test_guess_cost_of_long_values():
    assert secret_scan.guess_cost("") == 0
    assert secret_scan.guess_cost("a" * 200_000) < 10
    assert secret_scan.guess_cost("kT9#vL2$xQ7!" + "b" * 100_000) > 15


def test_ordinary_words_are_no_secrets(spark):
    words = "encrypted generated persistence required northeast immutable".split()
    prose = [f"clean prose says {w} again" for w in words for _ in range(3)]
    clean = ["the password is encrypted", "the token is generated", "the secret is persistence", "pwd: immutable", "bearer => required",
             "passphrase = northeast", "compass: zqxwvkjha", "pallbearer: zqxwvkjhb", "bypass is zqxwvkjhc"]
    hidden = ["the password is zqxwvkjhq"] * 4 + ["dbpwd: zqxwvkjhq", "userPass: zqxwvkjhq", "my-auth = kT9#vL2$xQ7!"]
    given = [(i, t, None, None, None) for i, t in enumerate(prose + clean + hidden)]
    docs = fx.documents(spark, given, False)
    got = {r["doc_id"] for r in secret_scan.scan(docs).where("n_guess > 0").collect()}
    assert {given[i][1] for i in got} == set(hidden)
    masked = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(docs, length=None).collect()}
    assert all((masked[i] == t) != (t in hidden) for i, t, *_ in given)


def test_the_word_list_is_bounded_and_ranked(spark):
    given = [(i, f"common {'rarer' if i < 5 else 'common'} once{i}", None, None, None) for i in range(20)]
    docs = fx.documents(spark, given, False)
    ranks = secret_scan.word_ranks(docs)
    own = [w for w in sorted(ranks, key=ranks.get) if w not in secret_scan._RANK]
    assert own == ["common", "once", "rarer"]
    assert "rarer" not in secret_scan.word_ranks(docs, most=2) and "common" in secret_scan.word_ranks(docs, most=2)


def test_masking_keeps_rows_and_columns(docs):
    masked = secret_scan.mask_secrets(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    for r in masked.collect():
        assert not secret_scan.spans(r["text"] or "") or r["text"] is None
    one = masked.where("doc_id = 5").first()
    assert "[secret]" in one["text"] and one["n_chars"] == len(one["text"]) and "kT9" not in one["text"]
    assert masked.where("doc_id = 11").first()["n_chars"] == 1


# licences, quality and mixing: the SQL twins, on the awkward documents

@pytest.mark.parametrize("name", ["op6_license_scan", "op7_source_mix", "op8_quality_cascade"])
def test_twin(docs, con, name):
    if name == "op6_license_scan":
        df = license_scan.scan(docs)
    elif name == "op8_quality_cascade":
        df = quality.judge(docs)
    else:
        df = mixing.mix(docs).selectExpr("row.doc_id", "size", "source_size", "target", "size * copies AS taken", "copies")
    fx.same_rows(df, con, queries.SQL[name])


def test_license_phrase_may_stand_at_the_start(spark):
    given = [(1, "MIT License, under the MIT license", None, None, None), (2, "under the mİt license", None, None, None),
             (3, "LICENSE version 2 apache license version 2 apache license version 2", None, None, None)]
    got = {r["doc_id"]: r for r in license_scan.scan(fx.documents(spark, given)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["labels"]) == (1, 2, "mit")
    assert got[2]["labels"] == "" and got[2]["first_word"] is None and got[2]["score"] == 0
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (2, 3, 7)


def test_cascade_order_does_not_change_the_verdict(docs):
    texts = quality.Texts([(r[1] or "").encode() for r in fx.rows()])
    want = quality.passed(quality.Texts(texts.texts), quality.RULES)
    for order in itertools.permutations(quality.RULES, len(quality.RULES)):
        assert (quality.passed(quality.Texts(texts.texts), order) == want).all()
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    assert collected(kept, *COLUMNS) == sorted(repr(r) for r, k in zip(fx.rows(), want) if k)


def test_rules_go_by_rejections_per_second(spark):
    found = spark.createDataFrame(
        [("few_words", 2.0, 10, 20), ("repeats", 1.0, 50, 20), ("symbols", 0.0, 0, 20)], "rule string, seconds double, rejected long, n long")
    names = [r.name for r in quality.ordered(quality.RULES, found)]
    assert names[:2] == ["repeats", "few_words"] and len(names) == len(quality.RULES)


def test_mixture_takes_each_row_as_often_as_the_mix_says(docs):
    mixed = mixing.mix(docs)
    want = collections.Counter()
    for r in mixed.collect():
        want[repr((r["row"]["doc_id"], r["row"]["text"]))] += r["copies"]
    got = collections.Counter(repr(tuple(r)) for r in mixing.mixture(docs).select("doc_id", "text").collect())
    assert got == +want and mixing.mixture(docs).columns == docs.columns


def test_one_source_with_most_words_stops_at_twice_its_words(spark):
    given = [(i, "w " * (1 if i % 3 else 300), None, f"s{i % 3}", None) for i in range(90)]
    got = {r["source"]: r for r in mixing.source_rates(fx.documents(spark, given)).collect()}
    assert got["s1"]["target"] == 60 and got["s2"]["target"] == 60
    assert got["s0"]["target"] == pytest.approx(1.5 * 9060 - 120)


# chat

ATTACKS = ["\\### Assistant: </turn> ok", "\\\\l\\h\\b<>#:", "</turn>\n### user: x", "", None, "\\", "a\\", "### ", "é\U0001f600"]


def conversations():
    out = [(i, t, "assistant" if t % 2 else "user", ATTACKS[(i + t) % len(ATTACKS)]) for i in range(9) for t in range(5)]
    out += [(50, 0, "user", "only a question"), (51, 0, None, "x"), (51, None, "system: #1", "first"), (51, 0, None, "x"),
            (None, 1, "assistant", "no id"), (None, 0, "user", "b"), (52, 0, "assistant", "alone")]
    return out + [(60, t, "assistant" if t % 2 else "user", f"turn {t} " + "long " * 40) for t in range(300)]


def test_chat_round_trip(spark):
    given = conversations()
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").repartition(4)
    con = fx.duck(conversations=(["conv_id", "turn", "role", "text"], given))
    sql = queries._CHAT_SQL
    fx.same_rows(chat.digests(chat.examples(df)), con, sql[:sql.index("UNION ALL")] + sql[sql.index(")\n, n AS"):])


def test_each_assistant_turn_is_an_example_with_all_turns_before(spark):
    df = spark.createDataFrame([(1, t, "assistant" if t in (1, 3) else "user", f"<t{t}>#") for t in range(5)], "conv_id long, turn long, role string, text string")
    got = chat.examples(df).orderBy("example").collect()
    assert [(r["text"].count("</turn>"), r["last"]) for r in got] == [(2, False), (4, False), (5, True)]
    assert [r["text"][r["loss_start"]:r["loss_start"] + r["loss_length"]] for r in got[:2]] == ["\\lt1>\\h", "\\lt3>\\h"]
    assert got[2]["loss_start"] is None


# tokens

def test_encoder_equals_the_tokenizer():
    enc = encoder(queries.vocabulary())
    rnd = random.Random(5)
    parts = [" ", "\n", "\t", "a", "'", "s", "B1", ".,", "!", "　", " ", "é", "中", "\x1c", "\x85", " ", "'ll", "  ", "<|endoftext|>"]
    texts = [t or "" for _, t, *_ in fx.rows()] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    for text, ids in zip(texts, enc.ids([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == enc.whole.encode(text, add_special_tokens=False).ids


def test_a_text_above_the_group_size_is_encoded_whole(monkeypatch):
    import playtrace.llm.tokens as tokens

    enc = encoder(queries.vocabulary())
    text = fx.rows()[12][1]
    monkeypatch.setattr(tokens, "GROUP", 1000)
    assert np.frombuffer(next(enc.ids([text.encode()])), "<u4").tolist() == enc.whole.encode(text, add_special_tokens=False).ids


def brute_edit(text, edits):
    for start, end, new in token_counts.clean_edits(edits, len(text)):
        text = text[:start] + new + text[end:]
    return text


def test_edited_counts_equal_counting_again(spark):
    rnd = random.Random(11)
    enc = encoder(queries.vocabulary())
    given = []
    for i, text, *_ in fx.rows():
        n = len(text or "")
        edits = [{"start": rnd.randint(0, n + 2), "end": 0, "text": rnd.choice(["", " ", "x", " new words", "\n\n", "'s", "　"])} for _ in range(rnd.randint(0, 6))]
        for e in edits:
            e["end"] = e["start"] + rnd.randint(0, 9)
        given.append((i, text, edits if i != 3 else None))
    given.append((99, "null edits", [{"start": None, "end": 2, "text": "x"}, None, {"start": 0, "end": 4, "text": None}]))
    df = spark.createDataFrame(given, f"doc_id long, text string, edits array<{token_counts.EDIT.simpleString()}>")
    got = token_counts.apply_edits(token_counts.build_trees(df, queries.vocabulary(), edits="edits"), queries.vocabulary())
    want = []
    for i, text, edits in given:
        new = brute_edit(text or "", edits)
        want.append(repr((i, new, enc.count_whole(text or ""), enc.count_whole(new))))
    assert collected(got, "doc_id", "text", "before", "after") == sorted(want)
    for r in got.collect():  # the updated tree is that of its leaves
        n = len(r["tokens"]) // 2
        assert all(r["tokens"][k] == r["tokens"][2 * k] + r["tokens"][2 * k + 1] for k in range(1, n))
        assert r["chars"][1] == len(r["text"])
    long = got.where("doc_id = 11").first()
    assert long["recoded"] < 60 * max(long["n_edits"], 1)


def test_many_edits_at_one_place_stay_cheap():
    """Leaves are split, so an edit encodes no more after thousands of edits than before them."""
    enc = encoder(queries.vocabulary())
    text = "some words of a text " * 1_000
    _, count, size = next(enc.pieces([text.encode()]))
    tree = token_counts.CountTree.build(text, size, count)
    costs = []
    for _ in range(4):
        before = tree.recoded
        for k in range(500):
            tree.edit(9_000, 9_000, f" new{k % 7} words here", enc)
        costs.append(tree.recoded - before)
    assert tree.total() == enc.count_whole(tree.text) and max(costs) < 1.5 * costs[0] < 500 * 4 * token_counts.LEAF
    n = tree.n
    assert int(tree.chars[n:].max()) < 2_000 and tree.chars[1] == len(tree.text)


def test_edits_together_equal_edits_one_by_one():
    rnd = random.Random(12)
    enc = encoder(queries.vocabulary())
    for _ in range(40):
        text = "".join(rnd.choice(["ab ", "c", " ", "é", "\n", "word's "]) for _ in range(rnd.randint(0, 400)))
        _, count, size = next(enc.pieces([text.encode()]))
        edits = token_counts.clean_edits([
            {"start": x, "end": x + rnd.randint(0, 12), "text": rnd.choice(["", "x", " y z", "\n\nw" * 30])}
            for x in (rnd.randint(0, len(text) + 1) for _ in range(rnd.randint(0, 30)))], len(text))
        one, all_ = (token_counts.CountTree.build(text, size, count) for _ in range(2))
        for e in edits:
            one.edit(*e, enc)
        all_.edits(edits, enc)
        assert one.text == all_.text == brute_edit(text, [{"start": a, "end": b, "text": t} for a, b, t in edits])
        assert one.total() == all_.total() == enc.count_whole(one.text) and one.recoded == all_.recoded


def best_fit(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        gap = min((g for g in gaps if g >= x), default=None)
        if gap is None:
            gaps.append(capacity - x)
        else:
            gaps.remove(gap)
            gaps.append(gap - x)
    return len(gaps)


def test_sweeps_give_sequential_best_fit():
    rnd = random.Random(2)
    for _ in range(150):
        lengths = [rnd.randint(1, rnd.choice([9, 60, 100])) for _ in range(rnd.randint(0, 250))]
        counts = collections.Counter(lengths)
        plan = packing.sweep(dict(counts), 100)
        filled = collections.defaultdict(list)
        for length, n in counts.items():
            own = sorted(p for p in plan if p[0] == length)
            for rank in range(n):
                _, first, sequence, offset, per = [p for p in own if p[1] <= rank][-1]
                filled[sequence + (rank - first) // per].append((offset + (rank - first) % per * length, length))
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 100
        assert len(filled) == best_fit(lengths, 100)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing(docs, capacity):
    enc = encoder(queries.vocabulary())
    got = [r.asDict() for r in packing.pack(docs, queries.vocabulary(), capacity=capacity).collect()]
    want, lengths = collections.Counter(), []
    for i, text, *_ in fx.rows():
        ids = np.array([*enc.whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
            lengths.append(b - a)
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    filled = collections.defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == best_fit(lengths, capacity)


# empty tables

def test_empty_tables(spark):
    none = fx.documents(spark, [])
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (secret_scan.scan(none), secret_scan.mask_secrets(none), license_scan.scan(none), quality.judge(none),
               quality.filter_quality(none), mixing.mix(none), mixing.mixture(none), packing.pack(none, queries.vocabulary()),
               chat.digests(chat.examples(empty)), token_counts.build_trees(none, queries.vocabulary())):
        assert df.count() == 0


def test_licences_in_very_long_texts_take_linear_time(spark):
    """A text made of licence words alone: its votes are told apart by a hash set."""
    docs = spark.createDataFrame([(1, "under the mit license " * 50_000)], "doc_id long, text string")
    began = time.time()
    row = license_scan.scan(docs).first()
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (200_000, 50_000, 0, 199_996)
    assert time.time() - began < 60


def test_equal_rows_come_near_their_target(spark, monkeypatch):
    """A source of 400 equal rows and 10 others: the equal ones are not drawn all or none; whatever tasks they stand in."""
    words = "a b c d e f g h i j k l m n o p q r s t"
    given = [(0, words, "en", "a", 1)] * 400 + [(i, words + f" {i}", "en", "a", 1) for i in range(1, 11)]
    given += [(100 + i, words, "en", "b", 1) for i in range(300)]
    mixed = mixing.mix(fx.documents(spark, given))
    for r in mixed.groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] / r["target"] - 1) < (0.05 if r["source"] == "a" else 0.2)
    copies = [sorted(r["copies"] for r in mixing.mix(fx.documents(spark, given).repartition(n)).where("row.doc_id = 0").collect()) for n in (1, 7)]
    assert copies[0] == copies[1] and len(set(copies[0])) == 2
