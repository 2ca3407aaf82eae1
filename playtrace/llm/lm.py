"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). Frequent words are cut into classes of about equal mass, all other words,
known or not, are one more class. P(class | history) is a softmax over the sum of hashed feature rows: the word before, the two
before, and skips over one and two words. P(word | class) follows the training counts, one added in the last class.

Counts are exact over all training documents and stay in a distributed table; words are told apart by 64-bit hashes. Only a
list of at most ``FREQUENT`` words and the feature table, both of fixed size, are sent to tasks. Other words meet their counts in a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import as_bytes, bounded_batches, mix64, stored, word_hashes

FREQUENT = 1 << 18
CLASSES = 32
TABLE = 1 << 14
CONTEXTS = 8192  # words that are histories of their own; others stand for their class
BLOCK = 512
BATCH = 4096
RATE = 0.3
ROUNDS = 2
NEVER = -1e4
END = np.uint64(0x1D8E4E27C47D124F)
_START = np.int64(1 << 40)
_GROUP = 1 << 20


@dataclass
class Lexicon:
    """Frequent words by hash (sorted): rank by count, class, count; and totals over the training tokens."""

    word: np.ndarray
    rank: np.ndarray
    kind: np.ndarray
    count: np.ndarray
    in_class: np.ndarray  # log10 P(word | class)
    tokens: int
    distinct: int
    rest: int  # tokens of the words that are not in the list, plus those words, plus one


def held_out(doc_id: str | Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id as text, modulo ``folds``, is ``fold``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _GROUP:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with an end after each, and the tokens of each text."""
    h, n = word_hashes(texts)
    out = np.full(len(h) + len(n), END, np.uint64)
    word = np.ones(len(out), bool)
    word[np.cumsum(n + 1) - 1] = False
    out[word] = h
    return out, n + 1


def _counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable") if weights is not None else None
    values = np.sort(values) if order is None else values[order]
    if not len(values):
        return values, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    if weights is None:
        return values[first], np.diff(first, append=len(values))
    return values[first], np.add.reduceat(weights[order], first)


def word_counts(texts: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``word, n`` over the one column of ``texts``; tasks count up to ``most`` words before they hand their counts on."""
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for _, group in _groups(as_bytes(batch.column(0), lower=True)):
                w, c = _counted(_tokens(group)[0])
                words, counts = _counted(np.concatenate((words, w)), np.concatenate((counts, c)))
                if len(words) >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])
                    words, counts = words[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

    return texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, most: int = FREQUENT) -> Lexicon:
    """The most frequent words, at most ``most``, cut where the counts fall below a step of a logarithmic scale."""
    step = F.floor(F.log2("n") * 8)
    steps = sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect(), reverse=True)  # < 512 rows
    least, listed = math.inf, 0
    for row in steps:
        if listed + row["v"] > most:
            break
        least, listed = row["s"], listed + row["v"]
    tokens, distinct = sum(r["n"] for r in steps), sum(r["v"] for r in steps)
    top = counts.where(step >= F.lit(float(least))).toArrow()  # at most ``most`` rows of two numbers
    word, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.lexsort((word, -n))
    word, n = word[order], n[order]
    before = np.cumsum(n) - n
    kind = (before * (CLASSES - 1) // max(int(n.sum()), 1)).astype(np.int64)
    mass = np.bincount(kind, n, CLASSES)
    by = np.argsort(word)
    in_class = np.log10(n / mass[kind]) if len(n) else np.empty(0)
    rest = tokens - int(n.sum()) + distinct - len(n) + 1
    return Lexicon(word[by], by.astype(np.int64), kind[by], n[by], in_class[by], tokens, distinct, rest)


def _look_up(lex: Lexicon, tokens: np.ndarray) -> np.ndarray:
    """Place in the lexicon, -1 for other words."""
    if not len(lex.word):
        return np.full(len(tokens), -1)
    at = np.searchsorted(lex.word, tokens)
    at[at == len(lex.word)] = 0
    return np.where(lex.word[at] == tokens, at, -1)


def _features(lex: Lexicon, at: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(rows of the feature table, class)`` of each token."""
    known = at >= 0
    kind = np.where(known, lex.kind[at], CLASSES - 1) if len(lex.word) else np.full(len(at), CLASSES - 1)
    rank = lex.rank[at] if len(lex.word) else at
    context = np.where(known & (rank < CONTEXTS), rank, CONTEXTS + kind)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(per) - per, per)
    back = []
    for k in (1, 2, 3):
        x = np.full(len(at), _START)
        x[k:] = context[:-k]
        back.append(np.where(nth >= k, x, _START).astype(np.uint64))
    with np.errstate(over="ignore"):
        salt = [np.uint64(s << 44) for s in range(1, 5)]
        keys = (back[0] + salt[0], back[1] + salt[1], back[2] + salt[2], back[1] * np.uint64(1_000_003) + back[0] + salt[3])
    rows = np.stack([(mix64(k) & np.uint64(TABLE - 1)).astype(np.uint16) for k in keys])
    return rows, kind


def _softmax(table: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(probabilities, logarithms)`` of the classes; the last row of the table is the bias."""
    z = table[rows[0]]
    for r in rows[1:]:
        z += table[r]
    z += table[TABLE]
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    total = p.sum(axis=1, keepdims=True)
    z -= np.log(total)
    p /= total
    return p, z


def _descend(table: np.ndarray, squares: np.ndarray, seen: np.ndarray, rows: np.ndarray, kind: np.ndarray) -> None:
    """One gradient step on a batch of tokens (Adagrad), in place; only the rows that occur are touched."""
    p, _ = _softmax(table, rows)
    p[np.arange(len(kind)), kind] -= 1
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    sorted_rows = flat[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
    gradient = np.add.reduceat(p[order % len(kind)], first, axis=0)
    own = sorted_rows[first].astype(np.int64)
    seen[own] += np.diff(first, append=len(flat))
    squares[own] += gradient * gradient
    table[own] -= RATE * gradient / np.sqrt(squares[own] + 1e-3)
    bias = p.sum(axis=0)
    seen[TABLE] += len(kind)
    squares[TABLE] += bias * bias
    table[TABLE] -= RATE * bias / np.sqrt(squares[TABLE] + 1e-3)


def train(docs: DataFrame, lex: Lexicon, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS, shards: int | None = None) -> np.ndarray:
    """The feature table, fitted to all texts of ``docs`` in ``rounds`` rounds over disjoint parts of them.

    In a round each shard starts from the common table and descends over its texts; then the tables are averaged, each row by
    how often the shards have met it, in tasks that hold one table's blocks. ``shards`` are twice the cluster's cores unless given.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = shards or 2 * spark.sparkContext.defaultParallelism
    table = np.zeros((TABLE + 1, CLASSES), np.float32)
    empty = np.ones(CLASSES, bool)
    empty[[*lex.kind, CLASSES - 1]] = False
    table[TABLE, empty] = NEVER  # a class without words gets no probability, and no gradient moves it
    words = spark.sparkContext.broadcast(lex)
    part = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(rounds))
    schema = "block int, sums binary, seen binary"
    for k in range(rounds):
        start = spark.sparkContext.broadcast(table)

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = start.value.copy()
            squares, seen = np.full(own.shape, 1.0, np.float32), np.zeros(TABLE + 1, np.float64)
            for batch in batches:
                for _, group in _groups(as_bytes(batch.column(0), lower=True)):
                    tokens, per = _tokens(group)
                    rows, kind = _features(words.value, _look_up(words.value, tokens), per)
                    for a in range(0, len(kind), BATCH):
                        _descend(own, squares, seen, rows[:, a:a + BATCH], kind[a:a + BATCH])
            if seen[TABLE]:
                yield _blocks(own * seen[:, None].astype(np.float32), seen)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                for b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                    x, y = np.frombuffer(x, np.float32).astype(np.float64), np.frombuffer(y, np.float64)
                    sums[b] = [sums[b][0] + x, sums[b][1] + y] if b in sums else [x, y]
            for b, (x, y) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([x.astype(np.float32).tobytes()]), pa.array([y.tobytes()])],
                    names=["block", "sums", "seen"])

        own = docs.where(part == k).select(text).coalesce(shards)
        for row in own.mapInArrow(descend, schema).repartition("block").mapInArrow(add, schema).collect():  # one table
            a = row["block"] * BLOCK
            x, y = np.frombuffer(row["sums"], np.float32).reshape(-1, CLASSES), np.frombuffer(row["seen"], np.float64)
            met = y > 0
            table[a:a + len(y)][met] = x[met] / y[met, None]
        start.unpersist()
    return table


def _blocks(sums: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    starts = range(0, len(seen), BLOCK)
    return pa.RecordBatch.from_arrays([
        pa.array([s // BLOCK for s in starts], pa.int32()),
        pa.array([np.ascontiguousarray(sums[s:s + BLOCK]).tobytes() for s in starts]),
        pa.array([seen[s:s + BLOCK].tobytes() for s in starts])], names=["block", "sums", "seen"])


def score_texts(texts: list[bytes], lex: Lexicon, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: tokens, frequent tokens, their sum of log10(count + 1), the model's log10 but for P(word | class) of other words;
    and those other words: ``(text, word, times)``."""
    n = len(texts)
    tokens, per = _tokens(texts)
    at = _look_up(lex, tokens)
    known = at >= 0
    owner = np.repeat(np.arange(n), per)
    rows, kind = _features(lex, at, per)
    logs = np.empty(len(kind))
    for a in range(0, len(kind), 4 * BATCH):
        _, z = _softmax(table, rows[:, a:a + 4 * BATCH])
        logs[a:a + 4 * BATCH] = z[np.arange(len(z)), kind[a:a + 4 * BATCH]]
    logs *= 1 / math.log(10)
    listed = at[known]
    logs[known] += lex.in_class[listed]
    base = np.bincount(owner[known], np.log10(lex.count[listed] + 1.0), n)
    other, other_owner = tokens[~known], owner[~known]
    order = np.lexsort((other, other_owner))
    other, other_owner = other[order], other_owner[order]
    first = np.flatnonzero(np.concatenate(([True], (other[1:] != other[:-1]) | (other_owner[1:] != other_owner[:-1])))) if len(other) else np.empty(0, np.int64)
    times = np.diff(first, append=len(other))
    return (per, np.bincount(owner[known], minlength=n), base, np.bincount(owner, logs, n),
            (other_owner[first], other[first].view(np.int64), times))


def score(docs: DataFrame, counts: DataFrame, lex: Lexicon, table: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A null or empty text is its end alone. Rows that repeat an id are scored row by row. With no training token every word is
    unknown.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    words, rows = spark.sparkContext.broadcast(lex), spark.sparkContext.broadcast(table)
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"),
        F.col(text).alias("text"))
    schema = T.StructType([
        *own.schema.fields[:3], T.StructField("n_tokens", T.LongType()), T.StructField("listed", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("model", T.DoubleType()),
        T.StructField("others", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in _groups(as_bytes(batch.column(3), lower=True)):
                per, listed, base, model, (owner, other, times) = score_texts(group, words.value, rows.value)
                ends = pa.array(np.searchsorted(owner, np.arange(len(group) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(first, len(group)) for c in batch.columns[:3]], pa.array(per), pa.array(listed.astype(np.int64)),
                    pa.array(base), pa.array(model), pa.ListArray.from_arrays(ends, pa.array(other)),
                    pa.ListArray.from_arrays(ends, pa.array(times))], names=schema.names)

    part = stored(own.mapInArrow(run, schema), "lm-scores")
    others = part.select("row", F.inline(F.arrays_zip("others", "times"))).withColumnRenamed("others", "word")
    others = others.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_other"), F.sum("times").alias("all_other"))
    whole = part.drop("others", "times").join(others, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    total = math.log10(lex.tokens + lex.distinct + 1)
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("listed") + F.coalesce("n_other", F.lit(0))).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("model") + more - F.coalesce("all_other", F.lit(0)) * F.lit(math.log10(lex.rest))).alias("score"))


def fit_and_score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Learn from the documents that are not held out, score all of them."""
    training = docs.where(~held_out(doc_id))
    counts = stored(word_counts(training.select(text)), "lm-counts")
    lex = lexicon(counts)
    table = train(training, lex, text, doc_id, rounds)
    return score(docs, counts, lex, table, doc_id, text)
