"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

Texts are compared as five-word shingles (words in small letters A-Z) with weight term frequency times IDF. The document
frequencies of all shingles are kept in a sketch of fixed size. Each text draws ``BANDS * ROWS`` samples by weight and as many
without; two texts draw the same with the probability of their weighted, and of their plain Jaccard similarity. Texts that agree
on a whole band share a bucket, so pairs that are similar by either measure alone are compared.

Buckets are worked off without writing their pairs. First all members are compared with one leader, the member that meets most
others, which costs a comparison a member. Of the members whose classes still differ only those go on that share one of their rare
shingles with a member of another class: two texts at the threshold have a shingle in common among the rarest of each, those that hold
a fifth of its shingles, or of its weight. So texts that share a passage and no more are done with at the cost of counting. The buckets
of one leader, which hold much the same texts, become one group, so that a pair is met once. Groups are compared in tiles of bounded
bytes, a large class never with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import as_bytes, bounded_batches, mix64, shingles, stored, word_hashes
from playtrace.llm.components import components
from playtrace.llm.tiles import local_links, meets, runs, tiles

WIDTH = 5
SIMILAR = 0.8
BANDS, ROWS = 10, 3
SKETCH = 1 << 18
BLOCK = 1 << 12
#: Texts, and bytes of them, of a part of a group; a tile holds two parts.
TILE, TILE_BYTES = 1024, 4 << 20
#: Key tables up to this size are broadcast; beyond it Spark joins by shuffles.
BROADCAST_BYTES = 8 << 20
_GROUP = 1 << 20


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """``(number of the first text, texts)`` of about a megabyte."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _GROUP:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _elements(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(shingle, text number, count)``, one entry per text and distinct shingle, by text."""
    h, owner = shingles(*word_hashes(texts), WIDTH)
    key = h ^ mix64(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    if not len(order):
        return h, owner, owner
    first = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    count = np.diff(first, append=len(order))
    at = order[first]
    by = np.argsort(owner[at], kind="stable")
    return h[at][by], owner[at][by], count[by]


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Estimated documents per sketch cell, and documents with a word, over all of ``docs``.

    A cell counts the documents of all shingles that fall into it; the share that the other shingles are expected to have in it is
    taken off, so the estimate holds at any load. The sketch has ``SKETCH`` cells whatever the corpus.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n = np.zeros(SKETCH, np.int64), 0
        for batch in batches:
            for _, group in _groups(as_bytes(batch.column(0), lower=True)):
                h, owner, _ = _elements(group)
                cells += np.bincount((h & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                n += len(np.unique(owner))
        if n:
            yield _blocks(np.concatenate((cells, [n])))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(values, np.int64)
                total[b] = total[b] + own if b in total else own
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()])], names=["block", "cells"])

    schema = "block int, cells binary"
    summed = docs.select(text).mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()  # the sketch
    cells = np.zeros(SKETCH + 1, np.int64)
    for row in summed:
        own = np.frombuffer(row["cells"], np.int64)
        cells[row["block"] * BLOCK:row["block"] * BLOCK + len(own)] = own
    cells, n = cells[:-1], int(cells[-1])
    others = (cells.sum() - cells) / (SKETCH - 1)
    return np.clip(cells - others, 1, max(n, 1)), n


def _blocks(values: np.ndarray) -> pa.RecordBatch:
    starts = range(0, len(values), BLOCK)
    return pa.RecordBatch.from_arrays(
        [pa.array([s // BLOCK for s in starts], pa.int32()), pa.array([values[s:s + BLOCK].tobytes() for s in starts])],
        names=["block", "cells"])


def idf_table(frequencies: np.ndarray, n: int) -> np.ndarray:
    """IDF per sketch cell, from 1 (in every document) to 2 (in one): 1 + ln(n / df) / ln(n).

    It is flat on purpose: a group of thousands of copies must not outweigh itself with the few words that differ.
    """
    return (1 + np.log(n / frequencies) / np.log(n) if n > 1 else np.ones_like(frequencies)).astype(np.float32)


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of the gamma distribution with shape 2, by bisection of 1 - (1 + x) exp(-x)."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return ((low + high) / 2).astype(np.float32)


_TABLES: dict[str, np.ndarray] = {}


def band_keys(h: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(texts with a shingle, their keys of each band)`` by improved consistent weighted sampling.

    For a shingle of weight S and each sample: r, c gamma(2, 1) and b uniform, all from the shingle's hash;
    t = floor(ln S / r + b); the sample is the shingle, with t, that has the least ln c - r (t - b + 1).
    """
    if not _TABLES:
        _TABLES["r"] = _gamma_quantiles()
        _TABLES["ln_c"] = np.log(_TABLES["r"])
    r_of, ln_c_of = _TABLES["r"], _TABLES["ln_c"]
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.empty(0, np.int64)
    texts = owner[starts]
    sizes = np.diff(starts, append=len(owner))
    nth = np.repeat(np.arange(len(starts)), sizes)
    ln_s = np.log(weight).astype(np.float32)
    keys = np.empty((len(starts), BANDS), np.uint64)
    low = np.uint64(0xFFFF)
    for k in range(BANDS * ROWS):
        x = mix64(h + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        r = r_of[(x & low).astype(np.int64)]
        b = ((x >> np.uint64(32)) & low).astype(np.float32) / np.float32(65536)
        t = np.floor(ln_s / r + b)
        a = ln_c_of[((x >> np.uint64(16)) & low).astype(np.int64)] - r * (t - b + 1)
        least = np.minimum.reduceat(a, starts) if len(starts) else a
        hit = np.flatnonzero(a == least[nth])
        own = hit[np.searchsorted(nth[hit], np.arange(len(starts)))]
        sample = mix64(h[own] ^ mix64(t[own].astype(np.int64).astype(np.uint64)))
        band = k // ROWS
        if k % ROWS == 0:
            keys[:, band] = band + 1
        keys[:, band] = mix64(keys[:, band]) * np.uint64(0x9E3779B97F4A7C15) + sample
    return texts, mix64(keys.ravel()).reshape(keys.shape).view(np.int64)


def plain_band_keys(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Keys of as many bands again, of the texts with a shingle, by the least hashes of their shingle sets."""
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.empty(0, np.int64)
    keys = np.empty((len(starts), BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        x = mix64(h ^ mix64(np.array([(1 << 32) + k], np.uint64)))
        least = np.minimum.reduceat(x, starts) if len(starts) else x
        band = k // ROWS
        if k % ROWS == 0:
            keys[:, band] = BANDS + band + 1
        keys[:, band] = mix64(keys[:, band]) * np.uint64(0x9E3779B97F4A7C15) + least
    return mix64(keys.ravel()).reshape(keys.shape).view(np.int64)


def signatures(docs: DataFrame, idf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, bands`` per row; a text without a word has no bands. ``idf`` is a broadcast ``idf_table``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("digest"), F.col(text).alias("text"))
    schema = T.StructType([own.schema["doc_id"], own.schema["digest"], T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands: list = [[]] * batch.num_rows
            for first, group in _groups(as_bytes(batch.column(2), lower=True)):
                h, owner, count = _elements(group)
                texts, keys = band_keys(h, owner, count * idf.value[(h & np.uint64(SKETCH - 1)).astype(np.int64)])
                keys = np.concatenate((keys, plain_band_keys(h, owner)), axis=1)
                for i, row in zip((texts + first).tolist(), keys.tolist()):
                    bands[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return own.mapInArrow(run, schema)


def _digest(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def similarity(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted and plain Jaccard similarity of all texts of a tile with each other."""
    n = len(texts)
    h, owner, count = _elements(texts)
    weight = idf[(h & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.float64)
    own = np.bincount(owner, weight * count, n)
    plain = np.bincount(owner, minlength=n).astype(np.float64)
    _, first, col = np.unique(h, return_index=True, return_inverse=True)
    shared = np.bincount(col) > 1
    keep = shared[col]
    col, owner, count = (np.cumsum(shared) - 1)[col[keep]], owner[keep], count[keep]
    weight = weight[first][shared]
    common, both = np.zeros((n, n)), np.zeros((n, n))
    order = np.argsort(col, kind="stable")
    col, owner, count = col[order], owner[order], count[order]
    width = 4096
    for start in range(0, len(weight), width):
        a, b = np.searchsorted(col, (start, start + width))
        w = weight[start:start + width]
        x = np.zeros((n, len(w)), np.float32)
        x[owner[a:b], col[a:b] - start] = 1
        both += x @ x.T
        common += (x * w.astype(np.float32)) @ x.T
        more = np.flatnonzero(count[a:b] > 1)
        level = 2
        while len(more):  # a shingle that stands k times counts as k: once more for the texts that have it so often
            texts_of, i = np.unique(owner[a:b][more], return_inverse=True)
            own_cols, j = np.unique(col[a:b][more] - start, return_inverse=True)
            x = np.zeros((len(texts_of), len(own_cols)), np.float32)
            x[i, j] = 1
            common[np.ix_(texts_of, texts_of)] += (x * w[own_cols].astype(np.float32)) @ x.T
            level += 1
            more = more[count[a:b][more] >= level]
    with np.errstate(divide="ignore", invalid="ignore"):
        weighted = common / (own[:, None] + own[None, :] - common)
        plainly = both / (plain[:, None] + plain[None, :] - both)
    return np.nan_to_num(weighted), np.nan_to_num(plainly)


def similar_to_first(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """The larger of the weighted and the plain Jaccard similarity of the first text with each."""
    n = len(texts)
    h, owner, count = _elements(texts)
    weight = idf[(h & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.float64)
    own, plain = np.bincount(owner, weight * count, n), np.bincount(owner, minlength=n).astype(np.float64)
    first = owner == 0
    order = np.argsort(h[first])
    known, times = h[first][order], count[first][order]
    if not len(known):
        return np.zeros(n)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = known[at] == h
    common = np.bincount(owner[hit], weight[hit] * np.minimum(count[hit], times[at[hit]]), n)
    both = np.bincount(owner[hit], minlength=n)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(np.maximum(common / (own[0] + own - common), both / (plain[0] + plain - both)))


def verify_stars(groups: DataFrame, idf) -> DataFrame:
    """Links ``a, b`` between a leader and the members of its tile; rows ``key, i, item, part, text``, the leader's ``part`` is -1."""
    dealt = groups.select("key", "i", "part", "item", "text").repartition("key", "i").sortWithinPartitions("key", "i", "part", "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 2):
            found = similar_to_first([(r[4] or "").encode().lower() for r in rows], idf.value) >= SIMILAR
            linked = [rows[k][3] for k in np.flatnonzero(found[1:]) + 1]
            if linked:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[0][3]] * len(linked), pa.int64()), pa.array(linked, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def rare_shingles(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(shingle, text number)`` of the rarest shingles of each text: the first floor(n (1 - ``SIMILAR``)) + 1 of n, and all before whom
    no more than 1 - ``SIMILAR`` of its weight stands. Rare is what has the larger IDF, then the smaller hash.

    Two texts that are similar at ``SIMILAR`` by either measure share one of these shingles. If they share none, all that they have in
    common comes, in one of them, after its rare ones, which is less than ``SIMILAR`` of its shingles and of its weight.
    """
    h, owner, count = _elements(texts)
    if not len(h):
        return h, owner
    rank = idf[(h & np.uint64(SKETCH - 1)).astype(np.int64)]
    order = np.lexsort((h, -rank, owner))
    h, owner, weight = h[order], owner[order], (count[order] * rank[order]).astype(np.float64)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    sizes = np.diff(starts, append=len(owner))
    nth = np.arange(len(owner)) - np.repeat(starts, sizes)
    before = np.cumsum(weight) - weight
    before -= np.repeat(before[starts], sizes)
    share = 1 - SIMILAR + 1e-9
    total = np.repeat(np.add.reduceat(weight, starts), sizes)
    rare = (nth <= np.repeat(sizes, sizes) * share) | (before <= total * share)
    return h[rare], owner[rare]


def with_rare_partners(members: DataFrame, whole: DataFrame, idf) -> DataFrame:
    """The rows of ``members`` (``item, class, ...``) whose text shares a rare shingle with a member of another class."""
    own = members.select("item", "class").distinct().join(whole, "item").select("item", "class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in _groups(as_bytes(batch.column(2), lower=True)):
                h, owner = rare_shingles(group, idf.value)
                at = pa.array(owner + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(h.view(np.int64))], names=["item", "class", "shingle"])

    rare = stored(own.mapInArrow(run, "item long, class long, shingle long"), "near-rare")
    shared = rare.groupBy("shingle").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("shingle")
    return members.join(rare.join(shared, "shingle", "left_semi").select("item").distinct(), "item", "left_semi")


def merged(members: DataFrame) -> DataFrame:
    """``key, item, class`` from ``key, leader, item, class``: the buckets of a leader as one group, where that makes fewer pairs than
    its buckets one by one."""
    union = members.select("leader", "item").distinct().groupBy("leader").agg(F.count("*").alias("u"))
    pairs = members.groupBy("leader", "key").count().groupBy("leader").agg(F.sum(F.col("count") * F.col("count")).alias("s"))
    how = union.join(pairs, "leader").select("leader", (F.col("u") * F.col("u") <= F.col("s")).alias("together"))
    key = F.when(F.col("together"), F.xxhash64(F.lit("leader"), "leader")).otherwise(F.col("key"))
    return members.join(how, "leader").select(key.alias("key"), "item", "class").distinct()


def verify(groups: DataFrame, idf) -> DataFrame:
    """Links ``a, b`` found in tiles ``key, i, j`` of rows ``item, class, part, text``.

    Compared are the texts of different classes that meet in the tile, linked those at ``SIMILAR`` by weighted or by plain
    Jaccard similarity; written are links that connect the same texts, fewer than texts.
    """
    dealt = groups.select("key", "i", "j", "item", "class", "part", "text").repartition("key", "i", "j")
    dealt = dealt.sortWithinPartitions("key", "i", "j", "item")

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        i, j = rows[0][1:3]
        kinds = {c: k for k, c in enumerate({r[4] for r in rows})}
        kind, part = np.array([kinds[r[4]] for r in rows]), np.array([r[5] for r in rows])
        wanted = meets(i, j, part) & (kind[:, None] != kind[None, :])
        if not wanted.any():
            return []
        weighted, plain = similarity([(r[6] or "").encode().lower() for r in rows], idf.value)
        root = local_links(wanted & ((weighted >= SIMILAR) | (plain >= SIMILAR)))
        return [(rows[a][3], rows[b][3]) for a, b in enumerate(root.tolist()) if a != b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 3):
            found = compare(rows)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _small(keys: DataFrame, bytes_each: int) -> DataFrame:
    """``keys`` with a broadcast hint if all of them are small."""
    return F.broadcast(keys) if keys.count() * bytes_each <= BROADCAST_BYTES else keys


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, digest, class_id``, and ``first_digest, rows`` of the text that stands for its class.

    A class is a set of texts connected by copies and by links at ``SIMILAR``; its id is its smallest document id (nulls
    last), ``rows`` how many rows have that id and that text. Equal texts are one class. Texts without a word (null and empty
    ones too) are compared with nothing, so each distinct one is a class of its own.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    idf = spark.sparkContext.broadcast(idf_table(*document_frequencies(docs, text)))
    signed = stored(signatures(docs, idf, doc_id, text), "near-signatures")
    texts = signed.groupBy("digest", "doc_id").agg(F.count("*").alias("rows"), F.first("bands").alias("bands"))
    texts = texts.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rows")).alias("first"), F.first("bands").alias("bands"))
    # distinct texts by a number of their own, which the table fixes
    texts = stored(texts.withColumn("item", F.monotonically_increasing_id()), "near-texts")
    sampled = texts.select("item", F.posexplode("bands").alias("band", "key"))
    member = F.xxhash64("item")
    buckets = sampled.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(member).alias("x"), F.sum(member % 1000003).alias("s")).where("n > 1")
    # the same members in several bands: once
    buckets = buckets.groupBy("n", "x", "s").agg(F.min("key").alias("key"))
    members = stored(sampled.drop("band").join(buckets, "key"), "near-members")
    needed = texts.select("item", "digest").join(members.select("item").distinct(), "item")
    own = docs.select(_digest(text).alias("digest"), F.col(text).alias("text"))
    whole = own.join(_small(needed, 60), "digest").groupBy("item").agg(F.first("text").alias("text"))
    whole = stored(whole.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0))), "near-whole")
    lengths, whole = whole.select("item", "bytes"), whole.select("item", "text")
    # the leader of a bucket is the member that meets most others over all its buckets
    met = members.groupBy("item").agg(F.sum("n").alias("met"))
    leaders = members.join(met, "item").groupBy("key").agg(F.max_by("item", F.struct("met", "item")).alias("leader"))
    leaders = stored(leaders, "near-leaders")
    others = members.join(leaders.select("key", "leader"), "key").where("item <> leader")
    # a leader meets each member once, however many buckets they share
    pairs = others.select("leader", "item").distinct()
    parts = F.greatest(F.ceil(F.count("*") / F.lit(TILE)), F.ceil(F.sum("bytes") / F.lit(TILE_BYTES)), F.lit(1)).cast("int")
    sizes = pairs.join(lengths, "item").groupBy("leader").agg(parts.alias("parts"))
    lead = sizes.select(F.col("leader").alias("key"), F.col("leader").alias("item"), F.lit(-1).alias("part"),
                        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    rest = pairs.join(sizes, "leader").withColumn("part", F.pmod(member, F.col("parts")).cast("int")).select(
        F.col("leader").alias("key"), "item", "part", F.col("part").alias("i"))
    star = lead.unionByName(rest).join(whole, "item")
    links = stored(verify_stars(star, idf), "near-links")
    found = stored(components(links, "near-classes"), "near-found")
    # what a leader did not settle: members of one bucket in different classes
    left = others.join(found.withColumnRenamed("node", "item"), "item", "left").select(
        "key", "leader", "item", F.coalesce("root", "item").alias("class"))
    open_buckets = left.groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("key")
    left = stored(left.join(open_buckets, "key", "left_semi"), "near-left")
    left = stored(merged(stored(with_rare_partners(left, whole, idf), "near-left")), "near-left")
    dealt = tiles(left.join(lengths, "item"), TILE, "bytes", TILE_BYTES)
    more = stored(verify(dealt.join(whole, "item"), idf), "near-links")
    if not more.isEmpty():
        found = stored(components(links.unionByName(more), "near-classes"), "near-found")
    rooted = texts.join(found.withColumnRenamed("node", "item"), "item", "left").select(
        "digest", "first", F.coalesce("root", "item").alias("root"))
    heads = rooted.groupBy("root").agg(F.min(F.struct("first", "digest")).alias("head"))
    named = rooted.join(heads, "root").select(
        "digest", F.col("head.first.doc_id").alias("class_id"), F.col("head.digest").alias("first_digest"),
        F.col("head.first.rows").alias("rows"))
    named = stored(named, "near-named")
    return signed.select("doc_id", "digest").join(_small(named, 150), "digest")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, kept``. Kept is the document that names its class; rows that repeat
    its id and text are all marked kept."""
    found = classes(docs, doc_id, text)
    return found.select("doc_id", "class_id", (
        F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("first_digest"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns.

    Rows that repeat the id and text of the one that stays are dropped as well.
    """
    found = stored(classes(docs, doc_id, text), "near-classes")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("first_digest"))
    gone = _small(found.where(~stays).select("doc_id", "digest").distinct(), 60)
    rows = docs.select(F.struct("*").alias("row"), _digest(text).alias("_digest"))
    same = F.col(f"row.{doc_id}").eqNullSafe(gone["doc_id"]) & (F.col("_digest") == gone["digest"])
    rows = rows.join(gone, same, "left_anti")
    again = found.where(stays & (F.col("rows") > 1)).select("doc_id", "digest").distinct()
    if not again.isEmpty():  # repeated rows: only these go through one more shuffle
        again = _small(again, 60)
        same = F.col(f"row.{doc_id}").eqNullSafe(again["doc_id"]) & (F.col("_digest") == again["digest"])
        once = rows.join(again, same, "left_semi").groupBy(F.col(f"row.{doc_id}"), "_digest").agg(F.first("row").alias("row"))
        rows = rows.join(again, same, "left_anti").select("row").unionByName(once.select("row"))
    return rows.select("row.*")
