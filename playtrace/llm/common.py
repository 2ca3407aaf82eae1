"""What the operators share: stored intermediate tables, Arrow batches of texts, word and shingle hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in the syntax of Java's, Python's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one vectorised step takes at once; longer texts are cut at white space.
CHUNK = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    Where neither is set, a local folder serves in local mode, and any other master is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe against lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Keep Arrow batches small enough that long texts do not fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def n_words(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def as_bytes(column: pa.Array, lower: bool = False) -> list[bytes]:
    """UTF-8 texts of an Arrow string column, null as empty; ``lower`` maps A-Z only."""
    texts = [x or b"" for x in column.cast(pa.binary()).to_pylist()]
    return [x.lower() for x in texts] if lower else texts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        inverse = pow(int(_ODD), -1, 1 << 64)
        for name, base in (("up", _ODD), ("down", np.uint64(inverse))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _hash_buffer(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, start)`` of each word of a buffer that ends with white space."""
    b = np.frombuffer(buffer, np.uint8)
    space = SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    start = start[:len(end)]
    up, down = powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(BYTE_HASH[b] * up[:-1], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end < len(text) and not SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes of all words, number of words of each text)``, whole texts, a bounded buffer at a time."""
    hashes, counts = [np.empty(0, np.uint64)], np.zeros(len(texts), np.int64)
    group: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal group, owner, size
        if group:
            h, start = _hash_buffer(b"\n".join(group) + b"\n")
            hashes.append(h)
            ends = np.cumsum([len(x) + 1 for x in group])
            per = np.diff(np.searchsorted(start, ends), prepend=0)
            np.add.at(counts, owner, per)
        group, owner, size = [], [], 0

    for i, text in enumerate(texts):
        for piece in _pieces(text):
            group.append(piece)
            owner.append(i)
            size += len(piece) + 1
            if size >= CHUNK:
                flush()
    flush()
    return np.concatenate(hashes), counts


def windows(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, first word)`` of every window of ``width`` words within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = hashes[:n].copy()
    for k in range(1, width):
        h *= _ODD
        h += hashes[k:n + k]
    left = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n)  # words to the end of the text
    at = np.flatnonzero(left >= width)
    return mix64(h[at]), at


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(shingle, text number)``; a text with fewer words than ``width`` has one shingle of all of them, if any."""
    h, at = windows(hashes, counts, width)
    ends = np.cumsum(counts)
    owner = np.searchsorted(ends, at, side="right")
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        own = []
        for i in short:
            x = np.uint64(counts[i])
            with np.errstate(over="ignore"):
                for y in hashes[ends[i] - counts[i]:ends[i]]:
                    x = x * _ODD + y
            own.append(x)
        h = np.concatenate((h, mix64(np.array(own, np.uint64))))
        owner = np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    return h, owner
