"""Fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames of ``FRAME`` bytes, cut between code points, with the units and code points that
lie before each. A cut after so many units needs only the frame that holds it; outputs and digests run through the frames in the
order of the form, one open at a time, so no more than a frame of a text is ever unpacked.

A unit is a word with the white space before it, or white space at the end: units begin at the start of the text and wherever
white space follows something else, so counting them needs no more than neighbouring bytes and a unit may span frames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import SPACE, as_bytes, bounded_batches

FRAME = 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The sections of an output in their order; ``plain`` texts are left as they are.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_PACK, _UNPACK = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


@dataclass(frozen=True)
class Plan:
    """How documents are cut: numbers after ``seed`` and the id decide (see ``choices``)."""

    seed: int = 42
    cut_percent: int = 50
    spm_percent: int = 80


def _begins(frame: bytes, whole: int | None = None) -> np.ndarray:
    """Where units begin in a frame. Its first byte begins one if ``whole``, the units that begin in it, asks for one more."""
    space = SPACE[np.frombuffer(frame, np.uint8)]
    inner = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    return np.concatenate(([0], inner)) if whole is not None and whole > len(inner) else inner


def _chars(data: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def to_frames(text: bytes, size: int = FRAME) -> tuple[list[bytes], list[int], list[int]]:
    """``(frames, units before each and in all, code points before each and in all)``; an empty text has no frame."""
    frames, units, chars, at = [], [0], [0], 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        own = text[at:end]
        first = at == 0 or SPACE[text[at]] and not SPACE[text[at - 1]]
        frames.append(_PACK.compress(own))
        units.append(units[-1] + len(_begins(own)) + bool(first))
        chars.append(chars[-1] + _chars(own))
        at = end
    return frames, units, chars


class Framed:
    """A text in frames, opened one frame at a time."""

    def __init__(self, frames: list[bytes], units: list[int], chars: list[int]):
        self.frames, self.units, self.chars = frames, units, chars
        self._open: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._open[0] != k:
            self._open = (k, _UNPACK.decompress(self.frames[k]))
        return self._open[1]

    def cut(self, unit: int) -> tuple[int, int, int]:
        """``(frame, byte in it, code points before)`` of where a unit begins, or of the end after the last one."""
        if unit >= self.units[-1]:
            return len(self.frames), 0, self.chars[-1]
        k = int(np.searchsorted(self.units, unit, side="right")) - 1
        data = self.frame(k)
        at = int(_begins(data, self.units[k + 1] - self.units[k])[unit - self.units[k]])
        return k, at, self.chars[k] + _chars(data[:at])

    def span(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> Iterator[bytes]:
        """The bytes between two cuts, frame by frame."""
        for k in range(start[0], min(end[0] + (end[1] > 0), len(self.frames))):
            data = self.frame(k)
            yield data[start[1] if k == start[0] else 0:end[1] if k == end[0] else len(data)]


def choices(doc_id: int | None, plan: Plan = Plan()) -> tuple[int, int, int, int]:
    """Four numbers from the SHA-256 of seed and id; a null id counts as the empty text."""
    h = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[8 * i:8 * i + 8], 16) for i in range(4))


def form_of(doc_id: int | None, empty: bool, marked: bool, plan: Plan = Plan()) -> str:
    h = choices(doc_id, plan)
    if empty or marked or h[2] % 100 >= plan.cut_percent:
        return "plain"
    return "spm" if h[3] % 100 < plan.spm_percent else "psm"


def transformed(text: Framed, doc_id: int | None, marked: bool, plan: Plan = Plan()) -> tuple[str, int | None, int | None, Iterator[bytes]]:
    """``(form, code points of the prefix, of the middle, the output piece by piece)``."""
    n, start, end = text.units[-1], (0, 0, 0), (len(text.frames), 0, text.chars[-1])
    form = form_of(doc_id, not n, marked, plan)
    if form == "plain":
        return form, None, None, text.span(start, end)
    first, second = sorted(h % (n + 1) for h in choices(doc_id, plan)[:2])
    a, b = text.cut(first), text.cut(second)
    sections = {PREFIX: (start, a), MIDDLE: (a, b), SUFFIX: (b, end)}

    def output() -> Iterator[bytes]:
        for mark in ORDER[form]:
            yield mark
            yield from text.span(*sections[mark])

    return form, a[2], b[2] - a[2], output()


def sections(output: Iterable[bytes], form: str) -> dict[bytes, list[bytes]]:
    """The sections of an output that comes in pieces of any size, each kept as compressed frames."""
    if form == "plain":
        return {PREFIX: [_PACK.compress(x) for x in output]}
    marks = ORDER[form]
    out: dict[bytes, list[bytes]] = {m: [] for m in marks}
    held, k = b"", -1  # bytes that may begin a mark, and the section that is open
    for piece in output:
        held += piece
        while k + 1 < len(marks) and (at := held.find(marks[k + 1])) >= 0:
            if at:
                out[marks[k]].append(_PACK.compress(held[:at]))
            held, k = held[at + len(marks[k + 1]):], k + 1
        keep = len(PREFIX) - 1 if k + 1 < len(marks) else 0
        if len(held) > keep:
            out[marks[k]].append(_PACK.compress(held[:len(held) - keep]))
            held = held[len(held) - keep:]
    if held:
        out[marks[k]].append(_PACK.compress(held))
    return out


def restored(output: Iterable[bytes], form: str) -> Iterator[bytes]:
    """The text that an output and its form stand for, piece by piece."""
    found = sections(output, form)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        for frame in found.get(mark, ()):
            yield _UNPACK.decompress(frame)


def store_frames(docs: DataFrame, doc_id: str | Column = "doc_id", text: str = "text", size: int = FRAME) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, marked, frames, units, chars``.

    ``n`` is the number of units, ``marked`` whether the text holds a mark of the outputs. A null text counts as empty and has no
    frame; rows that repeat an id stay rows of their own; other columns of ``docs`` are left out, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType.fromDDL(
        "doc_id long, n long, marked boolean, frames array<binary>, units array<long>, chars array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            frames, units, chars = zip(*(to_frames(t, size) for t in texts)) if texts else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([u[-1] for u in units], pa.int64()),
                pa.array([any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts], pa.bool_()),
                pa.array(frames, pa.list_(pa.binary())), pa.array(units, pa.list_(pa.int64())),
                pa.array(chars, pa.list_(pa.int64()))], names=schema.names)

    return own.mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bool, Framed]]:
    ids, marked = batch.column("doc_id").to_pylist(), batch.column("marked").to_pylist()
    parts = [batch.column(c) for c in ("frames", "units", "chars")]
    for i, (doc_id, mark) in enumerate(zip(ids, marked)):
        yield doc_id, mark, Framed(*(c[i].as_py() for c in parts))


def transform(framed: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row of ``store_frames``."""
    bounded_batches(framed.sparkSession)
    schema = T.StructType.fromDDL("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(f, p, m, b"".join(o)) for i, mark, t in _rows(batch) for f, p, m, o in [transformed(t, i, mark, plan)]]
            form, prefix, middle, output = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n"), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)

    return framed.mapInArrow(run, schema)


def _digest(pieces: Iterable[bytes]) -> str:
    h = hashlib.sha256()
    for piece in pieces:
        h.update(piece)
    return h.hexdigest()


def digests(framed: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each row of ``store_frames``.

    Both digests are taken from frames in a stream: of the output, and of the text that is rebuilt from the output and its form.
    """
    bounded_batches(framed.sparkSession)
    schema = T.StructType.fromDDL(
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, mark, text in _rows(batch):
                form, prefix, middle, output = transformed(text, doc_id, mark, plan)
                whole = hashlib.sha256()

                def passing() -> Iterator[bytes]:
                    for piece in output:
                        whole.update(piece)
                        yield piece

                back = _digest(restored(passing(), form))
                out.append((form, prefix, middle, whole.hexdigest(), back))
            form, prefix, middle, digest, back = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n"), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())], names=schema.names)

    return framed.mapInArrow(run, schema)
