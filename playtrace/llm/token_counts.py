"""Edit-aware token counts: a segment tree of characters and tokens per document, updated where edits touch it.

The leaves are runs of ``LEAF`` pre-token segments (white space with the word after it). A segment's tokens depend on nothing
outside it, so after an edit only the segments that hold a character next to the edited range can change: those are cut
and encoded again, and the sums above their leaves are updated. A tree of n leaves is two arrays in heap order, node 1 the
root, nodes n to 2n-1 the leaves: characters below a node, tokens below it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.llm.common import bounded_batches
from playtrace.llm.tokens import Encoder, encoder

LEAF = 16
EDIT = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType())])


class CountTree:
    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.text, self.chars, self.tokens = text, chars, tokens
        self.n = len(chars) // 2
        self.recoded = 0

    @staticmethod
    def build(text: str, size: np.ndarray, count: np.ndarray) -> CountTree:
        """From the code points and tokens of the segments of ``text``."""
        if not len(size):
            size = count = np.zeros(1, np.int64)
        starts = np.arange(0, len(size), LEAF)
        return CountTree(text, *(_heap(np.add.reduceat(values, starts)) for values in (size, count)))

    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, position: int) -> tuple[int, int]:
        """``(leaf, its first character)`` of the leaf that holds a character; the last used leaf beyond the end."""
        node, before = 1, 0
        position = min(position, max(int(self.chars[1]) - 1, 0))
        while node < self.n:
            node *= 2
            if position >= before + self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return node - self.n, before

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.n
        more = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2

    def _grow(self, first: int, last: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """New leaves in place of the leaves from ``first`` to ``last``; empty ones go, and the sums above are made anew."""
        own = []
        for tree, values in ((self.chars, chars), (self.tokens, tokens)):
            leaves = tree[self.n:]
            own.append(np.concatenate((leaves[:first], np.add.reduceat(values, np.arange(0, len(values), LEAF)), leaves[last + 1:])))
        used = own[0] > 0
        self.chars, self.tokens = (_heap(x[used]) for x in own)
        self.n = len(self.chars) // 2

    def _recode(self, start: int, end: int, before: str, new: str, after: Callable[[int], str], encode: Encoder) -> None:
        """Characters ``[start, end)`` become ``new``. The leaves from that of the character before to that of the one after are cut
        again into segments; their content goes to the first of them, or to new leaves where it is more than two leaves hold."""
        first, a = self.find(max(start - 1, 0))
        last, b = self.find(end)
        region = before[a:start] + new + after(b + int(self.chars[last + self.n]) - end)
        _, tokens, chars = next(encode.pieces([region.encode()]))
        self.recoded += len(tokens)
        if len(tokens) > 2 * LEAF:
            return self._grow(first, last, chars, tokens)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, 0, 0)
        self._set(first, len(region), int(tokens.sum()))

    def edit(self, start: int, end: int, new: str, encode: Encoder) -> None:
        """Replace characters ``[start, end)``."""
        old = self.text
        self._recode(start, end, old, new, lambda n: old[end:end + n], encode)
        self.text = old[:start] + new + old[end:]

    def edits(self, edits: list[tuple[int, int, str]], encode: Encoder) -> None:
        """Edits in ranges of the text as it is, from the last to the first and apart from each other; the text is put together once."""
        old, upto = self.text, len(self.text)
        done: list[str] = []  # what stands after ``upto``, last piece first

        def after(n: int) -> str:
            out = []
            for piece in reversed(done):
                if n <= 0:
                    break
                out.append(piece[:n])
                n -= len(out[-1])
            return "".join(out)

        for start, end, new in edits:
            done.append(old[end:upto])
            self._recode(start, end, old, new, after, encode)
            done.append(new)
            upto = start
        self.text = "".join([old[:upto], *reversed(done)])


def _heap(leaves: np.ndarray) -> np.ndarray:
    """The tree of sums over ``leaves``."""
    leaves = leaves if len(leaves) else np.zeros(1, np.int64)
    n = 1 << (len(leaves) - 1).bit_length()
    tree = np.zeros(2 * n, np.int64)
    tree[n:n + len(leaves)] = leaves
    level = n
    while level > 1:
        tree[level // 2:level] = tree[level:2 * level:2] + tree[level + 1:2 * level:2]
        level //= 2
    return tree


def clean_edits(edits: list[dict] | None, size: int) -> list[tuple[int, int, str]]:
    """Edits from the last to the first: ranges cut to the text, and of two that overlap the one that starts later (at
    equal starts, the one listed first) is left out. Null bounds or texts make no edit."""
    out, at = [], 0
    for e in sorted((e for e in edits or () if e and None not in (e["start"], e["end"], e["text"])), key=lambda e: e["start"]):
        start, end = max(0, min(e["start"], size)), max(0, min(e["end"], size))
        if start <= end and start >= at:
            out.append((start, end, e["text"]))
            at = max(end, start)
    return out[::-1]


def build_trees(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", edits: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, chars, tokens`` (the tree) and, if named, the column of edits.

    A null or empty text has a tree of one empty leaf; rows that repeat an id have trees of their own; other columns are left out.
    """
    return _run(docs, tokenizer, [F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *([F.col(edits).alias("edits")] if edits else [])])


def apply_edits(trees: DataFrame, tokenizer: str, find: Callable[[str], list[dict]] | None = None) -> DataFrame:
    """``trees`` after their edits: the same columns, and ``before, after, recoded, n_edits``.

    Edits are a column ``edits``, or what ``find`` gives for a text: ranges of the text as it was, applied from the last to the
    first. Without edits a document is not touched. A text that holds the string of a special token is counted whole by the tokenizer.
    """
    return _run(trees, tokenizer, [F.col(c) for c in ("doc_id", "text", "chars", "tokens", *(() if find else ("edits",)))], find)


def _run(df: DataFrame, tokenizer: str, columns: list, find: Callable[[str], list[dict]] | None = None) -> DataFrame:
    bounded_batches(df.sparkSession)
    own = df.select(*columns)
    given = own.columns
    updating = "chars" in given
    numbers = T.ArrayType(T.LongType())
    fields = [own.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("chars", numbers), T.StructField("tokens", numbers)]
    if "edits" in given:
        fields.append(own.schema["edits"])
    if updating:
        fields += [T.StructField(c, T.LongType()) for c in ("before", "after", "recoded", "n_edits")]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out: dict[str, list] = {f.name: [] for f in schema.fields[1:] if f.name != "edits"}
            if updating:
                wanted = map(find, texts) if find else batch.column(4).to_pylist()
                trees = zip(texts, _arrays(batch.column(2)), _arrays(batch.column(3)), wanted)
                for text, chars, tokens, edits in trees:
                    tree = CountTree(text, chars.copy(), tokens.copy())
                    before, todo = encode.count_whole(text) if encode.is_special(text.encode()) else tree.total(), clean_edits(edits, len(text))
                    tree.edits(todo, encode)
                    after = encode.count_whole(tree.text) if encode.is_special(tree.text.encode()) else tree.total()
                    for name, value in (("text", tree.text), ("chars", tree.chars), ("tokens", tree.tokens), ("before", before),
                                        ("after", after), ("recoded", tree.recoded), ("n_edits", len(todo))):
                        out[name].append(value)
            else:
                for text, (_, count, size) in zip(texts, encode.pieces([t.encode() for t in texts])):
                    tree = CountTree.build(text, size, count)
                    for name, value in (("text", text), ("chars", tree.chars), ("tokens", tree.tokens)):
                        out[name].append(value)
            arrays = [batch.column(0)]
            for f in schema.fields[1:]:
                if f.name == "edits":
                    arrays.append(batch.column(given.index("edits")))
                elif f.name in ("chars", "tokens"):
                    arrays.append(_lists(out[f.name]))
                else:
                    arrays.append(pa.array(out[f.name], pa.string() if f.name == "text" else pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return own.mapInArrow(run, schema)


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The lists of an Arrow column as numpy views."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[a:b] for a, b in zip(ends, ends[1:]))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


#: What a release of the corpus masks: mail addresses, network addresses, long runs of digits and of hexadecimal digits.
MASKED = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b[0-9a-f]{24,}\b|\d{7,}"


_MASKED = re.compile(MASKED, re.ASCII)


def masking(text: str, to: str = "[masked]") -> list[dict]:
    """The edits that replace everything that ``MASKED`` finds."""
    return [{"start": m.start(), "end": m.end(), "text": to} for m in _MASKED.finditer(text)]
