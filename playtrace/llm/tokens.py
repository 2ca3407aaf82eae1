"""A byte-level BPE tokenizer inside tasks: whole texts, in numpy, with the ids of pieces seen before kept per Python worker.

A text is cut into pieces before each run of white space. No pre-token of the byte-level pattern spans such a cut and none
looks back over it, so pieces can be encoded one by one; equal pieces, told by a 64-bit hash and their length, once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np

from playtrace.llm.common import BYTE_HASH, SPACE, mix64, powers

# Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces kept by a worker; beyond that it starts afresh, which changes time, not ids.
KEPT = 400_000
#: Bytes of text that are cut and hashed at once.
GROUP = 1 << 21


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _after_wide_space(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position is white space beyond ASCII."""
    one, two, three = b[at - 1], b[at - 2], b[at - 3]
    latin = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    general = (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    return latin | general | (three == 0xE2) & (two == 0x81) & (one == 0x9F) | (
        (three == 0xE1) & (two == 0x9A) & (one == 0x80)) | (three == 0xE3) & (two == 0x80) & (one == 0x80)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Encoder:
    """Ids equal to ``Tokenizer.encode`` without special tokens."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, vocab = _byte_symbols(), spec["model"]["vocab"]
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        ranks = {bytes(symbols[c] for c in t): i for t, i in vocab.items() if t.encode() not in self.special}
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError(f"{path} is no byte-level BPE whose ids follow its merges")
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(len(ranks), np.int64)
        for t, i in ranks.items():
            self.size[i] = len(t)
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # hashes, sorted
        self.at = np.empty(0, np.int64)  # where the ids of each begin
        self.n = np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def _learn(self, b: np.ndarray, hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Encode new pieces: in one call those that stay apart when strung together, the others alone."""
        first, last = b[start], b[start + size - 1]
        alone = ~SPACE[first] | SPACE[last] | (last >= 0x80) & _after_wide_space(b, start + size)
        joined = np.flatnonzero(~alone)
        text = b[_ranges(start[joined], size[joined])].tobytes().decode()
        ids = np.array(self.fast.encode_ordinary(text), np.uint32)
        cuts = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(size[joined])) + 1
        counts = np.zeros(len(hashes), np.int64)
        counts[joined] = np.diff(cuts, prepend=0)
        pieces = [ids]
        for i in np.flatnonzero(alone).tolist():
            own = self.fast.encode_ordinary(b[start[i]:start[i] + size[i]].tobytes().decode())
            pieces.append(np.array(own, np.uint32))
            counts[i] = len(own)
        order = np.concatenate((joined, np.flatnonzero(alone)))
        if len(self.known) + len(hashes) > KEPT:
            self._forget()
        at = np.empty(len(hashes), np.int64)
        at[order] = len(self.pool) + np.cumsum(counts[order]) - counts[order]
        self.pool = np.concatenate((self.pool, *pieces))
        known = np.concatenate((self.known, hashes))
        sort = np.argsort(known, kind="stable")
        self.known, self.at, self.n = known[sort], np.concatenate((self.at, at))[sort], np.concatenate((self.n, counts))[sort]

    def _group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, ids of each piece, code points of each piece, text of each piece)``."""
        sizes = np.array([len(t) for t in texts], np.int64)
        b = np.frombuffer(b"".join(texts), np.uint8)
        if not len(b):
            return np.empty(0, np.uint32), *[np.empty(0, np.int64)] * 3
        space = SPACE[b]
        begins = (np.cumsum(sizes) - sizes)[sizes > 0]
        first = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        first = first[~((b[first - 1] >= 0x80) & _after_wide_space(b, first))]
        mark = np.zeros(len(b), bool)
        mark[first] = mark[begins] = True
        start = np.flatnonzero(mark)
        size = np.diff(start, append=len(b))
        up, down = powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(BYTE_HASH[b] * up[:-1], out=total[1:])
        hashes = mix64((total[start + size] - total[start]) * down[start] + size.astype(np.uint64))
        own, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        found = self._places(own)
        if (found < 0).any():
            if len(self.known) + int((found < 0).sum()) > KEPT:
                self._forget()
                found[:] = -1
            new = np.flatnonzero(found < 0)
            self._learn(b, own[new], start[where[new]], size[where[new]])
            found = self._places(own)
        n = self.n[found][back]
        ids = self.pool[_ranges(self.at[found][back], n)]
        chars = np.add.reduceat((b & 0xC0 != 0x80).astype(np.int64), start)
        owner = np.flatnonzero(sizes > 0)[np.searchsorted(begins, start, side="right") - 1]
        return ids, n, chars, owner

    def _places(self, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, own)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == own[hit]
        return np.where(hit, at, -1)

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        """For each text its ids (little-endian unsigned 32-bit), and the ids and code points of its pieces."""
        group: list[bytes] = []
        lasts: list[int] = []  # chunk number after which a text ends
        total = 0

        def flush() -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
            ids, n, chars, owner = self._group(group)
            per = np.bincount(owner, minlength=len(group))
            ends = np.cumsum(per)
            upto = np.concatenate(([0], np.cumsum(n)))
            data, at = ids.astype("<u4").tobytes(), 0
            for last in lasts:
                end = int(ends[last])
                yield data[4 * int(upto[at]):4 * int(upto[end])], n[at:end], chars[at:end]
                at = end

        for text in texts:
            if len(text) > GROUP and group:
                yield from flush()
                group, lasts, total = [], [], 0
            if len(text) > GROUP:
                yield self._long(text)
                continue
            group.append(text)
            lasts.append(len(group) - 1)
            total += len(text)
            if total >= GROUP:
                yield from flush()
                group, lasts, total = [], [], 0
        if group:
            yield from flush()

    def _long(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """A text above the group size, cut where its pieces are, a group at a time."""
        ids, n, chars, at = [], [], [], 0
        while at < len(text):
            end = min(at + GROUP, len(text))
            while end < len(text) and not (SPACE[text[end]] and not SPACE[text[end - 1]] and text[end - 1] < 0x80):
                end += 1
            own = self._group([text[at:end]])
            ids.append(own[0].astype("<u4").tobytes())
            n.append(own[1])
            chars.append(own[2])
            at = end
        return b"".join(ids), np.concatenate(n), np.concatenate(chars)

    def is_special(self, text: bytes) -> bool:
        """Whether a text holds a special token's string, which the tokenizer takes as that token."""
        return any(s in text for s in self.special)

    def count_whole(self, text: str) -> int:
        return len(self.whole.encode(text, add_special_tokens=False).ids)

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, special tokens' strings included."""
        for text, (ids, _, _) in zip(texts, self.pieces(texts)):
            if self.is_special(text):
                ids = np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            yield ids


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, made once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
