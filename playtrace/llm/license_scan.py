"""License scans by a positional rare-token index, in DataFrame expressions only.

The index lists, for each licence word, the templates and the places in them where it stands. A file looks up the places
of its rarest licence words (by the inverse document frequency over all files); each hit votes for an alignment, file
position minus template position; an alignment counts if the template's mandatory key phrase stands there word by word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands between words, once capitals are small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: str  # the notice
    key: str  # the phrase in it that must stand in the file
    base: bool = False

    @property
    def tokens(self) -> list[str]:
        return self.words.split()

    @property
    def key_tokens(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        size = len(self.key_tokens)
        return next(i for i in range(len(self.tokens)) if self.tokens[i:i + size] == self.key_tokens)


# The base phrases first, then notices of common licences with their key phrases.
TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license version 3"),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license version 3"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2"),
    Template("epl-2", "terms of the eclipse public license version 2 0", "eclipse public license version 2"),
    Template("epl-2", "terms of the eclipse public license v 2 0", "eclipse public license v 2"),
    Template("bsd-3", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    Template("bsd-2", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms with or without modification"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             "permission to use copy modify and or distribute this software"),
    Template("isc", "licensed under the isc license", "under the isc license"),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0", "cc by nc sa"),
    Template("cc-by-nc-nd", "licensed under cc by nc nd 4 0", "cc by nc nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4"),
    Template("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software released into the public domain"),
    Template("boost-1", "distributed under the boost software license version 1 0", "boost software license version 1"),
)


def _sql(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _words(text: Column) -> Column:
    """All words of a text in small letters.

    ``lower`` also maps letters beyond A-Z, which changes no border between words; only the Kelvin sign would become an
    ASCII letter, so it is replaced by another letter first.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u03ba")))
    return F.array_remove(F.split(low, BETWEEN), "")


def _array(words: list[str]) -> str:
    return f"array({', '.join(map(_sql, words))})"


def word_weights(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each licence word over all files: ln((files + 1) / (files with it + 1)) + 1."""
    vocabulary = sorted({w for t in templates for w in t.tokens})
    own = docs.select(_words(F.col(text)).alias("words"))
    found = own.select(F.expr(f"array_intersect(words, {_array(vocabulary)})").alias("own"))
    counts = found.select(F.explode(F.array_append("own", F.lit(""))).alias("word")).groupBy("word").count().collect()
    by = {r["word"]: r["count"] for r in counts}  # one row per licence word, and "" for all files
    n = by.get("", 0)
    return {w: round(math.log((n + 1) / (by.get(w, 0) + 1)) + 1, 9) for w in vocabulary}


def scan(
        docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES,
        lookups: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, words, base places and labels, all labels, score.

    For each template a file looks up the ``lookups`` rarest words of the key phrase; as a key phrase can only stand where
    all its words do, one vote finds the alignment and none is missed. ``score`` is the largest share of a verified
    template's weight (sum of its words' weights) that stands at its alignment, 0 without one. Null texts are empty; rows
    that repeat an id stay rows of their own.
    """
    weights = word_weights(docs, text, templates)
    own = docs.select(F.col(doc_id).alias("doc_id"), _words(F.col(text)).alias("words"))
    postings, rarest = [], set()
    for k, t in enumerate(templates):
        rare = sorted({*t.key_tokens}, key=lambda w: (-weights[w], w))[:lookups]
        rarest.add(rare[0])
        postings += [(w, k, t.key_at + i) for i, w in enumerate(t.key_tokens) if w in rare]
    index = {w: [(k, i) for x, k, i in postings if x == w] for w in sorted({x for x, _, _ in postings})}
    listed = ", ".join(map(_sql, index))
    some = f"arrays_overlap(words, {_array(sorted(rarest))})"  # without a template's rarest key word it cannot stand
    hits = own.withColumn("hits", F.expr(
        f"IF({some}, filter(transform(words, (w, i) -> struct(i AS pos, w AS word)), x -> x.word IN ({listed})), "
        "CAST(array() AS ARRAY<STRUCT<pos: INT, word: STRING>>))"))
    # a vote is one number, template and alignment, so that the votes of a long text are told apart by a hash set
    shift = max(len(t.tokens) for t in templates)
    cases = " ".join(
        f"WHEN {_sql(w)} THEN array({', '.join(f'{k << 32}L + x.pos + {shift - i}' for k, i in listed)})"
        for w, listed in index.items())
    votes = (f"transform(array_distinct(flatten(transform(hits, x -> CASE x.word {cases} END))), "
             f"v -> struct(CAST(shiftright(v, 32) AS INT) AS t, CAST((v & 4294967295L) AS INT) - {shift} AS at))")
    # verify: the key phrase stands at the alignment, word by word among the file's licence words
    keys = "array({})".format(", ".join(
        f"struct({t.key_at} AS at, {len(t.key_tokens)} AS size, {_sql(' '.join(t.key_tokens))} AS key, "
        f"{_sql(t.label)} AS label, {str(t.base).lower()} AS base, {sum(weights[w] for w in t.tokens)!r}D AS total, "
        f"array({', '.join(map(_sql, t.tokens))}) AS words, array({', '.join(f'{weights[w]!r}D' for w in t.tokens)}) AS weights)"
        for t in templates))
    start = f"v.at + {keys}[v.t].at"
    there = f"slice(words, {start} + 1, {keys}[v.t].size)"
    stands = f"IF({start} < 0, false, array_join({there}, ' ') = {keys}[v.t].key)"
    found = hits.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "words",
        F.expr(f"IF(size(hits) > 0, filter({votes}, v -> {stands}), CAST(array() AS ARRAY<STRUCT<t: INT, at: INT>>))").alias("found"))
    share = (f"transform(found, v -> aggregate(sequence(0, size({keys}[v.t].words) - 1), 0D, (s, i) -> s + "
             f"IF(v.at + i >= 0 AND v.at + i < size(words) AND get(words, v.at + i) = {keys}[v.t].words[i], {keys}[v.t].weights[i], 0D))"
             f" / {keys}[v.t].total)")
    base = f"filter(found, v -> {keys}[v.t].base)"
    starts = f"transform({base}, v -> CAST({start} AS BIGINT))"

    def labels(of: str) -> str:
        return f"array_join(array_sort(array_distinct(transform({of}, v -> {keys}[v.t].label))), ',')"

    return found.select(
        "doc_id", "n_words", F.expr(f"CAST(size({base}) AS BIGINT)").alias("n_base"),
        F.expr(f"array_min({starts})").alias("first_word"), F.expr(f"array_max({starts})").alias("last_word"),
        F.expr(labels(base)).alias("base_labels"), F.expr(labels("found")).alias("labels"),
        F.expr(f"IF(size(found) > 0, round(array_max({share}), 6), 0D)").alias("score"))
