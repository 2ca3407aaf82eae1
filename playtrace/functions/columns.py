"""Column expressions. All compile to built-in functions; none is a Python UDF."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from playtrace.schema import FIRST_QUESTION, LANDMARKS, PHASES, Landmark, null_token


def category(column: str) -> Column:
    """A column as a category: text, with nulls spelt as the column's null token."""
    return F.coalesce(F.col(column).cast("string"), F.lit(null_token(column)))


def bounded(x: Column, low, high) -> Column:
    """``x`` within ``[low, high]``, null where ``x`` is null (``least``/``greatest`` alone skip nulls)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def nan_to(x: Column, value: float = -1.0) -> Column:
    """Replace NaN only; a null stays null."""
    return F.nanvl(x, F.lit(value))


def has_word(text: Column, word: str, word_boundary: bool = False) -> Column:
    """Case-sensitive substring test ("is" is found in "this"), or a whole-word one on request."""
    return text.rlike(rf"\b{word}\b") if word_boundary else text.contains(word)


def matches(any_of: tuple[dict[str, str], ...]) -> Column:
    """OR over alternatives, each an AND of equalities; null comparisons count as no match."""
    alternatives = [reduce(and_, [F.col(c) == v for c, v in rule.items()]) for rule in any_of]
    return F.coalesce(reduce(or_, alternatives), F.lit(False))


def landmark(name: str, landmarks: list[Landmark] = LANDMARKS) -> Column:
    return matches(next(m.any_of for m in landmarks if m.name == name))


def label_question(label_id: Column) -> Column:
    """Question number of ``<session>_q<n>``; null where there is none."""
    return F.regexp_extract(label_id, r"q(\d+)", 1).try_cast("int")


def label_session(label_id: Column) -> Column:
    return F.regexp_extract(label_id, r"(\d+)", 1).try_cast("long")


def question_phase(question: Column) -> Column:
    """Phase after which a question is asked."""
    later = sorted(((FIRST_QUESTION[p], p) for p in PHASES[1:]), reverse=True)
    expr = F
    for first, phase in later:
        expr = expr.when(question >= first, phase)
    return expr.when(question.isNotNull(), PHASES[0])


def level_phase(level: Column) -> Column:
    """Phase that a game level belongs to, from the bounds in the phase names."""
    expr = F
    for phase in PHASES[:-1]:
        expr = expr.when(level <= int(phase.split("-")[1]), phase)
    return expr.when(level.isNotNull(), PHASES[-1])


def dotted_parts(x: Column, n: int) -> list[Column]:
    """First ``n`` parts of ``a.b.c``; missing parts are null."""
    parts = F.split(x, r"\.")
    return [F.get(parts, i) for i in range(n)]


def question_key(session: Column, question: Column) -> Column:
    """``<session>_q<n>``; null if either side is, unlike ``concat_ws``."""
    return F.concat(session.cast("string"), F.lit("_q"), question.cast("string"))


def at_threshold(p: Column, threshold, strict: bool = False) -> Column:
    return (p > threshold if strict else p >= threshold).cast("int")


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def encoded(position: Column, is_null_token: Column, size: Column) -> Column:
    """Ids 1..n for vocabulary values, n+1 for the null token, null for unseen values; 0 is left for padding."""
    return F.when(is_null_token, size + 1).otherwise(position + 1)
