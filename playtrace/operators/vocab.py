"""Vocabularies of the category columns and the integer encoding built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrace.functions.columns import encoded
from playtrace.plans.skew import BROADCAST_KEYS, CHECK, with_row_number
from playtrace.schema import PHASE, VOCAB_COLUMNS, null_token


def melt(df: DataFrame, keep: Sequence[str], columns: Sequence[str], value=None) -> DataFrame:
    """One row per input row and column: ``keep..., column, value``."""
    value = value or (lambda c: F.col(c).cast("string"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.column", "_p.value")


def build_vocab(events: DataFrame, columns: Sequence[str] = VOCAB_COLUMNS, by_phase: bool = True) -> DataFrame:
    """Distinct non-null values with their 0-based position ``pos`` in sorted order, per phase or overall."""
    keys = [PHASE] if by_phase else []
    values = melt(events, keys, columns).where(F.col("value").isNotNull()).distinct()
    keys = [*keys, "column"]
    numbered = with_row_number(values, keys, ["value"], "_rn", hot=CHECK)
    return numbered.select(*keys, "value", (F.col("_rn") - 1).cast("int").alias("pos"))


def encode_columns(
    events: DataFrame, vocab: DataFrame, columns: dict[str, str], unseen_as_null_token: bool = False,
    rows: int = BROADCAST_KEYS,
) -> DataFrame:
    """Add, for each ``column: name``, the id of the column in its phase's vocabulary (see ``encoded``; ids reach
    n+1, so an embedding table needs n+2 rows). The vocabulary is broadcast only up to ``rows`` values, which one
    count settles for all columns."""
    words = vocab.where(F.col("column").isin(list(columns)))
    small = words.limit(rows + 1).count() <= rows
    sizes = words.groupBy(F.col(PHASE).alias("_phase")).agg(
        *[F.count_if(F.col("column") == c).cast("int").alias(f"_size_{c}") for c in columns])
    out = events.join(F.broadcast(sizes) if small else sizes, F.col(PHASE) == F.col("_phase"), "left")
    for c, name in columns.items():
        lookup = words.where(F.col("column") == c).select(
            F.col(PHASE).alias("_of"), F.col("value").alias("_value"), F.col("pos").alias("_pos"))
        text = F.col(c).cast("string")
        out = out.join(
            F.broadcast(lookup) if small else lookup, (F.col(PHASE) == F.col("_of")) & (text == F.col("_value")), "left")
        is_token = text.isNull() | (text == null_token(c))
        if unseen_as_null_token:
            is_token = is_token | F.col("_pos").isNull()
        size = F.coalesce(F.col(f"_size_{c}"), F.lit(0))
        out = out.withColumn(name, encoded(F.col("_pos"), is_token, size)).drop("_of", "_value", "_pos")
    return out.drop("_phase", *[f"_size_{c}" for c in columns])
