"""Mixing sources to target weights: tokens per source, repetition rates, and a hash-seeded number of copies per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrace.llm.common import n_words, stored

#: Rates up to this many bytes of source names are broadcast; beyond it the join is left to Spark, which splits hot sources.
BROADCAST_BYTES = 32 << 20


def _ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``rank`` from 0 in code-point order of the sources, null last, numbered by sorted partitions."""
    numbered = stored(
        sizes.orderBy(F.asc_nulls_last("source")).withColumn("_id", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("_id", 33)
    starts, total = [], 0
    for p, n in sorted(numbered.groupBy(part.alias("p")).count().collect()):  # one row per partition
        starts += [F.lit(p), F.lit(total)]
        total += n
    first = F.element_at(F.create_map(*starts), part) if starts else F.lit(0)
    return numbered.withColumn("rank", first + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")


def source_rates(
        docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1),
        share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    The sources, in code-point order with null last, weigh ``weights`` in turn and share ``share`` times all words. A
    target stops at ``most`` times its source's words; what lies above is shared again by weight until none is above.
    Sources without a word get target and rate 0. No documents: no rows.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(n_words(text)).alias("source_size"))
    sources = _ranked(sizes)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(float(most)))
    total, weight = sources.agg(F.sum("source_size"), F.sum("w")).first()
    total = (total or 0) * share
    level, stopped = (total / weight if weight else 0.0), -1
    while True:  # each turn stops at least one more source
        above = F.col("w") * F.lit(level) > F.col("most")
        n, taken, rest = sources.agg(
            F.sum(above.cast("long")), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("w")))).first()
        if not n or n == stopped or not rest:
            break
        stopped, level = n, (total - (taken or 0.0)) / rest
    target = F.least(F.col("w") * F.lit(level), F.col("most"))
    return sources.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def _digest(doc_id: Column, source: Column, text: Column) -> Column:
    """MD5 of id, source and text as hexadecimal digits; a null id or text counts as the empty text."""
    return F.md5(F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("="), source), F.lit("")), F.lit(":"),
        F.coalesce(text, F.lit(""))))


def draw(digest: Column, nth: Column, share: Column) -> Column:
    """Whether the ``nth`` (from 0) of equal rows is drawn, at ``share``: a number in [0, 1) from the digest, moved back by the share for
    each row before it, round the unit. Of m equal rows m times the share are drawn, up to one."""
    u = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52)) - nth * share
    return u - F.floor(u) < share


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (``row, _digest``) with ``_nth``, the number from 0 of each among those of one digest.

    Digests that occur once, nearly all, need no more than a count. The others' rows are stored, and numbered in chunks of what a task
    wrote, with one sum per chunk for what stands in earlier ones: no task takes all copies of a row.
    """
    repeated = stored(rows.groupBy("_digest").count().where("count > 1").select("_digest"), "mix-repeated")
    n = repeated.count()
    if not n:
        return rows.withColumn("_nth", F.lit(0).cast("long"))
    side = F.broadcast(repeated) if n * 60 <= BROADCAST_BYTES else repeated
    once = rows.join(side, "_digest", "left_anti").withColumn("_nth", F.lit(0).cast("long"))
    more = stored(rows.join(side, "_digest", "left_semi").withColumn("_at", F.monotonically_increasing_id()), "mix-copies")
    more = more.withColumn("_chunk", F.shiftright("_at", 12))
    before = Window.partitionBy("_digest").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = more.groupBy("_digest", "_chunk").count().select(
        "_digest", "_chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_earlier"))
    own = F.row_number().over(Window.partitionBy("_digest", "_chunk").orderBy("_at")) - 1
    more = more.withColumn("_own", own).join(earlier, ["_digest", "_chunk"])
    return once.unionByName(more.select("row", "_digest", (F.col("_earlier") + F.col("_own")).alias("_nth")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """All rows of ``docs`` as a struct ``row``, with ``size, source_size, target, copies``.

    A row is taken floor(rate) times, and once more if its number from MD5 of id, source and text lies below the rest of the rate, so
    no row is taken more than twice. Rows that repeat all three are drawn one after another, so that together they come as near to the rate as
    they can; reruns agree but for which of them is drawn. A null text has size 0, a null source is a source of its own. Other
    columns ride along untouched, whatever their names.
    """
    rates = source_rates(docs, text, source, **targets)
    size = rates.agg(F.sum(F.octet_length(F.coalesce("source", F.lit(""))) + F.lit(40))).first()[0] or 0
    rates = rates.withColumnRenamed("source", "_source")
    rates = F.broadcast(rates) if size <= BROADCAST_BYTES else rates
    rows = docs.select(F.struct("*").alias("row"), _digest(F.col(doc_id), F.col(source), F.col(text)).alias("_digest"))
    joined = _numbered(rows).join(rates, F.col(f"row.{source}").eqNullSafe(F.col("_source")))
    whole = F.floor("rate")
    return joined.select(
        "row", n_words(F.col(f"row.{text}")).alias("size"), "source_size", "target",
        (whole + draw(F.col("_digest"), F.col("_nth"), F.col("rate") - whole).cast("long")).alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as ``mix`` takes it, with its own columns."""
    return mix(docs, **options).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
