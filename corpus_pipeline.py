"""From raw documents to packed sequences: quality rules, near duplicates, secrets, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtrace.llm import mixing, near_dup, packing, quality, secret_scan
from playtrace.llm.common import stored
from playtrace.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some rule rejects go. Null and empty texts have no words and are rejected; repeated rows share a verdict."""
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays. Of repeated rows one stays; each distinct text without words is a class of its own,
    null as the empty text."""
    return near_dup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay, null and empty texts as they are, repeated rows each with the same text."""
    return secret_scan.mask_secrets(docs, vocabulary=vocabulary())


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it. Null and empty texts have no size and follow their source's rate; rows that
    repeat id, source and text are drawn one after another; a null source is a source."""
    return mixing.mixture(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place. A null or empty text is its end token; repeated rows are packed
    each; without documents there is no row."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scan", secrets),
    ("source_mix", source_mix), ("best_fit_pack", packed),
]

#: Sampling, near duplicates and tokens cannot be said in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
