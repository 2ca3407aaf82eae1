"""Readers and writers. All tables are columnar, keyed and partitioned for pruning; nothing is positional."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playtrace.schema import EVENT_SCHEMA, LABEL_SCHEMA, PHASE, SESSION


#: The column that holds the text of a row that does not fit the schema.
REJECTED = "_rejected"


def _csv(spark: SparkSession, path: str, schema: StructType, multiline: bool, mode: str) -> DataFrame:
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    if mode == "REJECTS":
        whole = StructType([*schema.fields, StructField(REJECTED, StringType())])
        return reader.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).csv(path)
    return reader.schema(schema).option("mode", mode).csv(path)


def read_events_csv(
    spark: SparkSession, path: str, limit: int | None = None, multiline: bool = False, mode: str = "FAILFAST",
) -> DataFrame:
    """Event log from CSV with a declared schema (no inference pass), optionally only some rows for debugging.

    Quotes inside quoted fields are doubled. ``multiline`` allows line breaks in them, at the price that a file is no longer
    split among tasks. A row that does not fit the schema is an error; with ``mode="REJECTS"`` it stays, with its text in
    the column ``_rejected``.
    """
    df = _csv(spark, path, EVENT_SCHEMA, multiline, mode)
    return df.limit(limit) if limit is not None else df


def read_labels_csv(spark: SparkSession, path: str, multiline: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Label table from CSV, read as ``read_events_csv`` reads events."""
    return _csv(spark, path, LABEL_SCHEMA, multiline, mode)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV as the readers above expect it: quotes inside fields doubled."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.limit(limit) if limit is not None else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def with_arrival_id(df: DataFrame, name: str = "event_id") -> DataFrame:
    """Give rows without a tie-break column an increasing id at ingest. Write the result before using it: the id
    depends on how the input is split."""
    return df.withColumn(name, F.monotonically_increasing_id())


def write_events(events: DataFrame, path: str) -> None:
    write_table(events, path, [PHASE])


def write_labels_by_phase(labels: DataFrame, path: str) -> None:
    write_table(labels, path, [PHASE])


def write_folds(labels: DataFrame, path: str) -> None:
    """Labels with their ``fold``; training and validation rows are filters on the partition column."""
    write_table(labels, path, ["fold"])


def write_features(features: DataFrame, path: str) -> None:
    write_table(features, path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    write_table(vocab, path, [PHASE] if PHASE in vocab.columns else [])


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int = 16, by: Sequence[str] = (SESSION,),
) -> DataFrame:
    """``df`` as the table ``name`` in the folder ``path``, in sorted buckets of its sessions, read back.

    Tables with the same number of buckets join by session without a shuffle or a sort of either side.
    """
    (df.repartition(buckets, *by).write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name))
    return df.sparkSession.table(name)


def write_catalog(catalog: DataFrame, path: str) -> None:
    write_table(catalog, path, [PHASE])


def write_oof(oof: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Out-of-fold predictions ``session, level, fold, model, y, p``."""
    write_table(oof, path, ["model", "fold"], mode)


def append_scores(scores: DataFrame, path: str) -> None:
    """Metrics table ``scope, level, threshold, score``; level is null for a score over all questions.

    One folder per scope: writing a scope again replaces its rows, and leaves other scopes alone.
    """
    level = F.col("level").cast("int") if "level" in scores.columns else F.lit(None).cast("int")
    scores.select("scope", level.alias("level"), "threshold", "score").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("scope").parquet(path)
