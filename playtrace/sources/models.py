"""Fitted models as rows of one table, or as folders ``model=<name>/fold=<k>/level=<n>``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def model_path(root: str, name: str, level: int, fold: int) -> str:
    return f"{root}/model={name}/fold={fold}/level={level}"


def save_models(models: dict[tuple[int, int], PipelineModel], root: str, name: str) -> None:
    for (level, fold), model in models.items():
        model.write().overwrite().save(model_path(root, name, level, fold))


def load_models(root: str, name: str, keys: Iterable[tuple[int, int]]) -> dict[tuple[int, int], PipelineModel]:
    return {(level, fold): PipelineModel.load(model_path(root, name, level, fold)) for level, fold in keys}


def save_table(models: DataFrame, path: str) -> None:
    """A model table, a folder for each name; writing a name again replaces its models."""
    models.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path)


def load_table(spark: SparkSession, path: str, names: Iterable[str]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("model").isin(list(names)))
