"""Feature importance tables and the selections made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mean_importance(gains: DataFrame) -> DataFrame:
    """Mean gain over folds per level and feature; features no model used are absent."""
    return gains.groupBy("level", "feature").agg(F.avg("gain").alias("gain"))


def top_half(importance: DataFrame, share: float = 0.5, keep: str = "top") -> DataFrame:
    """Per level the share of features with the largest mean gain (``keep="bottom"``: the others)."""
    order = Window.partitionBy("level").orderBy(F.desc("gain"), F.asc("feature"))
    size = F.count(F.lit(1)).over(Window.partitionBy("level"))
    ranked = importance.withColumns({"rank": F.row_number().over(order), "_n": size})
    in_top = F.col("rank") <= F.floor(F.col("_n") * share)
    return ranked.where(in_top if keep == "top" else ~in_top).drop("_n")
