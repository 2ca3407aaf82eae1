"""Ridge stacking from moment sums: one aggregation, then one small solve per (level, fold)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrace.functions.arrays import dot
from playtrace.plans.skew import bounded_broadcast


def fold_moments(
    oof: DataFrame, inputs: Sequence[str], by: Sequence[str] = ("level",), fold: str = "fold", y: str = "y",
) -> DataFrame:
    """Per group and fold: n, sums of y and of each input, of input*y and of input*input (upper triangle)."""
    x = [F.col(c).cast("double") for c in inputs]
    target = F.col(y).cast("double")
    k = range(len(inputs))
    return oof.groupBy(*by, fold).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(target).alias("sy"),
        *[F.sum(x[i]).alias(f"s{i}") for i in k],
        *[F.sum(x[i] * target).alias(f"sy{i}") for i in k],
        *[F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in k for j in k if j >= i])


def train_moments(moments: DataFrame, by: Sequence[str] = ("level",), fold: str = "fold") -> DataFrame:
    """Moments of all folds but one: the group's total minus the fold."""
    sums = [c for c in moments.columns if c not in (*by, fold)]
    group = Window.partitionBy(*by)  # one row per fold: the moments are computed once
    return moments.select(*by, fold, *[(F.sum(c).over(group) - F.col(c)).alias(c) for c in sums])


def ridge_coefficients(
    moments: DataFrame, n_inputs: int, by: Sequence[str] = ("level",), fold: str = "fold", alpha: float = 1.0,
) -> DataFrame:
    """``by, fold, intercept, coef`` of the ridge regression on centred inputs, the intercept not penalised."""
    k = n_inputs
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in moments.schema.fields if f.name in (*by, fold))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for m in batches:
            m = m[m["n"] > 0]
            n = m["n"].to_numpy()
            mean_x = m[[f"s{i}" for i in range(k)]].to_numpy() / n[:, None]
            mean_y = m["sy"].to_numpy() / n
            gram = np.empty((len(m), k, k))
            for i, j in upper:
                gram[:, i, j] = gram[:, j, i] = m[f"s{i}_{j}"].to_numpy()
            gram -= n[:, None, None] * mean_x[:, :, None] * mean_x[:, None, :]
            cross = m[[f"sy{i}" for i in range(k)]].to_numpy() - n[:, None] * mean_x * mean_y[:, None]
            coef = np.linalg.solve(gram + alpha * np.eye(k), cross[:, :, None])[:, :, 0]
            out = m[[*by, fold]].copy()
            out["intercept"] = mean_y - (coef * mean_x).sum(axis=1)
            out["coef"] = list(coef)
            yield out

    return moments.mapInPandas(solve, f"{schema}, intercept double, coef array<double>")


def ridge_stack(
    oof: DataFrame, inputs: Sequence[str], by: Sequence[str] = ("level",), fold: str = "fold", y: str = "y",
    alpha: float = 1.0,
) -> DataFrame:
    """Stackers for each group and held-out fold, fitted on the other folds."""
    return ridge_coefficients(train_moments(fold_moments(oof, inputs, by, fold, y), by, fold), len(inputs), by, fold, alpha)


def apply_stack(
    rows: DataFrame, coefs: DataFrame, inputs: Sequence[str], keys: Sequence[str], name: str = "p",
) -> DataFrame:
    """Score rows with the coefficients that match their ``keys``.

    There is one coefficient row per level and fold: they are broadcast after counting, so scores are not shuffled on a
    few keys.
    """
    side = bounded_broadcast(coefs.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "intercept", "coef"))
    on = [rows[k] == F.col(f"_k_{k}") for k in keys]
    features = F.array(*[F.col(c).cast("double") for c in inputs])
    return (rows.join(side, on)
            .withColumn(name, F.col("intercept") + dot(F.col("coef"), features))
            .drop("intercept", "coef", *[f"_k_{k}" for k in keys]))


def ensemble_score(
    predictions: DataFrame, coefs: DataFrame, models: Sequence[str], threshold: float,
    keys: Sequence[str] = ("session", "level"),
) -> DataFrame:
    """From one row per (key, model, fold): mean over folds, stack, mean over the stackers, then threshold."""
    blended = predictions.groupBy(*keys).pivot("model", list(models)).agg(F.avg("p"))  # the mean over the folds
    stacked = apply_stack(blended, coefs, models, ["level"], "_p")
    score = stacked.groupBy(*keys).agg(F.avg("_p").alias("p"))
    return score.withColumn("correct", (F.col("p") >= threshold).cast("int"))
