"""Score evaluation. Every metric is one aggregation over the scores, whatever the number of thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrace.functions.columns import at_threshold
from playtrace.plans.skew import CHECK, with_running_sum

GRID_SIZE = 100
#: The grid's step; ``i * STEP`` gives the same doubles as an evenly spaced grid from 0 to 1.
STEP = 1.0 / (GRID_SIZE - 1)


def macro_f1_from_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Mean F1 over the classes present in truth or prediction."""
    pos, neg = 2 * tp + fp + fn, 2 * tn + fp + fn
    f1_pos = F.when(pos > 0, 2 * tp / pos).otherwise(0.0)
    f1_neg = F.when(neg > 0, 2 * tn / neg).otherwise(0.0)
    return (f1_pos + f1_neg) / ((pos > 0).cast("int") + (neg > 0).cast("int"))


def macro_f1(
    scores: DataFrame, threshold: float, by: Sequence[str] = (), y: str = "y", p: str = "p", strict: bool = False,
) -> DataFrame:
    hit = at_threshold(F.col(p), threshold, strict)
    truth = F.col(y)
    cells = [
        F.sum(hit * truth).alias("tp"), F.sum(hit * (1 - truth)).alias("fp"),
        F.sum((1 - hit) * truth).alias("fn"), F.sum((1 - hit) * (1 - truth)).alias("tn")]
    counts = scores.groupBy(*by).agg(*cells)
    return counts.withColumn("macro_f1", macro_f1_from_counts(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def thresholds_passed(p: Column, strict: bool = False) -> Column:
    """How many thresholds of the grid a score reaches: a guess by division, put right by comparing with the
    neighbouring grid values."""
    reached = (lambda t: p > t) if strict else (lambda t: p >= t)
    guess = F.least(F.greatest(F.floor(p / STEP), F.lit(-1)), F.lit(GRID_SIZE - 1))
    return (F.when((guess < GRID_SIZE - 1) & reached((guess + 1) * F.lit(STEP)), guess + 2)
            .when((guess >= 0) & ~reached(guess * F.lit(STEP)), guess)
            .otherwise(guess + 1).cast("int"))


def threshold_sweep(
    scores: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p", strict: bool = False,
) -> DataFrame:
    """tp, fp, fn, tn and macro-F1 at each of the 100 thresholds, overall or per group."""
    by = list(by)
    buckets = scores.groupBy(*by, thresholds_passed(F.col(p), strict).alias("b")).agg(
        F.sum(F.col(y)).alias("pos"), F.sum(1 - F.col(y)).alias("neg"))
    # At most 101 buckets per group.
    packed = buckets.groupBy(*by).agg(
        F.collect_list(F.struct("b", "pos", "neg")).alias("_b"),
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    grid = packed.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(GRID_SIZE - 1))))

    def above(field: str) -> Column:
        passed = F.filter("_b", lambda x: x["b"] > F.col("i"))
        return F.aggregate(passed, F.lit(0).cast("long"), lambda s, x: s + x[field])

    tp, fp = above("pos"), above("neg")
    cells = grid.select(
        *by, "i", (F.col("i") * F.lit(STEP)).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
        (F.col("_pos") - tp).alias("fn"), (F.col("_neg") - fp).alias("tn"))
    return cells.withColumn("score", macro_f1_from_counts(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def best_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Best score and the first threshold that has it."""
    best = F.max(F.struct("score", (-F.col("threshold")).alias("neg")))
    return sweep.groupBy(*by).agg(best.alias("_best")).select(
        *by, F.col("_best.score").alias("score"), (-F.col("_best.neg")).alias("threshold"))


def log_loss(scores: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p", eps: float = 1e-15) -> DataFrame:
    q = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    truth = F.col(y)
    return scores.groupBy(*by).agg(F.avg(-(truth * F.log(q) + (1 - truth) * F.log(1 - q))).alias("log_loss"))


def roc_auc(scores: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p", hot=CHECK) -> DataFrame:
    """Exact area under the ROC curve, ties counted half. Equal scores are merged before anything is ordered,
    and many distinct scores in one group are ranked in chunks."""
    by = list(by)
    keys = by or ["_all"]
    rows = scores if by else scores.withColumn("_all", F.lit(0))
    distinct = rows.groupBy(*keys, p).agg(F.sum(F.col(y)).alias("pos"), F.sum(1 - F.col(y)).alias("neg"))
    run = with_running_sum(distinct, keys, [p], F.col("neg"), "_below", total="_negatives", hot=hot)
    wins = F.col("pos") * (F.col("_below") - F.col("neg") + F.col("neg") / 2.0)
    agg = run.groupBy(*keys).agg(
        F.sum(wins).alias("_wins"), F.sum("pos").alias("n_pos"), F.first("_negatives").alias("n_neg"))
    return agg.select(
        *by, "n_pos", "n_neg",
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("_wins") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def blend_mean(predictions: DataFrame, keys: Sequence[str], p: str = "p") -> DataFrame:
    """Mean prediction over fold models or stackers."""
    return predictions.groupBy(*keys).agg(F.avg(p).alias("p"))
