"""Fitted classifiers as rows of one table, and the scoring of any number of them in one pass over the vectors.

The table has a row for each node of each tree, and for each coefficient of a linear model, under the names of the features. A
pass reads a batch of vectors as a matrix of the features that some model asks for, and moves all rows down all trees at once: the
plan is one scan and one Arrow stage whatever the number of models.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrace.operators.sparse import Places
from playtrace.plans.skew import bounded_broadcast
from playtrace.schema import SESSION
from playtrace.sources.storage import shared_root

BOOSTED, FOREST, LINEAR = "boosted", "forest", "linear"

#: ``low`` is the node for values up to ``split``, ``high`` for larger ones; a leaf has neither and a ``value``. Linear models
#: have a node for each coefficient that is not 0, and one without feature for the intercept.
_INT, _DOUBLE, _STRING = T.IntegerType(), T.DoubleType(), T.StringType()
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("level", _INT), ("fold", _INT), ("model", _STRING), ("kind", _STRING), ("tree", _INT), ("weight", _DOUBLE), ("node", _INT),
    ("feature", _STRING), ("split", _DOUBLE), ("low", _INT), ("high", _INT), ("value", _DOUBLE))])

#: Nodes that one pass holds at most (some 50 bytes each); models beyond it are scored in further passes.
MOST_NODES = 4_000_000
#: Cells of the matrix of rows by features, or of rows by trees, that are held at once.
CELLS = 1 << 21

_SPLIT = re.compile(r"(\s*)If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"\s*Predict: (\S+)")
_TREE = re.compile(r"\s*Tree \d+ \(weight (\S+)\):")


@dataclass(frozen=True)
class Boosted:
    """Boosted trees that were fitted in one task: columns ``tree, weight, node, feature, split, low, high, value`` of their nodes with NaN
    for what a node has not, the gain of each feature, and how many trees were fitted."""

    columns: list[np.ndarray]
    width: int
    gain: dict[int, float]
    fitted: int

    @property
    def nodes(self) -> list[tuple]:
        """The nodes as rows of a model table."""
        whole = (0, 2, 3, 5, 6)
        return [tuple(None if x != x else int(x) if i in whole else float(x) for i, x in enumerate(row)) for row in zip(*self.columns)]

    @property
    def featureImportances(self) -> SparseVector:
        """The share of each feature in the gain of all splits."""
        total = sum(self.gain.values())
        return SparseVector(self.width, {k: v / total for k, v in self.gain.items()})


def _boosted(model: GBTClassificationModel) -> Iterator[tuple]:
    """``tree, weight, node, feature, split, low, high, value`` from the model's description: nodes in preorder."""
    tree, weight, node = -1, 1.0, 0
    rows: list[list] = []
    waiting: list[int] = []  # splits whose second branch is still to come

    def flush() -> Iterator[tuple]:
        yield from (tuple(r) for r in rows)

    for line in model.toDebugString.splitlines()[1:]:
        if found := _TREE.match(line):
            yield from flush()
            rows, waiting, node = [], [], 0
            tree, weight = tree + 1, float(found[1])
        elif found := _SPLIT.match(line):
            rows.append([tree, weight, node, int(found[2]), float(found[3]), node + 1, None, None])
            waiting.append(node)
            node += 1
        elif found := _LEAF.match(line):
            rows.append([tree, weight, node, None, None, None, None, float(found[1])])
            node += 1
        elif line.strip().startswith("Else"):
            rows[waiting.pop()][6] = node
        elif line.strip():
            raise ValueError(f"only splits of continuous features are kept in a model table: {line.strip()}")
    yield from flush()


def _forest(spark: SparkSession, model: RandomForestClassificationModel) -> Iterator[tuple]:
    """The same for a forest, from its stored nodes: a leaf's value is its share of class 1."""
    path = f"{shared_root(spark)}/forest-{model.uid}"
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", node["id"], node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"], node["split"]["numCategories"],
        node["leftChild"], node["rightChild"], node["impurityStats"]).collect()  # the nodes of one model
    for tree, number, feature, threshold, categories, low, high, stats in rows:
        if low < 0:
            yield tree, 1.0, number, None, None, None, None, stats[1] / sum(stats)
        elif categories != -1:
            raise ValueError("only splits of continuous features are kept in a model table")
        else:
            yield tree, 1.0, number, feature, threshold[0], low, high, None


def _nodes(spark: SparkSession, model: PipelineModel) -> tuple[str, Iterator[tuple]]:
    learner = model.stages[-1]
    if isinstance(learner, Boosted):
        return BOOSTED, iter(learner.nodes)
    if isinstance(learner, GBTClassificationModel):
        return BOOSTED, _boosted(learner)
    if isinstance(learner, RandomForestClassificationModel):
        return FOREST, _forest(spark, learner)
    if not isinstance(learner, LogisticRegressionModel):
        raise ValueError(f"no model table for {type(learner).__name__}")
    weights = learner.coefficients.toArray()
    used = np.flatnonzero(weights)
    rows = [(0, 1.0, 0, None, None, None, None, float(learner.intercept))]
    return LINEAR, iter(rows + [(0, 1.0, k, int(i), None, None, None, float(weights[i])) for k, i in enumerate(used, 1)])


def kept_places(model: PipelineModel, n_features: int) -> Sequence[int]:
    """The places of the features that a pipeline's learner sees: those of its slicer, or all."""
    return model.stages[0].getIndices() if len(model.stages) > 1 else range(n_features)


def rows_of(models: dict[tuple[int, int], PipelineModel], name: str, names: Sequence[str], spark: SparkSession) -> list[tuple]:
    """The rows of the models of one name. ``names`` are those of the features by their place in the vectors of the fits."""
    out = []
    for (level, fold), model in models.items():
        kept = kept_places(model, len(names))
        kind, nodes = _nodes(spark, model)
        out += [(level, fold, name, kind, tree, weight, node, None if i is None else names[kept[i]], split, low, high, value)
                for tree, weight, node, i, split, low, high, value in nodes]
    return out


def model_table(models: dict[tuple[int, int], PipelineModel], name: str, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """The table of the models of one name, as ``SCHEMA``."""
    return spark.createDataFrame(rows_of(models, name, names, spark), SCHEMA)


@dataclass(frozen=True)
class Scorer:
    """Models in arrays. Trees are joined end to end; ``roots`` and ``owner`` give each tree's first node and its model."""

    keys: list[tuple[int, int, str]]
    kinds: list[str]
    columns: np.ndarray  # places in the vectors of the features that are asked for
    feature: np.ndarray  # by node: column, -1 for a leaf
    split: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weight: np.ndarray
    owner: np.ndarray
    linear: np.ndarray  # models x columns
    intercept: np.ndarray
    depth: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """``rows x models`` from ``rows x columns``."""
        out = x @ self.linear.T + self.intercept
        if len(self.roots):
            starts = np.flatnonzero(np.concatenate(([True], self.owner[1:] != self.owner[:-1])))
            out[:, self.owner[starts]] += np.add.reduceat(self.leaves(x), starts, axis=1)
        kind = np.array(self.kinds)
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-out * np.where(kind == BOOSTED, 2.0, 1.0)))
        forest = kind == FOREST
        if forest.any():
            trees = np.bincount(self.owner, minlength=len(self.keys))
            p[:, forest] = out[:, forest] / trees[forest]
        return p


    def only(self, ks: Sequence[int]) -> Scorer:
        """Some of the models, over the same columns."""
        ks = list(ks)
        own = np.isin(self.owner, ks)
        to = np.zeros(len(self.keys), np.int64)
        to[ks] = np.arange(len(ks))
        return replace(
            self, keys=[self.keys[k] for k in ks], kinds=[self.kinds[k] for k in ks], roots=self.roots[own], weight=self.weight[own],
            owner=to[self.owner[own]], linear=self.linear[ks], intercept=self.intercept[ks])

    def by_fold(self) -> dict[tuple[int, int], Scorer]:
        """The models of each question and fold."""
        keys: dict[tuple[int, int], list[int]] = {}
        for k, key in enumerate(self.keys):
            keys.setdefault(key[:2], []).append(k)
        return {key: self.only(ks) for key, ks in keys.items()}

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """``rows x trees``: the weighted value of the leaf that each row reaches."""
        out = np.zeros((len(x), len(self.roots)))
        rows = max(1, CELLS // max(len(self.roots), 1))
        for a in range(0, len(x), rows):
            part = x[a:a + rows]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                f = self.feature[at]
                at = np.where(f < 0, at, np.where(part[row, f] <= self.split[at], self.low[at], self.high[at]))
            out[a:a + rows] = self.value[at] * self.weight
        return out


def scorers(table: DataFrame, names: Sequence[str], most: int = MOST_NODES) -> list[Scorer]:
    """The models of a table by level, fold and name, cut where a pass would hold more than ``most`` nodes.

    ``names`` are those of the features by their place in the vectors to be scored. The driver holds one pass's nodes at a time.
    """
    keys = ["level", "fold", "model"]
    sizes = sorted(table.groupBy(*keys).count().collect())  # one row per model
    passes: list[list] = []
    total = 0
    for level, fold, model, n in sizes:
        if not passes or total + n > most:
            passes.append([])
            total = 0
        passes[-1].append((level, fold, model))
        total += n
    out = []
    for own in passes:
        rows = table
        if len(passes) > 1:
            rows = table.join(F.broadcast(table.sparkSession.createDataFrame(own, "level int, fold int, model string")), keys)
        out.append(scorer(rows.toPandas(), names))  # at most ``most`` rows, or one model's
    return out


def scorer_of(models: dict[tuple[int, int], PipelineModel], name: str, n_features: int, spark: SparkSession) -> Scorer:
    """Fitted models, without a table in between."""
    names = Places(n_features)
    return scorer(pd.DataFrame(rows_of(models, name, names, spark), columns=SCHEMA.names), names)


def scorer(rows: pd.DataFrame, names: Sequence[str]) -> Scorer:
    """The models whose rows these are; ``names`` are those of the features by their place in the vectors to be scored."""
    rows = rows.sort_values(["level", "fold", "model", "tree", "node"], kind="stable").reset_index(drop=True)
    asked = list(dict.fromkeys(rows["feature"].dropna()))
    place = names.index if isinstance(names, Places) else {name: i for i, name in enumerate(names)}.__getitem__
    try:
        columns = np.array([place(f) for f in asked], np.int64)
    except (KeyError, ValueError) as missing:
        raise ValueError(f"models ask for a feature that the vectors do not have: {missing}") from None
    column = {f: i for i, f in enumerate(asked)}
    rows["column"] = rows["feature"].map(column).fillna(-1).astype(np.int64)
    keys, kinds, linear, intercept = [], [], [], []
    parts: dict[str, list] = {c: [] for c in ("feature", "split", "low", "high", "value", "roots", "weight", "owner")}
    at = depth = 0
    for k, (key, own) in enumerate(rows.groupby(["level", "fold", "model"], sort=False)):
        keys.append((int(key[0]), int(key[1]), key[2]))
        kinds.append(own["kind"].iloc[0])
        coefficients = np.zeros(len(asked))
        used, value = own["column"].to_numpy(), own["value"].to_numpy(np.float64)
        if kinds[-1] == LINEAR:
            coefficients[used[used >= 0]] = value[used >= 0]
        intercept.append(float(value[used < 0].sum()) if kinds[-1] == LINEAR else 0.0)
        linear.append(coefficients)
        if kinds[-1] == LINEAR:
            continue
        for _, tree in own.groupby("tree", sort=False):
            number = tree["node"].to_numpy()
            to = np.zeros(int(number.max()) + 1, np.int64)
            to[number] = at + np.arange(len(number))
            leaf = tree["column"].to_numpy() < 0
            low, high = (np.where(leaf, 0, tree[c].fillna(0).to_numpy()).astype(np.int64) for c in ("low", "high"))
            parts["feature"].append(tree["column"].to_numpy())
            parts["split"].append(tree["split"].fillna(0.0).to_numpy(np.float64))
            parts["low"].append(to[low])
            parts["high"].append(to[high])
            parts["value"].append(tree["value"].fillna(0.0).to_numpy(np.float64))
            parts["roots"].append([to[0]])
            parts["weight"].append([tree["weight"].iloc[0]])
            parts["owner"].append([k])
            depth = max(depth, _depth(leaf, low, high, number))
            at += len(number)
    joined = {c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in parts.items()}
    return Scorer(
        keys, kinds, columns, **{c: joined[c] for c in ("feature", "split", "low", "high", "value")},
        roots=joined["roots"].astype(np.int64), weight=joined["weight"], owner=joined["owner"].astype(np.int64),
        linear=np.array(linear).reshape(len(keys), len(asked)), intercept=np.array(intercept), depth=depth)


def _depth(leaf: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> int:
    at = {int(n): i for i, n in enumerate(number)}
    deep, open_nodes = 0, [0]
    while open_nodes := [c for i in (at[n] for n in open_nodes) if not leaf[i] for c in (int(low[i]), int(high[i]))]:
        deep += 1
    return deep


def matrix(vectors: pa.Array, columns: np.ndarray) -> np.ndarray:
    """Some columns of an Arrow array of vectors, dense or sparse, as a matrix."""
    dense = np.asarray(vectors.field("type").to_numpy(zero_copy_only=False)) == 1
    values, indices = vectors.field("values"), vectors.field("indices")
    ends = values.offsets.to_numpy()
    flat = values.values.to_numpy()
    out = np.zeros((len(vectors), len(columns)))
    rows = np.flatnonzero(dense)
    if len(rows):
        out[rows] = flat[ends[rows][:, None] + columns[None, :]]
    if len(rows) < len(vectors) and len(columns):
        width = max(int(columns.max()) + 1, 1)
        to = np.full(width, -1)
        to[columns] = np.arange(len(columns))
        places, index_ends = indices.values.to_numpy(), indices.offsets.to_numpy()
        own = np.flatnonzero(~dense)
        counts = (index_ends[1:] - index_ends[:-1])[own]
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)  # of a row's entries
        place, value = places[np.repeat(index_ends[own], counts) + nth], flat[np.repeat(ends[own], counts) + nth]
        at = np.where(place < width, to[np.minimum(place, width - 1)], -1)
        out[np.repeat(own, counts)[at >= 0], at[at >= 0]] = value[at >= 0]
    return out


def slices(batch: pa.RecordBatch, columns: np.ndarray, cells: int | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose matrix has at most ``cells`` (``CELLS``) cells: a task's memory follows neither the rows of a batch
    nor the features that models ask for."""
    rows = max(1, (cells or CELLS) // max(len(columns), 1))
    return (batch.slice(a, rows) for a in range(0, batch.num_rows, rows))


def score_models(vectors: DataFrame, passes: Sequence[Scorer], keep: Sequence[str] = ()) -> DataFrame:
    """Each row of ``vectors`` (``session_id, features``) under each model: ``session, level, fold, model, p``.

    With ``keep``, columns of ``vectors`` that ride along. ``p`` is the probability of class 1 as the model itself gives it. The
    features may be vectors, dense or sparse, or the structs that they are stored as.
    """
    spark = vectors.sparkSession
    kept = [T.StructField("session", vectors.schema[SESSION].dataType), *[vectors.schema[c] for c in keep]]
    lists = [("level", T.IntegerType()), ("fold", T.IntegerType()), ("model", T.StringType()), ("p", T.DoubleType())]
    schema = T.StructType([*kept, *[T.StructField(c, T.ArrayType(t)) for c, t in lists]])
    out = None
    for each in passes:
        shared = spark.sparkContext.broadcast(each)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            level, fold, model = (np.array(x) for x in zip(*own.keys))
            for batch in (piece for whole in batches for piece in slices(whole, own.columns)):
                n = batch.num_rows
                p = own.probabilities(matrix(batch.column(batch.num_columns - 1), own.columns))
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(own.keys))
                values = [pa.array(np.tile(x.astype(np.int32), n)) for x in (level, fold)]
                values += [pa.array(np.tile(model.astype(object), n), pa.string()), pa.array(p.ravel())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *[pa.ListArray.from_arrays(ends, x) for x in values]], names=schema.names)

        packed = vectors.select(F.col(SESSION).alias("session"), *keep, "features").mapInArrow(run, schema)
        part = packed.select("session", *keep, F.inline(F.arrays_zip(*[c for c, _ in lists])))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], T.StructType([*kept, *[T.StructField(c, t) for c, t in lists]])) if out is None else out


def _each_fold(batch: pa.RecordBatch, models: dict[tuple[int, int], Scorer]) -> Iterator[tuple[np.ndarray, Scorer]]:
    """The rows of a batch (``session, level, fold, ...``) by question and fold, with the models of each."""
    level, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
    for key in sorted({(int(a), int(b)) for a, b in zip(level, fold)} & models.keys()):
        yield np.flatnonzero((level == key[0]) & (fold == key[1])), models[key]


def oof_scores(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """Each row of ``rows`` (``session, level, fold, correct, features``) under the models of its own question and fold:
    ``session, level, fold, model, y, p``. Rows without such a model are left out.

    Rows may also be those of sessions, with lists of their ``levels`` and of ``correct``: then a vector is read once for all of them."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    lists = "levels" in rows.columns
    own = rows.select("session", "levels" if lists else "level", "fold", "correct", "features")
    session, level, fold, correct, _ = own.schema.fields
    if lists:
        level, correct = T.StructField("level", level.dataType.elementType), T.StructField("correct", correct.dataType.elementType)
    schema = T.StructType([
        session, level, fold, T.StructField("model", T.StringType()), T.StructField("y", correct.dataType), T.StructField("p", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, models = shared.value.columns, shared.value.by_fold()
        for batch in (piece for whole in batches for piece in slices(whole, columns)):
            x, vector = matrix(batch.column(4), columns), np.arange(batch.num_rows)
            if lists:
                vector = np.repeat(vector, np.diff(batch.column(1).offsets.to_numpy()))
                batch = pa.RecordBatch.from_arrays(
                    [batch.column(0).take(vector), batch.column(1).flatten(), batch.column(2).take(vector), batch.column(3).flatten()],
                    names=["session", "level", "fold", "correct"])
            for at, some in _each_fold(batch, models):
                p = some.probabilities(x[vector[at]])
                row = pa.array(np.repeat(at, p.shape[1]))
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).take(row) for c in range(3)],
                    pa.array([key[2] for key in some.keys] * len(at), pa.string()), batch.column(3).take(row), pa.array(p.ravel())],
                    names=schema.names)

    return own.mapInArrow(run, schema)


def staged_losses(rows: DataFrame, scorer: Scorer, eps: float = 1e-15) -> DataFrame:
    """``level, fold, model, trees, n, log_loss``: of every prefix of each boosted model, over the rows of its question and fold.

    One pass: each batch adds up the leaves' values tree after tree, and hands on a sum for each prefix.
    """
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    own = rows.select("session", "level", "fold", "correct", "features")
    schema = T.StructType.fromDDL("level int, fold int, model string, trees int, n long, loss double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, models = shared.value.columns, shared.value.by_fold()
        for batch in (piece for whole in batches for piece in slices(whole, columns)):
            x, y = matrix(batch.column(4), columns), batch.column(3).to_numpy(zero_copy_only=False)
            found = []
            for at, some in _each_fold(batch, models):
                values = some.leaves(x[at])
                for k, (level, fold, name) in enumerate(some.keys):
                    raw = np.cumsum(values[:, some.owner == k], axis=1)
                    with np.errstate(over="ignore"):
                        p = np.clip(1 / (1 + np.exp(-2 * raw)), eps, 1 - eps)
                    truth = y[at][:, None]
                    losses = -(truth * np.log(p) + (1 - truth) * np.log(1 - p)).sum(axis=0)
                    found += [(level, fold, name, t, len(at), float(loss)) for t, loss in enumerate(losses, 1)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f) for c, f in zip(zip(*found), (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.float64()))],
                    names=schema.names)

    sums = own.mapInArrow(run, schema).groupBy("level", "fold", "model", "trees").agg(F.sum("n").alias("n"), F.sum("loss").alias("_loss"))
    return sums.select("level", "fold", "model", "trees", "n", (F.col("_loss") / F.col("n")).alias("log_loss"))


def best_prefix(staged: DataFrame, patience: int | None = None) -> DataFrame:
    """``level, fold, model, trees, log_loss``: the first prefix of least loss; with ``patience``, of those before the first run of so
    many trees that bring nothing better."""
    keys = ["level", "fold", "model"]
    if patience is not None:
        so_far = Window.partitionBy(*keys).orderBy("trees").rowsBetween(Window.unboundedPreceding, 0)
        run = staged.withColumn("_best", F.min(F.struct("log_loss", "trees")).over(so_far))
        stale = F.when(F.col("trees") - F.col("_best.trees") >= patience, F.col("trees"))
        stop = F.min(stale).over(Window.partitionBy(*keys))  # one row for each tree of a model
        staged = run.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("trees") <= F.col("_stop")))
    best = staged.groupBy(*keys).agg(F.min(F.struct("log_loss", "trees")).alias("_best"))
    return best.select(*keys, F.col("_best.trees").alias("trees"), F.col("_best.log_loss").alias("log_loss"))


def prefixes(table: DataFrame, best: DataFrame) -> DataFrame:
    """The models of a table without the trees after their best prefix."""
    cut = best.select("level", "fold", "model", F.col("trees").alias("_trees"))
    return table.join(bounded_broadcast(cut), ["level", "fold", "model"]).where(F.col("tree") < F.col("_trees")).drop("_trees")
