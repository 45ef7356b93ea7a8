"""Fitted tree ensembles as tables, cut to some of their trees, and evaluated round by round.

Spark ML stores an ensemble as one row per node; that table answers which features a tree splits
on, what its leaves say, and how many rows stand behind them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import (
    DecisionTreeClassificationModel, GBTClassificationModel)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnspark.session import shared_folder


def _array(kind, values: Sequence):
    gateway = SparkContext._active_spark_context._gateway
    out = gateway.new_array(kind(gateway.jvm), len(values))
    for i, v in enumerate(values):
        out[i] = v
    return out


def _wrapped(java, made, wrapper, **changed):
    """The wrapped new model, with the parameters of the one it came from but for ``changed``."""
    empty = SparkContext._active_spark_context._jvm.org.apache.spark.ml.param.ParamMap.empty()
    java.copyValues(made, empty)
    for name, value in changed.items():
        made.set(name, value)
    model = wrapper(made)
    model._transfer_params_from_java()
    return model


def some_trees(model: GBTClassificationModel, keep: Sequence[int]) -> GBTClassificationModel:
    """A boosted model of the trees at these places, with their weights."""
    java = model._java_obj
    trees, weights = java.trees(), java.treeWeights()
    jvm = SparkContext._active_spark_context._jvm
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{java.uid()}-{uuid4().hex[:8]}",
        _array(lambda j: j.org.apache.spark.ml.regression.DecisionTreeRegressionModel,
               [trees[i] for i in keep]),
        _array(lambda j: j.double, [float(weights[i]) for i in keep]), java.numFeatures(), 2)
    return _wrapped(java, made, GBTClassificationModel)


def node_table(spark: SparkSession, model) -> DataFrame:
    """tree, id, prediction, stats, raw_count, left, right, feature, threshold, categories: one
    row per node.

    ``stats`` are the weighted class totals of a classification tree; ``left``, ``right`` and
    ``feature`` are -1 in leaves, ``categories`` is -1 where a split is a threshold. Node numbers ascend as the tree is walked left first. The table is written by the
    model itself to the shared folder, so its size is not bounded by the driver.
    """
    path = f"{shared_folder(spark)}/churnspark/{spark.sparkContext.applicationId}/nodes-{uuid4().hex}"
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    if "treeID" not in rows.columns:  # a single tree is stored without the number
        rows = rows.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    node = F.col("nodeData")
    return rows.select(
        F.col("treeID").alias("tree"), node["id"].alias("id"),
        node["prediction"].alias("prediction"), node["impurityStats"].alias("stats"),
        node["rawCount"].alias("raw_count"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["split"]["numCategories"].alias("categories"))


def leaf_table(nodes: DataFrame) -> DataFrame:
    """tree, leaf, prediction, stats, raw_count; ``leaf`` is the number that ``leafCol`` gives."""
    order = Window.partitionBy("tree").orderBy("id")  # the leaves of one tree
    return nodes.where("left < 0").select(
        "tree", (F.row_number().over(order) - 1).alias("leaf"), "prediction", "stats", "raw_count")


def feature_trees(nodes: DataFrame) -> dict[int, list[int]]:
    """Inverted index: places of the trees that split on each feature. One row per feature used."""
    found = (nodes.where("left >= 0").groupBy("feature")
             .agg(F.sort_array(F.collect_set("tree")).alias("trees")).collect())
    return {r.feature: list(r.trees) for r in found}


def leaves(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``leaves``, the number of the leaf that a row reaches in each tree."""
    routing = model.copy()
    routing.setLeafCol("_leaf")
    one = isinstance(model, DecisionTreeClassificationModel)  # has a number, not a vector
    found = F.array("_leaf") if one else vector_to_array("_leaf")
    return routing.transform(df).select(*keep, found.alias("leaves"))


def leaf_values(spark: SparkSession, model: GBTClassificationModel) -> np.ndarray:
    """Weighted prediction of leaf j in round i, as one small matrix (rounds x leaves of a tree)."""
    weights = model.treeWeights
    rows = leaf_table(node_table(spark, model)).select(
        "tree", "leaf", "prediction").collect()  # rounds x 2^depth at most
    out = np.zeros((len(weights), 1 + max(r.leaf for r in rows)))
    for r in rows:
        out[r.tree, r.leaf] = r.prediction * weights[r.tree]
    return out


class BlockTrees:
    """A boosted model's nodes as arrays, to walk all trees for a block of rows. Leaves lead to
    themselves, so a walk of ``depth`` steps ends in one."""

    def __init__(self, rows: Sequence, weights: Sequence[float]):
        place = {(r.tree, r.id): i for i, r in enumerate(rows)}
        inner = [r.left >= 0 for r in rows]
        self.feature = np.array([r.feature if i else 0 for r, i in zip(rows, inner)], np.int32)
        self.threshold = np.array([r.threshold if i else 0.0 for r, i in zip(rows, inner)])
        self.left, self.right = (np.array(
            [place[r.tree, child] if i else n
             for n, (r, i, child) in enumerate(zip(rows, inner, children))], np.int32)
            for children in ([r.left for r in rows], [r.right for r in rows]))
        self.value = np.array([r.prediction * weights[r.tree] for r in rows])
        self.roots = np.array([place[tree, 0] for tree in range(len(weights))], np.int32)
        self.depth, at = 0, self.roots
        while len(at := at[self.left[at] != at]):
            self.depth, at = self.depth + 1, np.concatenate([self.left[at], self.right[at]])

    def values(self, x: np.ndarray, keep: Sequence[int] | None = None) -> np.ndarray:
        """Weighted prediction of each kept tree (all by default) for each row."""
        roots = self.roots if keep is None else self.roots[list(keep)]
        flat, starts = x.ravel(), (np.arange(len(x)) * x.shape[1])[:, None]
        at = np.broadcast_to(roots, (len(x), len(roots)))
        for _ in range(self.depth):
            here = flat[starts + self.feature[at]]
            at = np.where(here <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at]


def block_trees(nodes: DataFrame, weights: Sequence[float]) -> BlockTrees:
    """The nodes of a boosted model (rounds x 2^(depth + 1) at most) on the driver."""
    return BlockTrees(nodes.select("tree", "id", "prediction", "left", "right", "feature",
                                   "threshold").collect(), weights)


def slices(batches, rows: int = 1000):
    """The batches in blocks of ``rows``, as a block of all trees is that many times wider."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, width)


def staged_losses(model: GBTClassificationModel, df: DataFrame, label: str,
                  weight: str) -> list[float] | None:
    """Weighted mean loss after 0, 1, 2 ... rounds, in one pass; None without rows.

    A row reaches one leaf per round; running sums of the leaves' values are its margins after each
    round. Tasks send one row of sums.
    """
    values = leaf_values(df.sparkSession, model)
    rounds = len(values)

    def run(batches):
        total, weights = np.zeros(rounds + 1), 0.0
        for batch in batches:
            reached = _matrix(batch.column(0), rounds)
            sign = 2.0 * batch.column(1).to_numpy() - 1.0
            own = batch.column(2).to_numpy()
            margins = np.zeros((len(sign), rounds + 1))
            np.cumsum(values[np.arange(rounds), reached], axis=1, out=margins[:, 1:])
            total += own @ (2.0 * np.logaddexp(0.0, -2.0 * sign[:, None] * margins))
            weights += own.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rounds + 1), pa.int32()), pa.array(total),
             pa.array(np.full(rounds + 1, weights))], ["round", "loss", "weight"])

    rows = (leaves(model, df, [F.col(label).cast("double").alias("y"),
                               F.col(weight).cast("double").alias("w")])
            .select("leaves", "y", "w").mapInArrow(run, "round int, loss double, weight double")
            .groupBy("round").agg(F.sum("loss").alias("loss"), F.sum("weight").alias("weight"))
            .orderBy("round").collect())
    return [r.loss / r.weight for r in rows] if rows and rows[0].weight > 0 else None


def stop_round(losses: Sequence[float], patience: int, tolerance: float) -> int | None:
    """First round with ``patience`` rounds in a row that gain no more than ``tolerance`` on the
    loss before them; None if there is none."""
    for at in range(patience, len(losses)):
        before = losses[at - patience] - tolerance
        if all(loss >= before for loss in losses[at - patience + 1:at + 1]):
            return at
    return None


def expected_rounds(losses: Sequence[float], patience: int, tolerance: float) -> float:
    """Rounds until ``patience`` rounds gain no more than ``tolerance``, if the gains go on to
    shrink as in the last rounds; ``inf`` if they do not shrink, 0 if too few are known."""
    last = len(losses) - 1
    if last < 2 * patience:
        return 0
    before, gain = (losses[at - patience] - losses[at] for at in (last - patience, last))
    if gain <= tolerance:
        return last
    if before <= gain:
        return math.inf
    return last + patience * math.log(gain / tolerance) / math.log(before / gain)


# ---- bootstraps ---------------------------------------------------------------------------

#: Distribution of a Poisson variable of mean 1: chances of at most 0, 1, 2 ... draws.
POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float))
                     for k in range(13)]).tolist()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows that many trees will read, dealt to all cores if they lie in fewer partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(4 * cores, key)
