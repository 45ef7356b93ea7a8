"""Conditions that a fitted model must meet on the rows it was fitted on.

Refitting elsewhere cannot reproduce a model to the last digit; these checks can be repeated with
plain aggregates: the gradient of the penalised loss is zero at the stored coefficients, a leaf says
what the rows routed to it say, a centre is the mean of its cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators import models, trees
from churnspark.operators.forest import (
    ARRAYS, LeafCounts, bins_of, draws_of, over_trees, packed_trees)
from churnspark.operators.preparation import MissingFlagsModel
from churnspark.operators.scale import rows_from_aggregates

INTERCEPT = "(intercept)"
#: Largest difference between a stored and a recomputed figure, as a share of the larger one.
CLOSE = 1e-6


def _assembled(model: PipelineModel, df: DataFrame, learner) -> DataFrame:
    """``df`` with the vector that the fitted ``learner``, a stage of the model, was given."""
    for stage in model.stages[:model.stages.index(learner)]:
        df = stage.transform(df)
    return df


def _learner(model: PipelineModel):
    return next(s for s in reversed(model.stages) if not isinstance(s, models.RoundLosses))


def vector_names(model: PipelineModel) -> list[str]:
    """Names of the places of the assembled vector: feature columns, then flags of gaps."""
    cols = next(s for s in model.stages if isinstance(s, models.Assemble)).getInputCols()
    flags = next((s.getState() for s in model.stages
                  if isinstance(s, MissingFlagsModel)), [])
    return [*cols, *(f"missing_{c}" for c in cols if c in flags)]


def logistic_gradient(model: PipelineModel, train: DataFrame, label: str, weight: str) -> DataFrame:
    """(column_name, coefficient, gradient) of the penalised mean loss, and of the intercept."""
    fit = _learner(model)
    names, x = vector_names(model), vector_to_array("features")
    rows = fit.transform(_assembled(model, train, fit)).select(
        x.alias("x"), F.col(weight).alias("w"),
        (F.col(weight) * (models.probability() - F.col(label))).alias("pull"))
    penalty, mass = fit.getRegParam(), F.sum("w")
    values = {n: float(c) for n, c in zip(names, fit.coefficients.toArray(), strict=True)}
    out = {n: {"coefficient": F.first(F.lit(c)),
               "gradient": F.sum(F.col("pull") * F.get("x", F.lit(i))) / mass + penalty * c}
           for i, (n, c) in enumerate(values.items())}
    out[INTERCEPT] = {"coefficient": F.first(F.lit(float(fit.intercept))),
                      "gradient": F.sum("pull") / mass}
    return rows_from_aggregates(rows, "column_name", out)


def _routed(model, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, tree and leaf: each row once per tree. Only aggregate this table."""
    return trees.leaves(model, rows, keep).select(
        *keep, F.posexplode("leaves").alias("tree", "leaf")).withColumn(
            "leaf", F.col("leaf").cast("int"))


def _compared(seen: DataFrame, stored: DataFrame, least: int) -> DataFrame:
    """tree, and how many leaves say something else than their rows, or have too few of them."""
    both = seen.join(stored, ["tree", "leaf"], "full")
    far = F.lit(False)
    for i in (0, 1):
        a, b = F.coalesce(F.col(f"w{i}"), F.lit(0.0)), F.coalesce(F.get("stats", F.lit(i)), F.lit(0.0))
        far = far | (F.abs(a - b) > CLOSE * F.greatest(a, b, F.lit(1.0)))
    return both.groupBy("tree").agg(
        F.count_if(far).alias("n_bad_leaves"),
        F.count_if(F.coalesce("n_rows", F.lit(0)) < least).alias("n_small_leaves"))


def _leaf_stats(rows: DataFrame, label: str) -> DataFrame:
    y, w = F.col(label), F.col("w")
    return rows.groupBy("tree", "leaf").agg(
        F.sum(F.when(y == 0, w).otherwise(0.0)).alias("w0"),
        F.sum(F.when(y == 1, w).otherwise(0.0)).alias("w1"), F.count("*").alias("n_rows"))


def _per_class(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy("tree", label).agg(
        F.count("*").alias("n_rows"), F.round(F.sum("w"), 4).alias("weight"))


def tree_leaves(model: PipelineModel, train: DataFrame, label: str, weight: str,
                leaf: int) -> DataFrame:
    """tree, label, n_rows, weight, n_bad_leaves, n_small_leaves of a fitted tree.

    Every row is routed by the stored splits; a leaf is bad if its stored class weights are not
    those of the rows that reach it, small if fewer than ``leaf`` rows do.
    """
    fit = _learner(model)
    rows = _routed(fit, _assembled(model, train, fit).withColumn("w", F.col(weight)), [label, "w"])
    checked = _compared(_leaf_stats(rows, label), trees.leaf_table(
        trees.node_table(train.sparkSession, fit)), leaf)
    return _per_class(rows, label).join(checked, "tree")


def forest_leaves(model: PipelineModel, train: DataFrame, label: str, key: str,
                  settings: models.ModelSettings) -> DataFrame:
    """``tree_leaves`` of every tree of a forest, over its own bootstrap and class weights, with
    n_draws. Rows go to the trees in blocks; what is left of them are counts of a tree's leaves."""
    fit = _learner(model)
    s = settings
    packed, bounds, n_trees, n_nodes = packed_trees(train.sparkSession, fit)
    width = len(bounds)
    ready = _assembled(model, train, fit).select(
        F.col(key).cast("string"), F.col(label).cast("int"), vector_to_array("features"))

    def chunk(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, width)
            yield pa.RecordBatch.from_pydict({
                "keys": [batch.column(0).to_pylist()],
                "y": [batch.column(1).to_numpy().astype(np.uint8).tobytes()],
                "x": [bins_of(x, bounds).tobytes()]})

    def count(trees, chunks):
        grown = []
        for c in chunks:
            if not grown:
                grown += [LeafCounts(t) for t in trees]
                trees.clear()
            bins = np.frombuffer(c["x"], np.uint8).reshape(-1, width)
            y, keys = np.frombuffer(c["y"], np.uint8), [k.encode() for k in c["keys"]]
            for tree in grown:
                drawn = draws_of(s.seed, tree.tree, keys)
                mine = np.flatnonzero(drawn)
                tree.add(bins[mine], y[mine], drawn[mine])
        for tree in grown:
            yield pa.RecordBatch.from_pydict(
                {"tree": pa.array([tree.tree], pa.int32()), "rows": [tree.rows.tobytes()],
                 "draws": [tree.draws.tobytes()]})

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        """Rows of each class, and the leaves that say something else or have too few rows."""
        stored, seen = part[part["right"].notna()], part[part["rows"].notna()]
        if seen.empty or stored.empty:
            return pd.DataFrame(columns=["tree", "label", "n_rows", "weight", "n_draws",
                                         "n_bad_leaves", "n_small_leaves"])
        rows, draws = (sum(np.frombuffer(v, np.int64) for v in seen[c]).reshape(-1, 2)
                       for c in ("rows", "draws"))
        leaf = np.frombuffer(stored["right"].iloc[0], ARRAYS["right"]) < 0
        said = np.stack([np.frombuffer(stored[w].iloc[0], ARRAYS[w])[leaf]
                         for w in ("w0", "w1")], axis=1)
        all_draws = draws.sum(axis=0)
        weights = draws * np.divide(all_draws.sum(), 2 * all_draws, out=np.zeros(2),
                                    where=all_draws > 0)
        far = np.abs(weights - said) > CLOSE * np.maximum(np.maximum(weights, said), 1.0)
        classes = np.flatnonzero(rows.sum(axis=0))
        return pd.DataFrame({
            "tree": part["tree"].iloc[0], "label": classes, "n_rows": rows.sum(axis=0)[classes],
            "weight": weights.sum(axis=0)[classes], "n_draws": all_draws[classes],
            "n_bad_leaves": far.any(axis=1).sum(),
            "n_small_leaves": (rows.sum(axis=1) < s.forest_leaf).sum()})

    chunks = ready.mapInArrow(chunk, "keys array<string>, y binary, x binary")
    seen = over_trees(chunks, train.count(), packed.select("tree", "right", "feature", "bin"),
                      n_trees, n_nodes, width, count, "tree int, rows binary, draws binary")
    found = (packed.select("tree", "right", "w0", "w1").unionByName(seen, allowMissingColumns=True)
             .groupBy("tree").applyInPandas(
        compare, "tree int, label int, n_rows long, weight double, n_draws long, "
                 "n_bad_leaves long, n_small_leaves long"))
    return found.select(
        "tree", F.col("label").cast(train.schema[label].dataType).alias(label), "n_rows",
        F.round("weight", 4).alias("weight"), "n_draws", "n_bad_leaves", "n_small_leaves")


def boosted_leaves(model: PipelineModel, rows: DataFrame, label: str, weight: str) -> DataFrame:
    """round, n_rows, weight, n_bad_leaves: a leaf's value is the weighted mean of what its rows
    still lack after the rounds before it (of their sign in the first round)."""
    fit = _learner(model)
    values = trees.leaf_values(rows.sparkSession, fit)
    rounds, width = values.shape

    def run(batches):
        mass, pull = np.zeros((rounds, width)), np.zeros((rounds, width))
        count = np.zeros((rounds, width), dtype=np.int64)
        every = np.arange(rounds)
        for batch in batches:
            reached = batch.column(0).flatten().to_numpy().astype(np.int64).reshape(-1, rounds)
            sign = 2.0 * batch.column(1).to_numpy() - 1.0
            own = batch.column(2).to_numpy()
            margin = np.cumsum(values[every, reached], axis=1)[:, :-1]
            lack = np.empty(reached.shape)
            lack[:, 0] = sign
            lack[:, 1:] = 4.0 * sign[:, None] / (1.0 + np.exp(2.0 * sign[:, None] * margin))
            at = (np.broadcast_to(every, reached.shape), reached)
            np.add.at(mass, at, own[:, None])
            np.add.at(pull, at, own[:, None] * lack)
            np.add.at(count, at, 1)
        r, leaf = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(r, pa.int32()), pa.array(leaf, pa.int32()), pa.array(mass[r, leaf]),
             pa.array(pull[r, leaf]), pa.array(count[r, leaf])],
            ["tree", "leaf", "w", "pull", "n"])

    seen = (trees.leaves(fit, _assembled(model, rows, fit), [
        F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w")])
        .select("leaves", "y", "w")
        .mapInArrow(run, "tree int, leaf int, w double, pull double, n long")
        .groupBy("tree", "leaf").agg(F.sum("w").alias("w"), F.sum("pull").alias("pull"),
                                     F.sum("n").alias("n")))
    stored = trees.leaf_table(trees.node_table(rows.sparkSession, fit))
    far = F.abs(F.col("pull") / F.col("w") - F.col("prediction")) > CLOSE
    return seen.join(stored, ["tree", "leaf"], "full").groupBy(F.col("tree").alias("round")).agg(
        F.sum("n").alias("n_rows"), F.round(F.sum("w"), 4).alias("weight"),
        F.count_if(F.coalesce(far, F.lit(True))).alias("n_bad_leaves"))


def centre_gaps(assigned: DataFrame, columns: Sequence[str],
                centres: Sequence[Sequence[float]]) -> DataFrame:
    """(Cluster, column_name, n_rows, centre, mean): means of the assigned rows beside the centres."""
    found = assigned.groupBy("Cluster").agg(F.count("*").alias("n_rows"),
                                            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)])
    known = assigned.sparkSession.createDataFrame(
        [(k, *map(float, c)) for k, c in enumerate(centres)],
        "Cluster int, " + ", ".join(f"c{i} double" for i in range(len(columns))))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("centre"),
                               F.col(f"m{i}").alias("mean")) for i, c in enumerate(columns)])
    return known.join(found, "Cluster", "left").select(
        "Cluster", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.inline(cells))
