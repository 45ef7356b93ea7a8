"""Permutation importance: loss of ROC-AUC when one feature is shuffled.

Rows get a position in a seeded hash order. For each repeat every row meets one
donor row, a fixed distance away in that order; one join per repeat serves all
features, since a feature only swaps in the donor's value of itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_order
from churnspark.operators import trees
from churnspark.operators.certificates import vector_names
from churnspark.operators.evaluation import ranked_scores, ranking_metric_columns
from churnspark.operators.models import score
from churnspark.operators.scale import ROWS_PER_BUCKET, prefix_sum
from churnspark.session import cut_lineage


def _distance(seed: int, repeat: int, n: int) -> int:
    digest = hashlib.md5(f"{seed}:{repeat}".encode()).hexdigest()
    return 1 + int(digest[:12], 16) % max(n - 1, 1)


def with_position(df: DataFrame, key: str, seed: int = 42,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``_pos`` 0 .. n-1 in seeded hash order and the row count ``_n``."""
    number = F.conv(F.substring(hash_order(seed, key), 1, 12), 16, 10).cast("double")
    ranked = prefix_sum(df.withColumns({"_k": number, "_one": F.lit(1)}), "_k", ["_one"],
                        tie=key, rows_per_bucket=rows_per_bucket)
    return ranked.withColumns({"_pos": F.col("cum__one") - 1, "_n": F.col("total__one")}) \
        .drop("_k", "_one", "cum__one", "total__one")


def permutation_importance(df: DataFrame, features: Sequence[str], label: str, key: str,
                           predict: Callable[[DataFrame, Sequence[str]], DataFrame],
                           repeats: int = 3, seed: int = 42,
                           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(feature, importance_mean, importance_std), most important first.

    ``predict(table, keep)`` returns the ``keep`` columns plus the score ``p``.
    """
    features = list(features)
    placed = cut_lineage(with_position(df.select(key, label, *features), key, seed,
                                       rows_per_bucket))
    copies = placed.select(label, *features, F.lit("").alias("feature"), F.lit(0).alias("repeat"))
    donor = F.struct(*[F.col(f).alias(f"f{i}") for i, f in enumerate(features)])
    for paired in _paired(placed, donor, [label, *features], repeats, seed):
        each = paired.withColumn("feature", F.explode(F.array(*map(F.lit, features))))
        swapped = [F.when(F.col("feature") == f, F.col(f"_d.f{i}")).otherwise(F.col(f)).alias(f)
                   for i, f in enumerate(features)]
        copies = copies.unionByName(each.select(label, *swapped, "feature", "repeat"))
    scored = predict(copies, [label, "feature", "repeat"])
    return _drops(scored, label, features, rows_per_bucket)


def _paired(placed: DataFrame, donor: Column, keep: Sequence[str], repeats: int, seed: int):
    """Per repeat: ``keep``, repeat and ``_d``, which is ``donor`` of the row's donor."""
    n = placed.count()
    for r in range(1, repeats + 1):
        shift = _distance(seed, r, n)
        donors = placed.select(((F.col("_pos") + shift) % F.col("_n")).alias("_pos"),
                               donor.alias("_d"))
        yield placed.join(donors, "_pos").select(*keep, "_d", F.lit(r).alias("repeat"))


def _drops(scored: DataFrame, label: str, features: Sequence[str], rows_per_bucket: int,
           named: Column | None = None) -> DataFrame:
    """Mean and spread of the AUC's drop from (label, feature, repeat, p); repeat 0 is the base.
    Features without rows have drop 0. ``named`` gives the name of a ``feature`` that is a number."""
    aucs = ranked_scores(scored, "p", label, ["feature", "repeat"], rows_per_bucket) \
        .groupBy("feature", "repeat").agg(ranking_metric_columns()["roc_auc"].alias("auc"))
    if named is not None:
        aucs = aucs.withColumn("feature", named)
    aucs = cut_lineage(aucs)  # one row per (feature, repeat)
    base = aucs.where("repeat = 0").select("auc").scalar()
    drop = base - F.col("auc")
    found = aucs.where("repeat > 0").groupBy("feature").agg(
        F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
    names = scored.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return (names.join(found, "feature", "left").na.fill(0.0, ["importance_mean", "importance_std"])
            .orderBy(F.desc("importance_mean"), "feature"))


def boosted_importance(df: DataFrame, features: Sequence[str], label: str, key: str,
                       model: PipelineModel, repeats: int = 3, seed: int = 42,
                       rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``permutation_importance`` of a boosted model without scoring it anew for every feature.

    Each row becomes its feature vector once; a swapped feature is a swap of its places there (its
    value and the flag of its gaps). An index tells which trees split on a feature. Only those are
    evaluated again, by blocks of rows and only where the donor's value differs; the values of the
    others are kept. A feature that no tree uses has drop 0, and its rows are not multiplied.
    Margins are compared to twelve digits, so that sums in another order do not part equal scores.
    """
    features = list(features)
    at = next(i for i, s in enumerate(model.stages) if isinstance(s, GBTClassificationModel))
    before, boosted = PipelineModel(stages=list(model.stages[:at])), model.stages[at]
    names = vector_names(model)
    nodes = trees.node_table(df.sparkSession, boosted)
    if not nodes.where("categories >= 0").isEmpty():  # blocks know thresholds only
        return permutation_importance(df, features, label, key,
                                      lambda t, keep: score(model, t, keep), repeats, seed,
                                      rows_per_bucket)
    uses: dict[str, set[int]] = {}
    for place, found in trees.feature_trees(nodes).items():
        name = names[place]
        owner = name if name in features else name.removeprefix("missing_")
        uses.setdefault(owner, set()).update(found)
    # number, places in the vector and trees of each feature that is used
    swaps = [(features.index(f), [i for i, n in enumerate(names) if n in (f, f"missing_{f}")],
              sorted(found)) for f, found in uses.items()]
    block = trees.block_trees(nodes, boosted.treeWeights)
    schema = "y double, feature int, repeat int, margin double"

    def rows_of(y, feature: int, repeat, margin) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(y), pa.array(np.full(len(y), feature, np.int32)),
             pa.array(np.broadcast_to(np.asarray(repeat, np.int32), len(y))), pa.array(margin)],
            ["y", "feature", "repeat", "margin"])

    def base(batches):
        for part in trees.slices(batches):
            values = block.values(trees.matrix(part.column("_x")))
            yield rows_of(part.column("y").to_numpy(), -1, 0, values.sum(axis=1))

    def swapped(batches):
        for part in trees.slices(batches):
            own, donor = trees.matrix(part.column("_x")), trees.matrix(part.column("_d"))
            y, repeat = part.column("y").to_numpy(), part.column("repeat").to_numpy()
            values = block.values(own)
            whole = values.sum(axis=1)
            for feature, places, found in swaps:
                margin = whole.copy()
                differs = np.flatnonzero((own[:, places] != donor[:, places]).any(axis=1))
                if len(differs):
                    changed = own[differs]
                    changed[:, places] = donor[np.ix_(differs, places)]
                    margin[differs] += block.values(changed, found).sum(axis=1) \
                        - values[np.ix_(differs, found)].sum(axis=1)
                yield rows_of(y, feature, repeat, margin)

    placed = cut_lineage(with_position(df.select(key, label, *features), key, seed,
                                       rows_per_bucket))
    based = cut_lineage(trees.spread(before.transform(placed), key).select(
        F.col(label).cast("double").alias("y"), "_pos", "_n",
        vector_to_array("features").alias("_x")))
    out = based.select("y", "_x").mapInArrow(base, schema)
    if swaps:
        pairs = reduce(DataFrame.unionByName, _paired(based, F.col("_x"), ["y", "_x"], repeats,
                                                      seed))
        out = out.unionByName(pairs.mapInArrow(swapped, schema))
    p = 1 / (1 + F.exp(-2 * F.round("margin", 12)))
    named = F.coalesce(F.get(F.array(*map(F.lit, features)), F.col("feature")), F.lit(""))
    return _drops(out.select("y", "feature", "repeat", p.alias("p")), "y", features,
                  rows_per_bucket, named)


def model_importance(df: DataFrame, features: Sequence[str], label: str, key: str,
                     model: PipelineModel, repeats: int = 3) -> DataFrame:
    """Importance for a fitted chain, through its trees where it is a boosted one."""
    if any(isinstance(s, GBTClassificationModel) for s in model.stages):
        return boosted_importance(df, features, label, key, model, repeats)
    return permutation_importance(df, features, label, key,
                                  lambda t, keep: score(model, t, keep), repeats)
