"""Exact stratified split and exact seeded samples by hash order.

Membership is a comparison of a row's hash with a few cut-off values, so the
tables themselves are never shuffled or sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_order
from churnspark.operators.scale import hash_cutoffs


def allocate(counts: dict, wanted: int) -> dict:
    """Share ``wanted`` rows over strata by largest remainder, ties by label."""
    total = sum(counts.values())
    given = {y: wanted * n // total for y, n in counts.items()}
    spare = wanted - sum(given.values())
    order = sorted(counts, key=lambda y: (-(wanted * counts[y] % total), y))
    for y in order[:spare]:
        given[y] += 1
    return given


def stratified_split(df: DataFrame, key: str, label: Column, seed: int = 42,
                     test_share: float = 0.2, val_share_of_rest: float = 0.25) -> DataFrame:
    """Add ``split`` (test / val / train) with exact sizes per label class.

    ``key`` must be unique. Sizes are ceil(test_share * n) and
    ceil(val_share_of_rest * rest).
    """
    counts = {r.y: r.n for r in df.groupBy(label.alias("y")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    n_test = math.ceil(test_share * total)
    test = allocate(counts, n_test)
    rest = {y: n - test[y] for y, n in counts.items()}
    val = allocate(rest, math.ceil(val_share_of_rest * (total - n_test)))
    hashed = df.withColumns({"_y": label, "_h": hash_order(seed, key)})
    cuts = hash_cutoffs(hashed, "_h", {y: [test[y], test[y] + val[y]] for y in counts}, "_y")
    split = None
    for y, (test_cut, val_cut) in cuts.items():
        here = F.col("_y") == y
        for name, cut in (("test", test_cut), ("val", val_cut)):
            if cut is not None:
                inside = here & (F.col("_h") <= cut)
                split = F.when(inside, name) if split is None else split.when(inside, name)
    split = F.lit("train") if split is None else split.otherwise("train")
    return hashed.withColumn("split", split).drop("_y", "_h")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones for the same seed and keys."""
    hashed = df.withColumn("_h", hash_order(seed, key))
    cut = hash_cutoffs(hashed, "_h", {None: [n]})[None][0]
    return (hashed if cut is None else hashed.where(F.col("_h") <= cut)).drop("_h")
