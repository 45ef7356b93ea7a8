"""Grouped aggregations, histograms, correlations and metric reshaping."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.columns import HIGH, LOW, MID, risk_band
from churnspark.operators.scale import rows_from_aggregates

#: Squares about the mean, as a share of the squared mean, that are rounding of a constant.
NO_SPREAD = 1e-26


def rate_by(df: DataFrame, category: str, label: Column) -> DataFrame:
    """Mean of a 0/1 label per category; rows without a category are left out."""
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.count("*").alias("n"), F.round(F.avg(label), 6).alias("churn_rate")))


def rate_in_order(df: DataFrame, category: str, label: Column,
                  levels: Sequence[str]) -> DataFrame:
    """Rate per listed level, in list order; a level without rows has rate NULL."""
    return rows_from_aggregates(df.select(F.col(category).alias("c"), label.alias("y")), "level", {
        level: {"level_order": F.first(F.lit(i)),
                "n": F.count_if(F.col("c") == level),
                "churn_rate": F.round(F.avg(F.when(F.col("c") == level, F.col("y"))), 6)}
        for i, level in enumerate(levels, 1)})


def top_levels(df: DataFrame, category: str, k: int) -> DataFrame:
    """The k most frequent levels (ties by name); k rows."""
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), category).limit(k))


def keep_top_levels(df: DataFrame, category: str, k: int) -> DataFrame:
    # the build side has at most k rows
    return df.join(F.broadcast(top_levels(df, category, k).select(category)), category, "left_semi")


def rate_of_top_levels(df: DataFrame, category: str, label: Column, k: int = 15) -> DataFrame:
    """Rate over the k largest levels, highest rate first.

    Count and rate come from the same aggregate, so one shuffle serves both.
    """
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.count("*").alias("n"), F.round(F.avg(label), 6).alias("churn_rate"))
            .orderBy(F.desc("n"), category).limit(k)
            .orderBy(F.desc("churn_rate"), category))


def risk_band_summary(df: DataFrame, score: str, label: str) -> DataFrame:
    """Size and actual rate per right-closed band, empty bands kept."""
    banded = df.select(risk_band(score).alias("band"), F.col(label).alias("y"))
    return rows_from_aggregates(banded, "risk_band", {
        band: {"band_order": F.first(F.lit(i)),
               "n": F.count_if(F.col("band") == band),
               "churn_rate": F.round(F.avg(F.when(F.col("band") == band, F.col("y"))), 6)}
        for i, band in enumerate((HIGH, MID, LOW), 1)})


def histogram_by_class(df: DataFrame, column: str, label: str, bins: int = 40) -> DataFrame:
    """Equal-width density histogram per class, each over its own value range."""
    present = df.where(F.col(column).isNotNull()).select(
        F.col(column).cast("double").alias("x"), F.col(label).alias("y"))
    flat = F.min("x") == F.max("x")  # a single value gets a range of width 1 around it
    ranges = present.groupBy("y").agg(
        F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("lo"),
        F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("hi"),
        F.count("*").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    # one row per class of a 0/1 label
    counts = (present.join(F.broadcast(ranges), "y").groupBy("y", place.alias("bin"))
              .agg(F.count("*").alias("n")))
    grid = ranges.select("y", "total", "lo", width.alias("width"),
                         F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, ["y", "bin"], "left").select(
        F.col("y").alias("label"), "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
        n.alias("n"), F.round(n / (F.col("total") * F.col("width")), 9).alias("density"))


def score_histogram(df: DataFrame, score: str, label: str, bins: int = 40) -> DataFrame:
    """Counts per class in equal bins over [0, 1]; the last bin includes 1."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    inside = df.where(F.col(score).between(0, 1))
    counts = inside.groupBy(place.alias("bin")).agg(
        F.count_if(F.col(label) == 0).alias("retained"),
        F.count_if(F.col(label) == 1).alias("churned"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", F.coalesce("retained", F.lit(0)).alias("retained"),
        F.coalesce("churned", F.lit(0)).alias("churned"))


def correlation_with_target(df: DataFrame, columns: Sequence[str], label: str,
                            top: int | None = 12) -> DataFrame:
    """Pearson correlation per column (pairwise complete), largest magnitude first."""
    out = rows_from_aggregates(df, "column_name", {
        c: {"correlation": F.round(F.corr(F.col(c).cast("double"), F.col(label).cast("double")), 6)}
        for c in columns}).orderBy(F.desc_nulls_last(F.abs("correlation")), "column_name")
    return out if top is None else out.limit(top)


def _merge(a: tuple, b: tuple) -> tuple:
    """Co-moments of two sets of rows together: n, means, squares and products about the means.

    All members are square matrices: entry (i, j) covers rows where columns i and j have values.
    """
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    gap = b[1] - a[1]  # of the mean of i where j has a value
    both = a[0] * share
    return (n, a[1] + gap * share, a[2] + b[2] + gap ** 2 * both,
            a[3] + b[3] + gap * gap.T * both)


def _co_moments(x: np.ndarray) -> tuple:
    """Co-moments of one block; absent values are NaN."""
    mask = ~np.isnan(x)
    count = np.maximum(mask.sum(axis=0), 1)
    centre = np.where(mask, x, 0.0).sum(axis=0) / count
    y, m = np.where(mask, x - centre, 0.0), mask.astype(float)
    n = m.T @ m
    some = np.maximum(n, 1.0)
    sums = y.T @ m
    return (n, centre[:, None] + sums / some, (y ** 2).T @ m - sums ** 2 / some,
            y.T @ y - sums * sums.T / some)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs in long form, pairwise complete; NaN counts as no value.

    One scan whatever the width: a task keeps masked co-moments of all pairs in four square
    matrices, merges its blocks into them, and sends one row per pair. A column without spread has
    no correlation.
    """
    names = list(columns)
    width = len(names)

    def run(batches):
        total = tuple(np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            if batch.num_rows:
                block = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                total = _merge(total, _co_moments(block.astype(float)))
        i, j = np.triu_indices(width)
        n, mean, square, product = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (i.astype(np.int32), j.astype(np.int32), n[i, j], mean[i, j],
                                   mean[j, i], square[i, j], square[j, i], product[i, j])],
            ["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    parts = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)]) \
        .mapInArrow(run, "i int, j int, n double, x double, y double, xx double, yy double, "
                         "xy double").where("n > 0")
    pair = Window.partitionBy("i", "j")  # a row per task
    rows = parts.withColumns({
        "mx": F.sum(F.col("n") * F.col("x")).over(pair) / F.sum("n").over(pair),
        "my": F.sum(F.col("n") * F.col("y")).over(pair) / F.sum("n").over(pair)})
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    sums = rows.groupBy("i", "j").agg(F.sum(F.col("xx") + F.col("n") * dx * dx).alias("xx"),
                                      F.sum(F.col("yy") + F.col("n") * dy * dy).alias("yy"),
                                      F.sum(F.col("xy") + F.col("n") * dx * dy).alias("xy"),
                                      (F.sum("n") * F.max("mx") * F.max("mx")).alias("x0"),
                                      (F.sum("n") * F.max("my") * F.max("my")).alias("y0"))
    spread = (F.col("xx") > NO_SPREAD * F.col("x0")) & (F.col("yy") > NO_SPREAD * F.col("y0"))
    r = F.when(spread, F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))
    grid = df.sparkSession.createDataFrame(
        [(a, b, min(i, j), max(i, j)) for i, a in enumerate(names) for j, b in enumerate(names)],
        "column_a string, column_b string, i int, j int")
    bounded = F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    found = sums.select("i", "j", F.round(bounded, 6).alias("correlation"))
    return grid.join(found, ["i", "j"], "left").select("column_a", "column_b", "correlation")


def scaling_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population std per column."""
    return rows_from_aggregates(df, "column_name", {
        c: {"mean": F.round(F.avg(c), 6), "std": F.round(F.stddev_pop(c), 6)} for c in columns})


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (2 n_c) and the positive weight n_neg / n_pos."""
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    return rows_from_aggregates(df, "class", {
        0: {"n": neg, "balanced_weight": F.round((neg + pos) / (2 * neg), 6),
            "boost_weight": F.round(F.first(F.lit(1.0)), 6)},
        1: {"n": pos, "balanced_weight": F.round((neg + pos) / (2 * pos), 6),
            "boost_weight": F.round(neg / pos, 6)}})


# ---- metric tables --------------------------------------------------------------

METRICS = ("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1")


def unpivot_metrics(metrics: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    return metrics.unpivot(["feature_set", "model"], list(columns), "metric", "score")


def pivot_metrics(metrics: DataFrame, feature_sets: Sequence[str],
                  columns: Sequence[str] = METRICS) -> DataFrame:
    """One row per model, one column per (metric, feature set).

    Two rows for the same cell raise an error when the query runs.
    """
    cells = []
    for fs in feature_sets:
        here = F.col("feature_set") == fs
        for m in columns:
            cells.append(
                F.when(F.count_if(here) > 1, F.raise_error(F.lit(f"duplicate cell for {fs}")))
                .otherwise(F.max(F.when(here, F.col(m)))).alias(f"{m}_{fs}"))
    return metrics.groupBy("model").agg(*cells)


def retention_gain(pivoted: DataFrame, metric: str = "roc_auc") -> DataFrame:
    gain = F.col(f"{metric}_with_retention") - F.col(f"{metric}_without_retention")
    return pivoted.withColumn(f"{metric}_gain_with_retention", F.round(gain, 6))


def best_models(metrics: DataFrame, by: str = "pr_auc") -> DataFrame:
    """Best model per feature set; equal scores go to the first name."""
    rest = [c for c in metrics.columns if c != "feature_set"]
    best = F.min_by(F.struct(*rest), F.struct((-F.col(by)).alias("s"), F.col("model")))
    return metrics.groupBy("feature_set").agg(best.alias("b")).select("feature_set", "b.*")
