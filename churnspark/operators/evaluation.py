"""Evaluation of scores: confusion, curves, ranking metrics, gains.

Scores are first reduced to one row per distinct value with its counts, so
tied customers never meet in a sort, and running totals over the distinct
values come from :func:`churnspark.operators.scale.prefix_sum`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.operators.scale import (
    ROWS_PER_BUCKET, bucket_offsets, key_buckets, prefix_sum, rows_from_aggregates,
    running_in_buckets)
from churnspark.session import cut_lineage


UNSCORED = "a row has no score; see unscored_rows"


def scored(score: str) -> Column:
    """The score as a double; NULL and NaN stop the job.

    Every function of this module goes through here, so all of them cover the same rows.
    """
    value = F.col(score).cast("double")
    return F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit(UNSCORED)).cast("double")) \
        .otherwise(value)


def unscored_rows(df: DataFrame, score: str) -> DataFrame:
    """One row: rows in all, and rows that no evaluation would accept."""
    value = F.col(score).cast("double")
    return df.agg(F.count("*").alias("n_rows"),
                  F.count_if(value.isNull() | F.isnan(value)).alias("n_unscored"))


def _divide(a: Column, b: Column) -> Column:
    """Quotient with 0 for an empty denominator."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    precision, recall = _divide(tp, tp + fp), _divide(tp, tp + fn)
    return {
        "accuracy": (tp + tn) / (tp + tn + fp + fn),
        "balanced_accuracy": (recall + _divide(tn, tn + fp)) / 2,
        "precision": precision,
        "recall": recall,
        "f1": _divide(2 * tp, 2 * tp + fp + fn),
    }


def confusion(df: DataFrame, prediction: Column, label: str,
              groups: Sequence[str] = ()) -> DataFrame:
    y = F.col(label)
    return df.groupBy(*groups).agg(
        F.count_if((y == 0) & (prediction == 0)).alias("true_negative"),
        F.count_if((y == 0) & (prediction == 1)).alias("false_positive"),
        F.count_if((y == 1) & (prediction == 0)).alias("false_negative"),
        F.count_if((y == 1) & (prediction == 1)).alias("true_positive"))


def class_metrics(counts: DataFrame, digits: int = 6) -> DataFrame:
    """Adds accuracy, balanced accuracy, precision, recall and F1 to confusion counts."""
    cols = class_metric_columns(*[F.col(c) for c in (
        "true_negative", "false_positive", "false_negative", "true_positive")])
    return counts.withColumns({k: F.round(v, digits) for k, v in cols.items()})


def ranked_scores(df: DataFrame, score: str, label: str, groups: Sequence[str] = (),
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Distinct scores, highest first: counts, running counts and totals."""
    counts = (
        df.groupBy(*groups, (F.lit(0.0) - scored(score)).alias("key"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")))
    ranked = prefix_sum(counts, "key", ["n", "pos"], groups, rows_per_bucket=rows_per_bucket)
    return ranked.withColumn("score", F.lit(0.0) - F.col("key")).drop("key")


def ranking_metric_columns() -> dict[str, Column]:
    """Aggregates over :func:`ranked_scores` rows."""
    neg, neg_total = F.col("n") - F.col("pos"), F.col("total_n") - F.col("total_pos")
    pos_above = F.col("cum_pos") - F.col("pos")
    auc = F.sum(neg * (pos_above + F.col("pos") / 2)) / F.first(F.col("total_pos") * neg_total)
    ap = F.sum(F.col("pos") / F.col("total_pos") * F.col("cum_pos") / F.col("cum_n"))
    return {"roc_auc": auc, "pr_auc": ap}


def evaluate(df: DataFrame, score: str, label: str, threshold: float = 0.5,
             groups: Sequence[str] = (), digits: int = 6,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Ranking and class metrics per group from one ranked table."""
    ranked = ranked_scores(df, score, label, groups, rows_per_bucket)
    hit = F.col("score") >= threshold
    neg = F.col("n") - F.col("pos")

    def total(where: Column, what: Column) -> Column:
        return F.sum(F.when(where, what).otherwise(0))

    raw = ranked.groupBy(*groups).agg(
        *[v.alias(k) for k, v in ranking_metric_columns().items()],
        total(~hit, neg).alias("true_negative"), total(hit, neg).alias("false_positive"),
        total(~hit, F.col("pos")).alias("false_negative"),
        total(hit, F.col("pos")).alias("true_positive"))
    counts = ("true_negative", "false_positive", "false_negative", "true_positive")
    cols = class_metric_columns(*[F.col(c) for c in counts])
    return raw.select(*groups, *[F.round(c, digits).alias(c) for c in ("roc_auc", "pr_auc")],
                      *[F.round(v, digits).alias(k) for k, v in cols.items()], *counts)


def roc_curve(df: DataFrame, score: str, label: str, drop_collinear: bool = False,
              rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score plus the origin (threshold NULL)."""
    ranked = ranked_scores(df, score, label, rows_per_bucket=rows_per_bucket)
    if drop_collinear:
        ranked = _drop_collinear(ranked, rows_per_bucket)
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.round((F.col("cum_n") - F.col("cum_pos")) / (F.col("total_n") - F.col("total_pos")), 6)
        .alias("fpr"),
        F.round(F.col("cum_pos") / F.col("total_pos"), 6).alias("tpr"))
    origin = df.agg(F.count("*").alias("c")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def _drop_collinear(ranked: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Leaves out points in the middle of a straight piece of the curve."""
    keyed = ranked.withColumns({"key": F.lit(0.0) - F.col("score"), "one": F.lit(1)})
    numbered = cut_lineage(
        prefix_sum(keyed, "key", ["one"], rows_per_bucket=rows_per_bucket).drop("key", "one"))
    after = numbered.select((F.col("cum_one") - 1).alias("cum_one"),
                            F.col("n").alias("next_n"), F.col("pos").alias("next_pos"))
    straight = (F.col("n") == F.col("next_n")) & (F.col("pos") == F.col("next_pos"))
    inner = F.col("cum_one") > 1  # the first point stays
    return (numbered.join(after, "cum_one", "left")
            .where(~(F.coalesce(straight, F.lit(False)) & inner))
            .drop("next_n", "next_pos"))


def pr_curve(df: DataFrame, score: str, label: str,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(threshold, recall, precision, base_rate) plus the end point (0, 1)."""
    ranked = ranked_scores(df, score, label, rows_per_bucket=rows_per_bucket)
    base = F.round(F.col("total_pos") / F.col("total_n"), 6)
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.round(F.col("cum_pos") / F.col("total_pos"), 6).alias("recall"),
        F.round(F.col("cum_pos") / F.col("cum_n"), 6).alias("precision"),
        base.alias("base_rate"))
    end = df.agg(F.round(F.avg(F.col(label)), 6).alias("base_rate")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"), "base_rate")
    return points.unionByName(end)


def threshold_sweep(df: DataFrame, score: str, label: str,
                    thresholds: Sequence[float] = (0.3, 0.4, 0.5, 0.6, 0.7),
                    digits: int = 6) -> DataFrame:
    """Class metrics and contact volume per threshold, from one pass."""
    y = F.col(label)
    table = {}
    for t in thresholds:
        hit = scored(score) >= t
        table[float(t)] = {
            "true_negative": F.count_if(~hit & (y == 0)),
            "false_positive": F.count_if(hit & (y == 0)),
            "false_negative": F.count_if(~hit & (y == 1)),
            "true_positive": F.count_if(hit & (y == 1)),
        }
    counts = rows_from_aggregates(df, "threshold", table)
    return class_metrics(counts, digits).withColumn(
        "predicted_churn_customers", F.col("true_positive") + F.col("false_positive")
    ).drop("balanced_accuracy", "true_negative")


def _by_score(df: DataFrame, score: str, label: str, key: str) -> DataFrame:
    return df.select((F.lit(0.0) - scored(score)).alias("_order"), key,
                     F.col(label).cast("bigint").alias("_pos"), F.lit(1).alias("_one"))


def gain_curve(df: DataFrame, score: str, label: str, key: str,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Share of positives reached after each customer, best score first.

    Equal scores are taken in ``key`` order; the origin (0, 0) is included.
    """
    ranked = prefix_sum(_by_score(df, score, label, key), "_order", ["_pos", "_one"],
                        tie=key, rows_per_bucket=rows_per_bucket)
    points = ranked.select(
        F.col("cum__one").alias("position"),
        F.round(F.col("cum__one") / F.col("total__one"), 6).alias("contacted_share"),
        F.round(F.col("cum__pos") / F.col("total__pos"), 6).alias("gain"))
    origin = df.agg(F.count("*").alias("c")).select(
        F.lit(0).cast("bigint").alias("position"), F.lit(0.0).alias("contacted_share"),
        F.lit(0.0).alias("gain"))
    return points.unionByName(origin)


def gain_at(df: DataFrame, score: str, label: str, key: str,
            shares: Sequence[float] = (0.1, 0.2, 0.3, 0.5),
            rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Gain and lift after the best floor(share * n) customers.

    One row per share; no customers, no gain. Only the buckets that hold one of these positions
    are sorted.
    """
    bucketed, _ = key_buckets(cut_lineage(_by_score(df, score, label, key)), "_order", key,
                              rows_per_bucket)
    offsets = bucket_offsets(bucketed, ["_pos", "_one"])
    total = offsets.agg(F.sum("_in__one")).first()[0] or 0
    positions = {q: math.floor(q * total) for q in shares}
    wanted = sorted({p for p in positions.values() if p > 0})
    holds = F.exists(F.array(*map(F.lit, wanted)).cast("array<bigint>"),
                     lambda p: (p > F.col("_before__one"))
                     & (p <= F.col("_before__one") + F.col("_in__one")))
    edge = offsets.where(holds)
    near = bucketed.join(edge.select("_bucket", "_sub"), ["_bucket", "_sub"], "left_semi")
    hits = (running_in_buckets(near, edge, "_order", ["_pos", "_one"], tie=key)
            .where(F.col("cum__one").isin(wanted)))
    labels = df.sparkSession.createDataFrame(list(positions.items()),
                                             "share double, position bigint")
    # at most one row per share
    found = hits.select(F.col("cum__one").cast("bigint").alias("position"),
                        (F.col("cum__pos") / F.col("total__pos")).alias("_gain"))
    gain = F.coalesce(F.col("_gain"), F.when(F.col("position") == 0, 0.0))
    return (labels.join(F.broadcast(found), "position", "left")
            .select("share", "position", F.round(gain, 6).alias("gain"),
                    F.round(gain / F.col("share"), 6).alias("lift")))


def contact_volume(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    hit = scored(score) >= threshold
    return df.agg(F.count_if(hit).alias("contacted_at_threshold"),
                  F.round(F.avg(hit.cast("int")), 6).alias("contacted_share"))


def example_customers(df: DataFrame, score: str, key: str, middle: float = 0.55) -> DataFrame:
    """Customers with the highest, the nearest-to-middle and the lowest score.

    Equal scores go to the smallest key.
    """
    p = F.col(score)
    pick = F.struct(F.col(key).alias("k"), p.alias("p"))
    return rows_from_aggregates(df.withColumn(score, scored(score)), "example", {
        name: {"r": F.min_by(pick, F.struct(order.alias("o"), F.col(key)))}
        for name, order in (("high", -p), ("mid", F.abs(p - middle)), ("low", p))
    }).select("example", F.col("r.k").alias(key), F.col("r.p").alias(score))


def numbered_top(df: DataFrame, by: str, name: str, top: int = 10) -> DataFrame:
    """Top rows by a figure, numbered from 1 (ties by name)."""
    best = df.orderBy(F.desc(by), name).limit(top)
    numbered = best.agg(F.array_sort(F.collect_list(
        F.struct((-F.col(by)).alias("o"), F.col(name), F.col(by)))).alias("rows"))
    return numbered.select(F.posexplode("rows").alias("i", "r")).select(
        (F.col("i") + 1).alias("rank"), F.col(f"r.{name}").alias(name), F.col(f"r.{by}").alias(by))


def gain_summary(df: DataFrame, score: str, label: str, key: str, threshold: float = 0.5,
                 shares: Sequence[float] = (0.1, 0.2, 0.3, 0.5), digits: int = 4) -> DataFrame:
    """One row: size, ranking metrics, contact volume and the gains as a struct."""
    volume = df.agg(
        F.count("*").alias("test_n"), F.sum(F.col(label).cast("bigint")).alias("test_pos"))
    ranking = evaluate(df, score, label, threshold, digits=digits) \
        .select(F.struct("roc_auc", "pr_auc")).scalar()
    contact = contact_volume(df, score, threshold).select(F.struct("*")).scalar()
    gains = gain_at(df, score, label, key, shares).agg(F.struct(*[
        F.round(F.max(F.when(F.col("share") == q, F.col("gain"))), digits)
        .alias(f"top{round(q * 100)}pct") for q in shares])).scalar()
    return volume.select(
        "test_n", "test_pos", ranking["roc_auc"].alias("roc_auc"),
        ranking["pr_auc"].alias("pr_auc"), F.lit(threshold).alias("threshold"),
        contact["contacted_at_threshold"].alias("contacted_at_threshold"),
        F.round(contact["contacted_share"], digits).alias("contacted_pct"),
        gains.alias("cumulative_gain"))
