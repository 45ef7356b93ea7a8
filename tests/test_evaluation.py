"""Metrics against published confusion counts and brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnspark.functions import columns as C
from churnspark.operators import evaluation, grouping, profiling

# (tn, fp, fn, tp) -> accuracy, precision, recall, F1
PUBLISHED = [
    ((4424, 2844, 1048, 1894), (0.6188, 0.3997, 0.6438, 0.4932)),
    ((7268, 0, 2942, 0), (0.7119, 0.0, 0.0, 0.0)),
    ((4353, 2915, 1237, 1705), (0.5933, 0.3690, 0.5795, 0.4509)),
    ((3802, 3466, 969, 1973), (0.5656, 0.3628, 0.6706, 0.4708)),
    ((5998, 1270, 1866, 1076), (0.6929, 0.4587, 0.3657, 0.4070)),
    ((4426, 2842, 1032, 1910), (0.6206, 0.4019, 0.6492, 0.4965)),
    ((4443, 2825, 1062, 1880), (0.6193, 0.3996, 0.6390, 0.4917)),
]


def test_published_confusions(spark):
    df = spark.createDataFrame(
        [(i, *c) for i, (c, _) in enumerate(PUBLISHED)],
        "i int, true_negative long, false_positive long, false_negative long, true_positive long")
    got = {r.i: r for r in evaluation.class_metrics(df, 4).collect()}
    for i, (_, want) in enumerate(PUBLISHED):
        r = got[i]
        assert (r.accuracy, r.precision, r.recall, r.f1) == pytest.approx(want, abs=5e-5)


def _brute(p, y):
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > neg).mean() + (a == neg).mean() / 2 for a in pos])
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / y.sum()
        ap += (recall - last) * y[hit].mean()
        last = recall
    return auc, ap


def test_ranking_metrics_with_ties(spark):
    rng = np.random.default_rng(5)
    p = rng.random(400).round(1)
    y = (rng.random(400) < 0.2 + 0.5 * p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y}))
    row = evaluation.evaluate(df, "p", "y", digits=9).first()
    assert (row.roc_auc, row.pr_auc) == pytest.approx(_brute(p, y), abs=1e-8)


def test_average_precision_reaches_base_rate_for_constant_score(spark):
    df = spark.range(10).select(F.lit(0.0).alias("p"), (F.col("id") < 3).cast("int").alias("y"))
    row = evaluation.evaluate(df, "p", "y").first()
    assert (row.roc_auc, row.pr_auc) == (0.5, 0.3)


def test_grades_at_edges_and_for_nan(spark):
    df = spark.createDataFrame([(0.4,), (0.7,), (0.39999,), (1.0,), (math.nan,), (None,)],
                               "p double")
    rows = df.select(C.risk_grade("p").alias("g"), C.risk_band("p").alias("b"),
                     C.threshold_label("p", 0.5).alias("l")).collect()
    assert [r.g for r in rows] == [C.MID, C.HIGH, C.LOW, C.HIGH, C.LOW, None]
    assert [r.b for r in rows] == [C.LOW, C.MID, C.LOW, C.HIGH, None, None]
    assert [r.l for r in rows] == [0, 1, 0, 1, 0, None]


def test_rounding_follows_array_libraries(spark):
    values = [(k * 100 + 50) / 1e6 for k in range(0, 10_000, 7)]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in df.select(C.round_half_even("p", 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in values]


def test_threshold_sweep_matches_single_confusions(spark):
    df = spark.range(200).select((F.col("id") / 200).alias("p"),
                                 (F.col("id") % 3 == 0).cast("int").alias("y"))
    for r in evaluation.threshold_sweep(df, "p", "y").collect():
        one = evaluation.confusion(df, C.threshold_label("p", r.threshold), "y").first()
        assert (r.true_positive, r.false_positive, r.false_negative) == (
            one.true_positive, one.false_positive, one.false_negative)


def test_pivot_rejects_duplicate_cells(spark):
    df = spark.createDataFrame([("with_retention", "m", 0.5)] * 2,
                               "feature_set string, model string, roc_auc double")
    with pytest.raises(Exception, match="duplicate cell"):
        grouping.pivot_metrics(df, ["with_retention"], ["roc_auc"]).collect()


def test_histogram_of_a_single_value(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, 0)], "x double, y int")
    rows = grouping.histogram_by_class(df, "x", "y", bins=4).collect()
    assert sum(r.n for r in rows) == 2 and len(rows) == 4


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, None), (None, None)],
                               "a int, b string")
    assert profiling.duplicate_rows(df).first()[0] == 2
    assert profiling.duplicate_keys(df, "a").first()[0] == 2


def test_describe_approximate_mode(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    exact = profiling.describe(df, ["x"]).first()
    approx = profiling.describe(df, ["x"], approximate=True).first()
    assert exact.q50 == 500.0 and abs(approx.q50 - 500.0) <= 1
    assert profiling.numeric_columns(df) == ["x"]


UNSCORED = [(1, 0.9, 1), (2, 0.4, 0), (3, None, 1), (4, float("nan"), 0), (5, 0.2, 1)]


@pytest.mark.parametrize("run", [
    lambda df: evaluation.evaluate(df, "p", "y"), lambda df: evaluation.roc_curve(df, "p", "y"),
    lambda df: evaluation.pr_curve(df, "p", "y"), lambda df: evaluation.threshold_sweep(df, "p", "y"),
    lambda df: evaluation.gain_curve(df, "p", "y", "id"),
    lambda df: evaluation.gain_at(df, "p", "y", "id"),
    lambda df: evaluation.contact_volume(df, "p"),
    lambda df: evaluation.example_customers(df, "p", "id"),
    lambda df: evaluation.gain_summary(df, "p", "y", "id")])
def test_rows_without_a_score_stop_every_evaluation(spark, run):
    df = spark.createDataFrame(UNSCORED, "id int, p double, y int")
    with pytest.raises(Exception, match="no score"):
        run(df).collect()
    assert run(df.where("p IS NOT NULL AND NOT isnan(p)")).count() > 0
    assert evaluation.unscored_rows(df, "p").first() == (5, 2)


def test_gains_have_a_row_for_every_share(spark):
    df = spark.createDataFrame([r for r in UNSCORED if r[0] in (1, 2, 5)],
                               "id int, p double, y int")
    rows = {r.share: (r.position, r.gain) for r in evaluation.gain_at(df, "p", "y", "id").collect()}
    assert rows == {0.1: (0, 0.0), 0.2: (0, 0.0), 0.3: (0, 0.0), 0.5: (1, 0.5)}


@pytest.mark.parametrize("rows_per_bucket", [50, 1_000_000])
def test_gains_on_text_keys(spark, rows_per_bucket):
    rows = [(f"C{i:04d}", [0.5, 0.5, 0.5, i / 900][i % 4], i % 3 == 0) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, p double, y boolean").withColumn(
        "y", F.col("y").cast("int")).repartition(5)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    total = sum(r[2] for r in rows)
    want, found = [0.0], 0
    for r in order:
        found += r[2]
        want.append(round(found / total, 6))
    curve = evaluation.gain_curve(df, "p", "y", "k", rows_per_bucket).orderBy("position").collect()
    assert [r.gain for r in curve] == pytest.approx(want, abs=2e-6)
    at = {r.share: r.gain for r in evaluation.gain_at(
        df, "p", "y", "k", rows_per_bucket=rows_per_bucket).collect()}
    assert at == pytest.approx({q: want[int(q * 900)] for q in (0.1, 0.2, 0.3, 0.5)}, abs=2e-6)
