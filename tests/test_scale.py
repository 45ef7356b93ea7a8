"""Bucketed running totals, exact quantiles and hash cut-offs against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_order
from churnspark.operators import grouping
from churnspark.operators.evaluation import gain_at, gain_curve, ranked_scores, roc_curve
from churnspark.operators.scale import exact_quantiles, hash_cutoffs, key_buckets, prefix_sum
from churnspark.operators.splitting import allocate, seeded_sample, stratified_split


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key."""
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.34, 0.25, np.round(rng.normal(size=n), 3))
    pdf = pd.DataFrame({"id": rng.permutation(n).astype("int64"), "key": key,
                        "v": rng.integers(0, 5, n).astype("int64"),
                        "g": np.where(rng.random(n) < 0.3, "a", "b")})
    return pdf, spark.createDataFrame(pdf).repartition(4).cache()


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 100])
def test_prefix_sum_with_hot_key(skewed, rows_per_bucket):
    pdf, df = skewed
    want = pdf.sort_values(["key", "id"])
    want = dict(zip(want.id, want.v.cumsum()))
    got = prefix_sum(df.select("id", "key", "v"), "key", ["v"], tie="id",
                     rows_per_bucket=rows_per_bucket).collect()
    assert {r.id: r.cum_v for r in got} == want
    assert {r.total_v for r in got} == {int(pdf.v.sum())}


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 50])
def test_prefix_sum_per_group(skewed, rows_per_bucket):
    pdf, df = skewed
    small = pdf.groupby(["g", "key"], as_index=False).v.sum()
    want = small.sort_values(["g", "key"])
    want["c"] = want.groupby("g").v.cumsum()
    want = {(g, k): c for g, k, c in zip(want.g, want.key, want.c)}
    table = df.groupBy("g", "key").agg(F.sum("v").alias("v"))
    got = prefix_sum(table, "key", ["v"], ["g"], rows_per_bucket=rows_per_bucket).collect()
    assert {(r.g, r.key): r.cum_v for r in got} == want


@pytest.mark.parametrize("options", [{}, {"small_column": 0}, {"small_column": 0, "accuracy": 20}])
def test_exact_quantiles(skewed, options):
    pdf, df = skewed
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, ["key", "v"], probs, **options)
    for c in ("key", "v"):
        assert np.allclose(got[c], np.quantile(pdf[c], probs), atol=1e-12)


def test_quantiles_skip_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.5], "b": [None]}


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_cutoffs(skewed, digits):
    pdf, df = skewed
    hashed = df.withColumn("h", hash_order(7, "id"))
    order = sorted(r.h for r in hashed.select("h").collect())
    got = hash_cutoffs(hashed, "h", {None: [1, 1500, 3000, 3001]}, digits=digits)[None]
    assert got == [order[0], order[1499], order[2999], None]


def test_allocate_largest_remainder():
    assert allocate({0: 5, 1: 5}, 3) == {0: 2, 1: 1}
    assert allocate({0: 7, 1: 3}, 2) == {0: 1, 1: 1}
    assert sum(allocate({0: 11, 1: 17, 2: 3}, 13).values()) == 13


def test_split_is_exact_and_disjoint(skewed):
    pdf, df = skewed
    split = stratified_split(df, "id", (F.col("g") == "a").cast("int"))
    rows = split.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"),
                                      F.avg((F.col("g") == "a").cast("int")).alias("r")).collect()
    sizes = {r.split: r.n for r in rows}
    assert sizes == {"test": 600, "val": 600, "train": 1800}
    assert all(r.n == r.d for r in rows)
    share = (pdf.g == "a").mean()
    assert all(abs(r.r - share) <= 1 / r.n for r in rows)
    again = stratified_split(df.repartition(2), "id", (F.col("g") == "a").cast("int"))
    assert split.select("id", "split").exceptAll(again.select("id", "split")).count() == 0


def test_seeded_sample_size(skewed):
    _, df = skewed
    a, b = seeded_sample(df, "id", 100), seeded_sample(df.repartition(7), "id", 100)
    assert a.count() == 100
    assert {r.id for r in a.collect()} == {r.id for r in b.collect()}
    assert seeded_sample(df, "id", 99_999).count() == 3000


@pytest.fixture(scope="module")
def scores(spark, skewed):
    pdf, _ = skewed
    s = pdf.assign(p=np.clip(pdf.key * 0.2 + 0.5, 0, 1).round(2), y=(pdf.v > 2).astype("int32"))
    return s, spark.createDataFrame(s[["id", "p", "y"]]).cache()


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 100])
def test_gains_with_ties(scores, rows_per_bucket):
    pdf, df = scores
    order = pdf.sort_values(["p", "id"], ascending=[False, True])
    gain = (order.y.cumsum() / order.y.sum()).round(6).tolist()
    curve = gain_curve(df, "p", "y", "id", rows_per_bucket).orderBy("position").collect()
    assert np.allclose([r.gain for r in curve], [0.0, *gain], atol=2e-6)
    at = {r.share: r for r in gain_at(df, "p", "y", "id",
                                      rows_per_bucket=rows_per_bucket).collect()}
    for q in (0.1, 0.2, 0.3, 0.5):
        position = int(q * len(pdf))
        assert at[q].position == position
        assert abs(at[q].gain - gain[position - 1]) < 2e-6


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 10])
def test_ranked_scores_bucketed(scores, rows_per_bucket):
    pdf, df = scores
    got = {r.score: (r.cum_n, r.cum_pos) for r in ranked_scores(
        df, "p", "y", rows_per_bucket=rows_per_bucket).collect()}
    for p, (n, pos) in got.items():
        assert n == (pdf.p >= p).sum() and pos == pdf.y[pdf.p >= p].sum()
    assert len(got) == pdf.p.nunique()


def test_reduced_roc_keeps_the_curve(scores):
    _, df = scores
    full = {(r.fpr, r.tpr) for r in roc_curve(df, "p", "y").collect()}
    less = {(r.fpr, r.tpr) for r in roc_curve(df, "p", "y", True, rows_per_bucket=10).collect()}
    assert less <= full and (0.0, 0.0) in less and (1.0, 1.0) in less


def test_co_moments_of_blocks_merge(spark):
    """Gaps in any pattern, a column without spread and one without values, large offsets."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd"))
    pdf["b"] = pdf.a + pdf.b + 1e6
    pdf["e"], pdf["f"] = 3.0, None
    pdf = pdf.astype(float).mask(rng.random(pdf.shape) < 0.2)
    names = list(pdf.columns)
    table = grouping.correlation_matrix(spark.createDataFrame(pdf).repartition(5), names)
    got = {(r.column_a, r.column_b): r.correlation for r in table.collect()}
    want = pdf.corr()
    assert len(got) == 36
    for a in names:
        for b in names:
            if "e" in (a, b) or "f" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=2e-6)


def test_correlations_take_one_scan(spark):
    wide = spark.range(50).select(*[F.sin(F.col("id") * i).alias(f"c{i}") for i in range(1, 40)])
    plan = grouping.correlation_matrix(wide, wide.columns)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Range (") == 1


def test_both_quantile_ways_agree_to_the_last_bit(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": rng.normal(size=997) * 1e3, "b": rng.integers(0, 7, 997) / 3,
                        "c": rng.lognormal(size=997)})
    pdf.loc[pdf.index % 5 == 0, "c"] = None
    df = spark.createDataFrame(pdf).repartition(3)
    probs = [0.0, 0.01, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]
    assert exact_quantiles(df, list("abc"), probs) == exact_quantiles(
        df, list("abc"), probs, small_column=0)


def test_tied_text_keys_find_their_bucket_by_binary_search(spark):
    df = spark.range(2_000).select(F.lit(0.5).alias("k"), F.format_string("C%05d", "id").alias("tie"))
    placed, _ = key_buckets(df, "k", "tie", rows_per_bucket=50)
    assert "filter(_cuts" not in placed._jdf.queryExecution().analyzed().toString()
    parts = placed.groupBy("_bucket", "_sub").agg(
        F.count("*").alias("n"), F.min("tie").alias("lo"), F.max("tie").alias("hi")) \
        .orderBy("_bucket", "_sub").collect()
    assert len(parts) > 20 and sum(r.n for r in parts) == 2_000
    assert all(a.hi < b.lo for a, b in zip(parts, parts[1:]))
