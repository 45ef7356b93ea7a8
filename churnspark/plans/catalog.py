"""One named query per operator; each takes (spark, sf_dir) and returns a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.contracts import VARIANTS
from churnspark.functions import columns as C
from churnspark.functions import playbook
from churnspark.operators import (
    evaluation, expectations, grouping, importance, models, preparation, profiling, segments,
    splitting)
from churnspark.operators.scale import exact_quantiles
from churnspark.plans import serve
from churnspark.plans import workspace as W
from churnspark.plans.prepare import LABEL
from churnspark.sources import sinks, tables
from churnspark.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
R = W.ROLES
ID = R.id
CREDIT_LEVELS = ("1-Highest", "2-High", "3-Good", "4-Medium", "5-Low", "6-VeryLow", "7-Lowest")
CREDIT_COLUMNS = [f"credit_rating_{v}" for v in CREDIT_LEVELS]
RATE_LEVELS = (*CREDIT_LEVELS, "8-Unrated")  # the last level has no customers
NUMERIC = ("monthly_revenue", "perc_change_revenues", "monthly_minutes", "overage_minutes",
           "total_recurring_charge", "perc_change_minutes", "dropped_blocked_calls",
           "customer_care_calls", "active_subs", "months_in_service", "current_equipment_days",
           "age_hh1", "age_hh2")
GAPPY = ("monthly_revenue", "perc_change_revenues", "perc_change_minutes")
SEGMENT = list(R.segment_features)
IMPORTANCE = ("current_equipment_days", "months_in_service", "customer_care_calls",
              "monthly_minutes")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _label():
    return C.encode_label(R.target)


def _labelled(spark, sf) -> DataFrame:
    return W.snapshot(spark, sf).withColumn("y", _label())


def _regions(df: DataFrame) -> DataFrame:
    return df.withColumn(R.region, C.region_of(R.area))


# ---- scans ------------------------------------------------------------------------

@query
def scan_customers(spark, sf):
    return tables.missing_to_null(W.snapshot(spark, sf))


@query
def preview_head(spark, sf):
    return tables.head(W.snapshot(spark, sf), ID)


@query
def preview_tail(spark, sf):
    return tables.tail(W.snapshot(spark, sf), ID)


@query
def union_splits(spark, sf):
    path = W.split_path(spark, sf)
    parts = [tables.read_split(spark, path, s) for s in ("train", "val", "test")]
    return tables.union_parts(parts).select(ID, R.target, "split", *R.segment_features)


@query
def scan_split_test(spark, sf):
    test = tables.read_split(spark, W.split_path(spark, sf), "test")
    return test.select(ID, *R.segment_features, _label().alias("_churn"))


@query
def table_fingerprint(spark, sf):
    return tables.table_fingerprint(W.snapshot(spark, sf).select(
        ID, R.target, R.area, R.price, "credit_rating", "marital_status"))


# ---- profiling ----------------------------------------------------------------------

@query
def table_shape(spark, sf):
    return profiling.table_shape(W.snapshot(spark, sf))


@query
def dup_keys(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return profiling.duplicate_keys(orders, "o_custkey")


@query
def dup_rows(spark, sf):
    return profiling.duplicate_rows(W.snapshot(spark, sf).select(
        "credit_rating", "marital_status", "age_hh1", "age_hh2", "active_subs"))


@query
def null_profile(spark, sf):
    return profiling.null_profile(W.snapshot(spark, sf))


@query
def value_counts_nulls(spark, sf):
    return profiling.value_counts(W.snapshot(spark, sf), "age_hh1", keep_null=True)


@query
def value_counts_top10(spark, sf):
    return profiling.value_counts(W.snapshot(spark, sf), R.price, top=10)


@query
def value_share(spark, sf):
    return profiling.value_share(W.snapshot(spark, sf), "credit_rating")


@query
def describe_numeric(spark, sf):
    return profiling.describe(W.snapshot(spark, sf), NUMERIC)


@query
def distinct_counts(spark, sf):
    return profiling.distinct_counts(W.snapshot(spark, sf), (R.area, R.price, "credit_rating"))


@query
def negative_profile(spark, sf):
    return profiling.negative_profile(W.snapshot(spark, sf), NUMERIC)


@query
def sentinel_counts(spark, sf):
    return profiling.sentinel_profile(W.snapshot(spark, sf), R.zero_fill)


@query
def co_null_check(spark, sf):
    return profiling.null_together(W.snapshot(spark, sf), *R.zero_fill)


@query
def contingency(spark, sf):
    return profiling.contingency(W.snapshot(spark, sf), "handset_web_capable",
                                 "made_call_to_retention_team")


@query
def target_by_split(spark, sf):
    return profiling.target_by_split(W.split_table(spark, sf), "split", _label())


@query
def kpi_overview(spark, sf):
    return profiling.churn_overview(W.snapshot(spark, sf), C.encode_label_ci(R.target))


@query
def churn_state_counts(spark, sf):
    return profiling.churn_state_counts(W.snapshot(spark, sf), _label())


# ---- projections and scalar functions -----------------------------------------------

@query
def project_features(spark, sf):
    return W.snapshot(spark, sf).select(ID, *R.numeric)


@query
def encode_target(spark, sf):
    return W.snapshot(spark, sf).select(ID, _label().alias("y"))


@query
def encode_target_ci(spark, sf):
    noisy = F.concat(F.lit("  "), F.upper(R.target), F.lit(" "))
    return W.snapshot(spark, sf).select(ID, C.encode_label_ci(noisy).alias("y"))


@query
def encode_target_map(spark, sf):
    return W.snapshot(spark, sf).select(ID, C.encode_label_map("marital_status").alias("y"))


@query
def region_prefix(spark, sf):
    return _regions(W.snapshot(spark, sf)).select(ID, R.region)


@query
def rare_levels(spark, sf):
    return preparation.rare_levels(_regions(W.train_table(spark, sf)), R.region, W.RARE_MIN)


@query
def rare_to_other(spark, sf):
    rare = rare_levels(spark, sf)
    df = _regions(W.snapshot(spark, sf)).select(ID, R.region)
    return preparation.rare_to_other(df, R.region, rare).select(ID, R.region)


@query
def unknown_flag(spark, sf):
    return W.snapshot(spark, sf).select(ID, C.unknown_flag(R.price).alias(R.price_flag))


@query
def lenient_numeric(spark, sf):
    return W.snapshot(spark, sf).select(ID, C.lenient_double(R.price).alias(R.price))


@query
def clip_bounds(spark, sf):
    df = W.snapshot(spark, sf).select(*SEGMENT)
    filled = preparation.MedianFill(inputCols=SEGMENT).fit(df).transform(df)
    bounds = preparation.QuantileClip(inputCols=SEGMENT).fit(filled).getState()
    return preparation.state_table(spark, {
        c: [round(v, 6) for v in b] for c, b in bounds.items()}, ["lower", "upper"])


@query
def winsorize(spark, sf):
    df = W.snapshot(spark, sf).select(ID, *SEGMENT)
    clipped = preparation.QuantileClip(inputCols=SEGMENT).fit(df).transform(df)
    return clipped.select(ID, *[F.round(c, 6).alias(c) for c in SEGMENT])


@query
def zero_fill(spark, sf):
    fill = preparation.ConstantFill(inputCols=list(R.zero_fill), value=0.0)
    return fill.transform(W.snapshot(spark, sf).select(ID, *R.zero_fill))


def _scaler(spark, sf):
    cols = ["monthly_minutes", "months_in_service", "current_equipment_days"]
    train = W.train_table(spark, sf)
    return cols, preparation.PopulationScaler(inputCols=cols).fit(train)


@query
def standardize(spark, sf):
    cols, scaler = _scaler(spark, sf)
    out = scaler.transform(W.snapshot(spark, sf).select(ID, *cols))
    return out.select(ID, *[F.round(c, 6).alias(c) for c in cols])


@query
def destandardize(spark, sf):
    cols, scaler = _scaler(spark, sf)
    out = scaler.transform(W.snapshot(spark, sf).select(ID, *cols))
    state = scaler.getState()
    return out.select(ID, *[F.round(C.destandardize(c, *state[c]), 6).alias(c) for c in cols])


@query
def scaler_state(spark, sf):
    _, scaler = _scaler(spark, sf)
    return preparation.state_table(spark, {
        c: [round(v, 6) for v in s] for c, s in scaler.getState().items()}, ["mean", "scale"])


@query
def align_schema(spark, sf):
    narrow = W.snapshot(spark, sf).select(ID, "monthly_minutes", "months_in_service")
    return serve.align_columns(narrow, ["monthly_minutes", "roaming_calls", "income_group"])


@query
def threshold_label(spark, sf):
    return W.formula_scores(spark, sf).select(
        ID, "p", C.threshold_label("p", W.THRESHOLD).alias("churn_prediction"))


@query
def risk_grade(spark, sf):
    return W.formula_scores(spark, sf).select(ID, "p", C.risk_grade("p").alias("risk_grade"))


@query
def band_cut(spark, sf):
    return W.formula_scores(spark, sf).select(ID, "p", C.risk_band("p").alias("risk_band"))


@query
def round_probability(spark, sf):
    return W.formula_scores(spark, sf).select(ID, C.round_half_even("p", 4).alias("p4"))


@query
def action_lookup(spark, sf):
    graded = W.formula_scores(spark, sf).select(ID, C.risk_grade("p").alias("risk_grade"))
    return playbook.suggested_action(graded).select(ID, "risk_grade", "suggested_action")


@query
def grade_playbook(spark, sf):
    graded = W.formula_scores(spark, sf).select(ID, C.risk_grade("p").alias("risk_grade"))
    return playbook.grade_playbook(graded)


@query
def segment_playbook(spark, sf):
    named = segment_assignment(spark, sf).select(ID, "ClusterName")
    # without listed steps for one segment and no profile for another, so that
    # both fallbacks are taken
    profiles = playbook.segment_profiles(spark).where(
        F.col("ClusterName") != segments.REGULAR).withColumn(
        "steps", F.when(F.col("ClusterName") != segments.LOYAL, F.col("steps")))
    return playbook.segment_playbook(named, profiles)


@query
def onehot_wide(spark, sf):
    cols = ["credit_rating", "marital_status"]
    encoder = preparation.LevelEncoder(inputCols=cols).fit(W.train_table(spark, sf))
    return encoder.transform(W.snapshot(spark, sf).select(ID, *cols)).drop(*cols)


@query
def onehot_decode(spark, sf):
    wide = onehot_wide(spark, sf)
    present = [c for c in CREDIT_COLUMNS if c in wide.columns]
    return wide.select(ID, C.decode_levels(present, CREDIT_COLUMNS[2]).alias("encoded"))


@query
def level_from_name(spark, sf):
    name = F.concat(F.lit("credit_"), F.col("credit_rating"))
    return W.snapshot(spark, sf).select(ID, C.level_text(name).alias("level"))


# ---- filters and expectations ---------------------------------------------------------

@query
def filter_metrics(spark, sf):
    rows = _metrics(spark, sf).where(
        (F.col("feature_set") == "without_retention") & (F.col("model") == "usage_formula"))
    return rows


@query
def filter_topn_levels(spark, sf):
    df = W.snapshot(spark, sf).select(ID, F.substring(R.area, 1, 3).alias("region"))
    return grouping.keep_top_levels(df, "region", 15).select(ID, "region")


@query
def base_row(spark, sf):
    found = exact_quantiles(W.snapshot(spark, sf), SEGMENT, [0.5])
    return preparation.state_table(spark, {c: [round(v[0], 6)] for c, v in found.items()},
                                   ["median"])


@query
def row_by_key(spark, sf):
    return W.snapshot(spark, sf).where(F.col(ID) == 77)


@query
def variant_consistency(spark, sf):
    both = [W.prepared(spark, sf, v).table for v in VARIANTS]
    shared = [c for c in both[1].columns if c in R.numeric] + [LABEL]
    return expectations.variant_consistency(*both, ID, shared)


@query
def expect_unique(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return expectations.expect_unique(orders, ["o_custkey"])


@query
def expect_finite_range(spark, sf):
    df = W.snapshot(spark, sf)
    return expectations.expect_finite(df, [ID], GAPPY, low=-0.9, high=100_000.0)


@query
def expect_equal(spark, sf):
    df = W.snapshot(spark, sf)
    return expectations.expect_equal(df, [ID], F.col("age_hh1"), F.col("age_hh2"))


@query
def expect_date(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 != 0, F.concat(
            F.date_format("o_orderdate", "yyyy-MM-"),
            F.when(F.col("o_orderkey") % 7 == 0, "32")
            .otherwise(F.date_format("o_orderdate", "dd")))).alias("day"))
    return expectations.expect_iso_date(orders, ["o_orderkey"], "day")


# ---- grouped aggregations -----------------------------------------------------------

@query
def churn_rate_by_credit(spark, sf):
    return grouping.rate_by(W.snapshot(spark, sf), "credit_rating", _label())


@query
def churn_rate_by_web_capable(spark, sf):
    return grouping.rate_by(W.snapshot(spark, sf), "handset_web_capable", _label())


@query
def churn_rate_by_retention_contact(spark, sf):
    return grouping.rate_by(W.snapshot(spark, sf), "made_call_to_retention_team", _label())


@query
def churn_rate_by_region(spark, sf):
    df = W.snapshot(spark, sf).withColumn("region", F.substring(R.area, 1, 3))
    return grouping.rate_by(df, "region", _label())


@query
def churn_rate_ordered(spark, sf):
    return grouping.rate_in_order(W.snapshot(spark, sf), "credit_rating", _label(), RATE_LEVELS)


@query
def churn_rate_top_regions(spark, sf):
    df = W.snapshot(spark, sf).withColumn("region", F.substring(R.area, 1, 3))
    return grouping.rate_of_top_levels(df, "region", _label())


@query
def risk_band_summary(spark, sf):
    return grouping.risk_band_summary(W.formula_scores(spark, sf), "p", "y")


@query
def histogram_by_class(spark, sf):
    return grouping.histogram_by_class(_labelled(spark, sf), "current_equipment_days", "y")


@query
def score_histogram(spark, sf):
    return grouping.score_histogram(W.formula_scores(spark, sf), "p", "y")


@query
def corr_with_target(spark, sf):
    return grouping.correlation_with_target(_labelled(spark, sf), NUMERIC, "y")


@query
def corr_matrix(spark, sf):
    return grouping.correlation_matrix(_labelled(spark, sf), ["y", *SEGMENT])


@query
def scaling_check(spark, sf):
    scaled = W.segmented(spark, sf, keep_scaled=True)
    return grouping.scaling_check(scaled, [f"z_{c}" for c in SEGMENT])


@query
def class_weights(spark, sf):
    return grouping.class_weights(W.train_table(spark, sf).withColumn("y", _label()), "y")


def _metrics(spark, sf) -> DataFrame:
    return evaluation.evaluate(W.formula_score_table(spark, sf), "p", "y", W.THRESHOLD,
                               ["feature_set", "model"])


@query
def metrics_long(spark, sf):
    return _metrics(spark, sf)


@query
def metrics_unpivot(spark, sf):
    return grouping.unpivot_metrics(_metrics(spark, sf))


@query
def metrics_pivot(spark, sf):
    return grouping.pivot_metrics(_metrics(spark, sf), VARIANTS)


@query
def retention_gain(spark, sf):
    pivoted = grouping.pivot_metrics(_metrics(spark, sf), VARIANTS, ["roc_auc", "pr_auc"])
    return grouping.retention_gain(pivoted)


@query
def model_selection(spark, sf):
    return grouping.best_models(_metrics(spark, sf))


# ---- ranking and evaluation ------------------------------------------------------------

@query
def topk(spark, sf):
    df = W.snapshot(spark, sf).select(ID, "total_recurring_charge")
    return df.orderBy(F.desc("total_recurring_charge"), ID).limit(10)


@query
def rank_features(spark, sf):
    found = grouping.correlation_with_target(_labelled(spark, sf), NUMERIC, "y", top=None)
    strength = found.select("column_name", F.abs("correlation").alias("strength"))
    return evaluation.numbered_top(strength, "strength", "column_name", 10)


@query
def example_customers(spark, sf):
    return evaluation.example_customers(W.formula_scores(spark, sf), "p", ID)


@query
def gain_curve(spark, sf):
    return evaluation.gain_curve(W.formula_scores(spark, sf), "p", "y", ID)


@query
def gain_at_pct(spark, sf):
    return evaluation.gain_at(W.formula_scores(spark, sf), "p", "y", ID)


@query
def gain_summary(spark, sf):
    out = evaluation.gain_summary(W.formula_scores(spark, sf), "p", "y", ID, W.THRESHOLD, digits=6)
    return out.select(*[c for c in out.columns if c != "cumulative_gain"], "cumulative_gain.*")


@query
def contact_volume(spark, sf):
    return evaluation.contact_volume(W.formula_scores(spark, sf), "p", W.THRESHOLD)


@query
def seeded_sample(spark, sf):
    return splitting.seeded_sample(W.snapshot(spark, sf).select(ID, R.target), ID, 1000)


@query
def confusion(spark, sf):
    return evaluation.confusion(W.formula_scores(spark, sf),
                                C.threshold_label("p", W.THRESHOLD), "y")


@query
def class_metrics(spark, sf):
    return evaluation.class_metrics(confusion(spark, sf))


@query
def roc_auc(spark, sf):
    return evaluation.evaluate(W.formula_scores(spark, sf), "p", "y").select("roc_auc")


@query
def average_precision(spark, sf):
    return evaluation.evaluate(W.formula_scores(spark, sf), "p", "y").select("pr_auc")


@query
def roc_curve(spark, sf):
    return evaluation.roc_curve(W.formula_scores(spark, sf), "p", "y")


@query
def roc_curve_reduced(spark, sf):
    return evaluation.roc_curve(W.formula_scores(spark, sf), "p", "y", drop_collinear=True)


@query
def pr_curve(spark, sf):
    return evaluation.pr_curve(W.formula_scores(spark, sf), "p", "y")


@query
def threshold_sweep(spark, sf):
    return evaluation.threshold_sweep(W.formula_scores(spark, sf), "p", "y")


@query
def live_metrics(spark, sf):
    val = W.split_table(spark, sf).where(F.col("split") == "val")
    return evaluation.evaluate(W.equipment_scores(val), "p", "y", W.THRESHOLD)


# ---- preparation ----------------------------------------------------------------------

@query
def stratified_split(spark, sf):
    split = splitting.stratified_split(W.snapshot(spark, sf).select(ID, R.target), ID, _label())
    return split.select(ID, R.target, "split")


@query
def clean_features(spark, sf):
    cleaner = preparation.FeatureCleaner.for_roles(R, W.RARE_MIN).fit(W.train_table(spark, sf))
    return cleaner.transform(W.snapshot(spark, sf)).select(ID, R.region, R.price, R.price_flag)


@query
def impute_median(spark, sf):
    model = preparation.MedianFill(inputCols=list(GAPPY)).fit(W.train_table(spark, sf))
    out = model.transform(W.snapshot(spark, sf).select(ID, *GAPPY))
    return out.select(ID, *[F.round(c, 6).alias(c) for c in GAPPY])


@query
def impute_mode(spark, sf):
    region = F.substring(R.area, 1, 3)
    train = W.train_table(spark, sf).withColumn("region", region)
    model = preparation.ModeFill(inputCols=["region"]).fit(train)
    return model.transform(W.snapshot(spark, sf).select(ID, region.alias("region")))


@query
def robust_scale(spark, sf):
    cols = ["monthly_revenue", "overage_minutes", "retention_calls"]  # the last has range 0
    model = preparation.RobustScale(inputCols=cols).fit(W.train_table(spark, sf))
    out = model.transform(W.snapshot(spark, sf).select(ID, *cols))
    return out.select(ID, *[F.round(c, 6).alias(c) for c in cols])


@query
def missing_indicators(spark, sf):
    cols = [*GAPPY, "monthly_minutes"]
    model = preparation.MissingFlags(inputCols=cols).fit(W.train_table(spark, sf))
    return model.transform(W.snapshot(spark, sf).select(ID, *cols)).drop(*cols)


@query
def feature_variants(spark, sf):
    out = None
    for v in VARIANTS:
        done = W.prepared(spark, sf, v)
        numeric = [c for c in done.roles.numeric]
        part = done.table.groupBy("split").agg(
            F.lit(v).alias("variant"), F.lit(len(done.features)).cast("bigint").alias("n_features"),
            F.lit(len(numeric)).cast("bigint").alias("n_numeric"), F.count("*").alias("n_rows"),
            F.round(F.avg(LABEL), 6).alias("churn_rate"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def prepared_features(spark, sf):
    done = W.prepared(spark, sf)
    return shown_features(done.table, done.features)


def shown_features(table: DataFrame, features: list[str]) -> DataFrame:
    """Numbers and the flags of two categories, rounded."""
    return table.select(ID, LABEL, "split", *[
        F.round(F.col(f"`{c}`"), 6).alias(c) for c in features
        if c in R.numeric or c.startswith(("credit_rating", "handset_web_capable"))])


@query
def feature_names(spark, sf):
    """Feature columns in output order with their Train mean and spread."""
    done = W.prepared(spark, sf)
    stats = grouping.scaling_check(done.part("train"), done.features)
    order = {name: i for i, name in enumerate(done.features, 1)}
    return stats.select(C.map_values("column_name", order).alias("position"), "column_name",
                        (F.col("mean") + 0.0).alias("mean"), (F.col("std") + 0.0).alias("std"))


@query
def sparse_feature_names(spark, sf):
    """Names read from the attributes of the sparse feature vector, with Train mean and spread."""
    train = W.train_table(spark, sf)
    table = preparation.build_sparse_preparation(R, W.RARE_MIN).fit(train).transform(train)
    found = preparation.vector_means(table.select("features"))
    return found.select("position", "column_name", (F.round("mean", 6) + 0.0).alias("mean"),
                        (F.round("std", 6) + 0.0).alias("std"))


@query
def feature_schema(spark, sf):
    done = W.prepared(spark, sf)
    return sinks.feature_schema_document(done.table, LABEL, R, done.rare_regions)


@query
def pca_projection(spark, sf):
    scaled = W.segmented(spark, sf, keep_scaled=True)
    return segments.project_2d(scaled, SEGMENT, [ID, "Cluster"])


# ---- models -----------------------------------------------------------------------------

@query
def dummy_baseline(spark, sf):
    train = W.train_table(spark, sf).withColumn("y", _label())
    val = W.split_table(spark, sf).where(F.col("split") == "val").withColumn("y", _label())
    scored = models.score(models.MostFrequent.fit(train, "y"), val, ["y"])
    return evaluation.evaluate(scored, "p", "y", W.THRESHOLD)


def _validation_scores(name: str) -> Query:
    def run(spark, sf):
        val = W.prepared(spark, sf).part("val")
        return models.score(W.fitted(spark, sf, name), val, [ID, LABEL])
    return run


QUERIES["logistic_scores"] = _validation_scores(models.LOGISTIC)
QUERIES["tree_scores"] = _validation_scores(models.TREE)
QUERIES["forest_scores"] = _validation_scores(models.FOREST)
QUERIES["boosting_scores"] = _validation_scores(models.BOOSTING)


@query
def model_metrics(spark, sf):
    """All models on both variants; models fitted by other queries are reused."""
    stacked = None
    for variant in VARIANTS:
        val = W.prepared(spark, sf, variant).part("val")
        for name, model in W.fitted_all(spark, sf, variant).items():
            scored = models.score(model, val, [LABEL]).select(
                F.lit(variant).alias("feature_set"), F.lit(name).alias("model"), LABEL, "p")
            stacked = scored if stacked is None else stacked.unionByName(scored)
    return evaluation.evaluate(stacked, "p", LABEL, W.THRESHOLD, ["feature_set", "model"])


@query
def kmeans_segments(spark, sf):
    chain, df = W.fitted_segments(spark, sf), W.snapshot(spark, sf)
    return segments.segment_sizes(segments.assign_segments(chain, df, SEGMENT))


@query
def k_scan(spark, sf):
    scaled = W.segmented(spark, sf, keep_scaled=True).drop("Cluster").persist()
    try:
        return segments.scan_k(scaled, SEGMENT, ID)
    finally:
        scaled.unpersist()


@query
def permutation_importance(spark, sf):
    done, model = W.prepared(spark, sf), W.bundle(spark, sf).model
    return importance.model_importance(done.part("val"), done.features, LABEL, ID, model)


@query
def formula_importance(spark, sf):
    """Permutation importance of the fixed equipment formula, which uses three of four features."""
    df = W.snapshot(spark, sf).withColumn("y", _label())
    found = importance.permutation_importance(
        df, IMPORTANCE, "y", ID, lambda t, keep: W.equipment_scores(t, keep))
    return found.select("feature", F.round("importance_mean", 6).alias("importance_mean"),
                        F.round("importance_std", 6).alias("importance_std"))


@query
def evaluate_test_once(spark, sf):
    done = W.prepared(spark, sf)
    path = W._once(spark, sf, "test_metrics", lambda: _evaluate(spark, sf, done))
    return spark.read.parquet(path).drop("evaluated_on")


def _evaluate(spark, sf, done) -> str:
    path = f"{W.folder(spark, sf)}/test_metrics"
    serve.evaluate_once(done.part("test"), W.bundle(spark, sf), LABEL, path, models.BOOSTING)
    return path


# ---- segments -----------------------------------------------------------------------------

@query
def assign_segment(spark, sf):
    return W.segmented(spark, sf).select(ID, "Cluster")


@query
def segment_sizes(spark, sf):
    return segments.segment_sizes(W.segmented(spark, sf))


@query
def segment_means(spark, sf):
    return segments.segment_means(W.segmented(spark, sf), SEGMENT)


@query
def segment_index(spark, sf):
    return segments.segment_index(W.segmented(spark, sf), SEGMENT)


@query
def segment_names(spark, sf):
    index = segments.segment_index(W.segmented(spark, sf), SEGMENT, digits=None)
    return segments.segment_names(index, "monthly_revenue", "customer_care_calls",
                                  "active_subs", "months_in_service")


@query
def segment_assignment(spark, sf):
    return segments.assign_segments(W.segment_chain(spark, sf), W.snapshot(spark, sf), SEGMENT,
                                    names=segment_names(spark, sf)).select(
        ID, R.target, "Cluster", "ClusterName")


@query
def segment_churn(spark, sf):
    named = segment_assignment(spark, sf)
    return segments.segment_churn(
        named.withColumn("ChurnNumeric", C.encode_label_map(R.target)), "ChurnNumeric")


@query
def silhouette_sample(spark, sf):
    scaled = W.segmented(spark, sf, keep_scaled=True)
    return segments.silhouette(scaled, [f"z_{c}" for c in SEGMENT], ID)


@query
def k_scan_fixed(spark, sf):
    """Inertia and silhouette of the first 1, 2 .. 5 fixed centres, from one sample."""
    scaled = W.segmented(spark, sf, keep_scaled=True).drop("Cluster")
    return segments.scan_centres(scaled, SEGMENT, ID, {
        k: W.CENTRES[:k] for k in range(1, len(W.CENTRES) + 1)}).select(
            "K", F.round("Inertia", 4).alias("Inertia"), "SilhouetteScore")


@query
def k_scan_one(spark, sf):
    """The fitted scan for K = 1, whose inertia is the total variation."""
    scaled = W.segmented(spark, sf, keep_scaled=True).drop("Cluster")
    return segments.scan_k(scaled, SEGMENT, ID, ks=(1,), n_init=1).select(
        "K", F.round("Inertia", 4).alias("Inertia"), "SilhouetteScore")


@query
def segment_defaults(spark, sf):
    state = segments.segment_state(W.segment_chain(spark, sf))
    return preparation.state_table(spark, {c: [round(s["median"], 6)] for c, s in state.items()},
                                   ["median"])


# ---- serving --------------------------------------------------------------------------------

@query
def score_customers(spark, sf):
    out = serve.score_customers(W.prepared(spark, sf).table, W.bundle(spark, sf))
    return out.select(ID, "split", "churn_probability", "churn_prediction", "risk_grade",
                      "suggested_action")


@query
def score_stream(spark, sf):
    """The scoring plan over a stream of prepared customers, written and read back."""
    done, bundle = W.prepared(spark, sf), W.bundle(spark, sf)

    def run() -> str:
        base = f"{W.folder(spark, sf)}/stream"
        source = f"{W.folder(spark, sf)}/prepared/without_retention"
        stream = scoring.customer_stream(spark, source, done.table.schema)
        scoring.score_stream(stream, bundle, f"{base}/scored", f"{base}/checkpoint") \
            .awaitTermination()
        return f"{base}/scored"

    return spark.read.parquet(W._once(spark, sf, "stream", run)).select(
        ID, "split", "churn_probability", "churn_prediction", "risk_grade", "suggested_action")


@query
def what_if(spark, sf):
    """Every customer again with old or new equipment, given in days."""
    done, bundle = W.prepared(spark, sf), W.bundle(spark, sf)
    mean, scale = preparation.scaler_state(done.model)["current_equipment_days"]
    scenarios = {name: {"current_equipment_days": (days - mean) / scale}
                 for name, days in (("new_equipment", 30.0), ("old_equipment", 900.0))}
    return serve.what_if(done.table, bundle, scenarios, [ID])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_rate_by_credit(spark, sf_dir)
