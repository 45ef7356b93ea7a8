"""Prepared tables -> compared models -> chosen bundle -> one test evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.contracts import VARIANTS
from churnspark.operators import evaluation, grouping, importance, models
from churnspark.operators.expectations import expect_finite, expect_unique
from churnspark.plans.prepare import LABEL, Prepared
from churnspark.plans.serve import Bundle, evaluate_once
from churnspark.sources import sinks


def select_final(metrics: DataFrame, feature_set: str, by: str = "pr_auc") -> str:
    """Best model of the feature set; every pair must have one finite metric row."""
    problems = expect_unique(metrics, ["feature_set", "model"]).limit(1).collect() \
        or expect_finite(metrics, ["feature_set", "model"], ["roc_auc", "pr_auc"]).limit(1).collect()
    if problems:
        raise ValueError(f"metric table is not usable: {problems[0]}")
    best = grouping.best_models(metrics.where(F.col("feature_set") == feature_set), by).first()
    if best is None:
        raise ValueError(f"no metrics for feature set {feature_set}")
    return best.model


def train_and_select(prepared: Mapping[str, Prepared], folder: str,
                     final: str = "without_retention", threshold: float = 0.5,
                     names: Sequence[str] = models.MODEL_NAMES,
                     settings: models.ModelSettings = models.ModelSettings(),
                     repeats: int = 3) -> Bundle:
    """Fit on Train, choose on Validation, evaluate Test once; all tables are stored."""
    spark = prepared[final].table.sparkSession
    key = prepared[final].roles.id
    tables, fitted = [], {}
    for variant in VARIANTS:
        part = prepared[variant]
        metrics, found = models.compare_models(
            part.part("train"), part.part("val"), {variant: part.features}, LABEL, key, names,
            threshold, settings)
        tables.append(metrics)
        fitted.update(found)
    sinks.write_table(tables[0].unionByName(tables[1]), f"{folder}/model_metrics")
    metrics = spark.read.parquet(f"{folder}/model_metrics")
    sinks.write_table(grouping.retention_gain(grouping.pivot_metrics(metrics, VARIANTS)),
                      f"{folder}/model_comparison")
    done = prepared[final]
    name = select_final(metrics.where(F.col("model") != models.DUMMY), final)
    bundle = Bundle(fitted[(final, name)], threshold, done.features).check()
    bundle.save(spark, f"{folder}/bundle")

    validation = models.score(bundle.model, done.part("val"), [key, LABEL])
    sinks.write_table(evaluation.threshold_sweep(validation, "p", LABEL),
                      f"{folder}/threshold_sweep")
    sinks.write_table(importance.model_importance(
        done.part("val"), done.features, LABEL, key, bundle.model, repeats),
        f"{folder}/permutation_importance")

    evaluate_once(done.part("test"), bundle, LABEL, f"{folder}/test_metrics", name)
    test = models.score(bundle.model, done.part("test"), [key, LABEL])
    sinks.write_document(evaluation.gain_summary(test, "p", LABEL, key, threshold),
                         f"{folder}/gain_summary")
    return bundle
