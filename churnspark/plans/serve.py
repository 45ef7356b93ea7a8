"""Scoring and segmenting new customers with stored models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.columns import risk_grade, round_half_even, threshold_label
from churnspark.functions.playbook import suggested_action
from churnspark.operators.evaluation import evaluate
from churnspark.operators.expectations import expect_same_features
from churnspark.operators.models import probability
from churnspark.sources import sinks
from churnspark.sources.tables import path_exists


@dataclass
class Bundle:
    """What scoring needs: fitted model, threshold, feature names."""

    model: PipelineModel
    threshold: float
    features: list[str]

    def check(self) -> "Bundle":
        if not 0.0 < self.threshold < 1.0:
            raise ValueError(f"threshold must lie between 0 and 1: {self.threshold}")
        if not self.features:
            raise ValueError("the bundle has no features")
        fills = [s for s in self.model.stages if hasattr(s, "getInputCols")]
        if fills:  # the majority model looks at no feature
            expect_same_features(fills[0].getInputCols(), self.features)
        return self

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        text = json.dumps({"threshold": self.threshold, "feature_names": self.features})
        spark.createDataFrame([(text,)], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Bundle":
        data = json.loads(spark.read.text(f"{path}/bundle").first().value)
        return cls(PipelineModel.load(f"{path}/model"), data["threshold"],
                   data["feature_names"]).check()


def align_columns(df: DataFrame, features: Sequence[str],
                  types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Add absent feature columns as typed NULLs; the model fills them."""
    types = types or {}
    absent = {c: F.lit(None).cast(types.get(c, T.DoubleType()))
              for c in features if c not in df.columns}
    return df.withColumns(absent) if absent else df


def score_customers(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Input columns plus probability, label, grade and action.

    Label and grade use the unrounded probability. Works on streams as well.
    """
    aligned = align_columns(df, bundle.features)
    scored = bundle.model.transform(aligned).select(
        *[F.col(f"`{c}`") for c in df.columns], probability().alias("_p"))
    graded = scored.select(
        *[F.col(f"`{c}`") for c in df.columns],
        round_half_even("_p").alias("churn_probability"),
        threshold_label("_p", bundle.threshold).alias("churn_prediction"),
        risk_grade("_p").alias("risk_grade"))
    return suggested_action(graded).select(
        *[F.col(f"`{c}`") for c in df.columns], "churn_probability", "churn_prediction",
        "risk_grade", "suggested_action")


def what_if(df: DataFrame, bundle: Bundle, scenarios: Mapping[str, Mapping[str, float]],
            keep: Sequence[str]) -> DataFrame:
    """Rescore every customer under each scenario of changed inputs.

    The scenarios are a short literal list; rows are multiplied map-side.
    """
    changed = sorted({c for change in scenarios.values() for c in change})
    rows = F.array(*[
        F.struct(F.lit(name).alias("scenario"),
                 *[F.lit(change.get(c)).cast("double").alias(c) for c in changed])
        for name, change in scenarios.items()])
    exploded = align_columns(df, bundle.features).withColumn("_s", F.explode(rows))
    applied = exploded.withColumns({
        **{c: F.coalesce(F.col(f"_s.{c}"), F.col(c)) for c in changed},
        "scenario": F.col("_s.scenario")})
    return score_customers(applied.select("scenario", *dict.fromkeys([*keep, *bundle.features])),
                           bundle).select("scenario", *keep, "churn_probability",
                                          "churn_prediction", "risk_grade", "suggested_action")


def evaluate_once(test: DataFrame, bundle: Bundle, label: str, path: str,
                  model_name: str) -> DataFrame:
    """Final metrics at the stored threshold. A second evaluation is refused."""
    spark = test.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(f"the test split was evaluated before: {path}")
    scored = bundle.model.transform(test).select(label, probability().alias("p"))
    metrics = evaluate(scored, "p", label, bundle.threshold, digits=4)
    sizes = test.agg(F.struct(F.count("*").alias("n"),
                              F.bround(F.avg(label), 4).alias("rate"))).scalar()
    result = metrics.select(
        F.current_date().alias("evaluated_on"), F.lit(model_name).alias("model_file"),
        sizes["n"].alias("test_size"), sizes["rate"].alias("churn_rate"),
        F.lit(bundle.threshold).alias("threshold"), "pr_auc", "roc_auc", "accuracy", "precision",
        "recall", "f1", "true_negative", "false_positive", "false_negative", "true_positive")
    result.write.mode("error").parquet(path)  # of two jobs at once, one fails
    return spark.read.parquet(path)
