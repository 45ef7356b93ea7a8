"""Tables and models that several queries share, built once per application.

The snapshot and its split are written as Parquet to the shared folder, so
every later query prunes columns and partitions of a plain file scan instead
of repeating the joins, and a lost executor costs a re-read only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.contracts import SNAPSHOT
from churnspark.functions.columns import encode_label
from churnspark.operators import models
from churnspark.operators.preparation import RARE_BELOW
from churnspark.operators.segments import assign_segments, fit_segments, segments_with_centres
from churnspark.plans.prepare import LABEL, Prepared, prepare_variant, split_snapshot
from churnspark.plans.serve import Bundle
from churnspark.session import shared_folder
from churnspark.sources.snapshot import build_snapshot

ROLES = SNAPSHOT
RARE_MIN = RARE_BELOW
THRESHOLD = 0.5

SETTINGS = models.ModelSettings()

# Five centres in scaled feature space for the fixed-centre segment queries.
CENTRES = (
    (-0.2, -0.6, -0.5, 0.4, 1.6, -0.6, -0.4, -0.7),
    (1.6, 0.6, 0.5, 0.3, -0.4, 0.4, 0.2, 0.8),
    (0.1, 0.2, 0.1, 0.3, -0.3, 0.1, -0.3, 1.5),
    (-0.1, -0.3, -0.3, -0.1, -0.1, -0.3, -0.4, -0.4),
    (-0.1, 1.2, 1.1, 0.4, -0.2, 1.2, 1.1, 0.1),
)

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _built:
        _built[key] = make()
    return _built[key]


def folder(spark: SparkSession, sf_dir: str) -> str:
    tag = sha256(sf_dir.encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/churnspark/{spark.sparkContext.applicationId}/{tag}"


def _stored(spark: SparkSession, df: DataFrame, path: str, by_split: bool = False) -> tuple:
    """Write a table; path and schema are kept, so later reads infer nothing."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy("split") if by_split else writer).parquet(path)
    return path, spark.read.parquet(path).schema


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _once(spark, sf_dir, "snapshot", lambda: _stored(
        spark, build_snapshot(spark, sf_dir), f"{folder(spark, sf_dir)}/snapshot"))
    return spark.read.schema(schema).parquet(path)


def _split(spark: SparkSession, sf_dir: str) -> tuple:
    return _once(spark, sf_dir, "split", lambda: _stored(
        spark, split_snapshot(snapshot(spark, sf_dir), ROLES), f"{folder(spark, sf_dir)}/split",
        by_split=True))


def split_path(spark: SparkSession, sf_dir: str) -> str:
    return _split(spark, sf_dir)[0]


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _split(spark, sf_dir)
    return spark.read.schema(schema).parquet(path)


def train_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_table(spark, sf_dir).where(F.col("split") == "train")


def prepared(spark: SparkSession, sf_dir: str, variant: str = "without_retention") -> Prepared:
    def make() -> Prepared:
        done = prepare_variant(split_table(spark, sf_dir), ROLES, variant, RARE_MIN)
        path, schema = _stored(spark, done.table,
                               f"{folder(spark, sf_dir)}/prepared/{variant}", by_split=True)
        done.table = spark.read.schema(schema).parquet(path)
        return done
    return _once(spark, sf_dir, f"prepared/{variant}", make)


def fitted(spark: SparkSession, sf_dir: str, name: str,
           variant: str = "without_retention"):
    def make():
        done = prepared(spark, sf_dir, variant)
        train = done.part("train").persist()
        try:
            return models.fit_model(name, train, done.features, LABEL, ROLES.id, SETTINGS)
        finally:
            train.unpersist()
    return _once(spark, sf_dir, f"model/{variant}/{name}", make)


def fitted_all(spark: SparkSession, sf_dir: str, variant: str) -> dict[str, object]:
    """Every compared model; those fitted before are reused."""
    def key(name: str) -> tuple:
        return (spark.sparkContext.applicationId, sf_dir, f"model/{variant}/{name}")

    done = prepared(spark, sf_dir, variant)
    absent = [n for n in models.MODEL_NAMES if key(n) not in _built]
    if absent:
        found = models.fit_models(absent, done.part("train"), done.features, LABEL, ROLES.id,
                                  SETTINGS)
        _built.update({key(n): m for n, m in found.items()})
    return {n: _built[key(n)] for n in models.MODEL_NAMES}


def bundle(spark: SparkSession, sf_dir: str) -> Bundle:
    """The model chosen for production: boosting without the leak suspects."""
    done = prepared(spark, sf_dir)
    return Bundle(fitted(spark, sf_dir, models.BOOSTING), THRESHOLD, done.features)


def segment_chain(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return _once(spark, sf_dir, "segments", lambda: segments_with_centres(
        snapshot(spark, sf_dir), ROLES.segment_features, CENTRES))


def fitted_segments(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return _once(spark, sf_dir, "fitted_segments", lambda: fit_segments(
        snapshot(spark, sf_dir), ROLES.segment_features))


def segmented(spark: SparkSession, sf_dir: str, keep_scaled: bool = False) -> DataFrame:
    return assign_segments(segment_chain(spark, sf_dir), snapshot(spark, sf_dir),
                           ROLES.segment_features, keep_scaled=keep_scaled)


# ---- formula scores ------------------------------------------------------------
# Scores of fixed formulas over the snapshot: ranking and evaluation queries can
# then be compared with SQL without a fitted model.

def _sigmoid(x):
    return F.round(1 / (1 + F.exp(-x)), 6)


def equipment_scores(df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    days, tenure = F.col("current_equipment_days"), F.col("months_in_service")
    x = (F.lit(-0.4) + F.lit(0.004) * (days - 240) - F.lit(0.02) * (tenure - 64)
         + F.lit(0.1) * (F.col("customer_care_calls") - 3))
    kept = [ROLES.id, encode_label(ROLES.target).alias("y")] if keep is None else keep
    return df.select(*kept, _sigmoid(x).alias("p"))


def formula_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equipment_scores(snapshot(spark, sf_dir))


def formula_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two formulas, each with and without the leak suspect, in long form."""
    c = F.col
    equipment = (F.lit(-0.4) + F.lit(0.004) * (c("current_equipment_days") - 240)
                 - F.lit(0.02) * (c("months_in_service") - 64)
                 + F.lit(0.1) * (c("customer_care_calls") - 3))
    usage = (F.lit(-0.3) - F.lit(0.001) * (c("monthly_minutes") - 930)
             + F.lit(0.002) * (c("overage_minutes") - 230))
    extra = F.lit(0.5) * c("retention_calls")
    rows = F.array(*[
        F.struct(F.lit(fs).alias("feature_set"), F.lit(name).alias("model"), _sigmoid(x).alias("p"))
        for fs, name, x in (
            ("with_retention", "equipment_formula", equipment + extra),
            ("with_retention", "usage_formula", usage + extra),
            ("without_retention", "equipment_formula", equipment),
            ("without_retention", "usage_formula", usage))])
    return snapshot(spark, sf_dir).select(
        ROLES.id, encode_label(ROLES.target).alias("y"), F.inline(rows))
