"""Raw snapshot -> split -> prepared feature tables, one per variant."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.contracts import VARIANTS, Roles
from churnspark.functions.columns import encode_label
from churnspark.operators.preparation import (
    RARE_BELOW, FeatureCleanerModel, build_preparation, feature_names)
from churnspark.operators.splitting import stratified_split
from churnspark.sources import sinks
from churnspark.sources.publish import publish

LABEL = "label"


@dataclass
class Prepared:
    variant: str
    roles: Roles
    model: PipelineModel
    features: list[str]
    table: DataFrame  # id, features, label, split

    def part(self, split: str) -> DataFrame:
        return self.table.where(F.col("split") == split)

    @property
    def rare_regions(self) -> list[str]:
        stage = next(s for s in self.model.stages if isinstance(s, FeatureCleanerModel))
        return stage.getState()["rare"]


def split_snapshot(df: DataFrame, roles: Roles, seed: int = 42) -> DataFrame:
    return stratified_split(df, roles.id, encode_label(roles.target, roles.positive), seed)


def prepare_variant(split: DataFrame, roles: Roles, variant: str,
                    min_count: int = RARE_BELOW, price_flag: bool = False) -> Prepared:
    """Fit on Train only, apply to all splits. Persist ``split`` for several variants."""
    chosen = roles.variant(variant)
    model = build_preparation(chosen, min_count).fit(split.where(F.col("split") == "train"))
    features = feature_names(model, chosen, price_flag)
    table = model.transform(split).select(
        roles.id, *[F.col(f"`{c}`") for c in features],
        encode_label(roles.target, roles.positive).alias(LABEL), "split")
    return Prepared(variant, chosen, model, features, table)


def prepare_all(df: DataFrame, roles: Roles, folder: str, min_count: int = RARE_BELOW,
                seed: int = 42, final: str = "without_retention") -> dict[str, Prepared]:
    """The whole preparation job with its files under ``folder``."""
    spark = df.sparkSession
    split_snapshot(df, roles, seed).write.mode("overwrite").partitionBy("split") \
        .parquet(f"{folder}/split")
    split = spark.read.parquet(f"{folder}/split")
    done = {}
    for variant in VARIANTS:
        prepared = prepare_variant(split, roles, variant, min_count)
        sinks.write_by_split(prepared.table, f"{folder}/interim/{variant}")
        prepared.model.write().overwrite().save(f"{folder}/preparation/{variant}")
        prepared.table = spark.read.parquet(f"{folder}/interim/{variant}")
        done[variant] = prepared
    publish(spark, f"{folder}/interim/{final}", f"{folder}/processed")
    sinks.write_document(
        sinks.feature_schema_document(done[final].table, LABEL, roles, done[final].rare_regions),
        f"{folder}/feature_schema")
    return done
