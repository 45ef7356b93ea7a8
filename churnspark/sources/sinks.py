"""Writers: split tables, metric tables, JSON documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_by_split(df: DataFrame, path: str) -> None:
    """Parquet in one folder per split.

    Rows keep their partitions: a task writes at most one file per split, and
    no split is gathered in one task.
    """
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.option("header", True).csv(path)
    elif form == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown form: {form}")


def write_document(df: DataFrame, path: str) -> None:
    """One-row nested table as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def document(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """One row of aggregates as a nested document."""
    return df.agg(*[expr.alias(name) for name, expr in fields.items()])


def feature_schema_document(prepared: DataFrame, label: str, roles, rare: list[str]) -> DataFrame:
    """Target, roles, split sizes and rates and the rare levels, as one nested row."""
    def sizes(split: str) -> list[Column]:
        here = F.col("split") == split
        return [F.count_if(here).alias(f"{split}_rows"),
                F.bround(F.avg(F.when(here, F.col(label))), 4).alias(f"{split}_churn_rate")]

    split = prepared.agg(*[c for s in ("train", "val", "test") for c in sizes(s)])
    return split.select(
        F.lit(roles.target).alias("target"),
        F.struct(F.lit(roles.negative).alias("0"), F.lit(roles.positive).alias("1"))
        .alias("target_meaning"),
        F.array(F.lit(roles.id)).alias("id_columns"),
        F.array(*map(F.lit, roles.leak)).alias("leak_suspects"),
        F.array(*map(F.lit, roles.zero_fill)).alias("zero_fill_columns"),
        F.struct("*").alias("split"),
        F.array(*map(F.lit, rare)).cast("array<string>").alias("rare_regions_grouped_to_other"))
