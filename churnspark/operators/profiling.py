"""Profiling and data-quality aggregations. Per-column figures share one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.operators.scale import exact_quantiles, rows_from_aggregates


def numeric_columns(df: DataFrame, drop: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def table_shape(df: DataFrame) -> DataFrame:
    """One row per column with its type, beside the row count."""
    columns = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"),
                        F.lit(t).alias("data_type"))
               for i, (n, t) in enumerate(df.dtypes, 1)]
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*columns)), "n_rows")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; a NULL key is one key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; NULLs are equal.

    One scan; equal rows of a task are combined before the shuffle.
    """
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def null_profile(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """NULL count and share in percent, columns with gaps only."""
    out = rows_from_aggregates(df, "column_name", {
        c: {"null_count": F.count_if(F.col(c).isNull()),
            "null_percent": F.round(F.count_if(F.col(c).isNull()) * 100.0 / F.count("*"), 2)}
        for c in df.columns})
    out = out if all_columns else out.where("null_count > 0")
    return out.orderBy(F.desc("null_count"), "column_name")


def value_counts(df: DataFrame, column: str, keep_null: bool = False,
                 top: int | None = None) -> DataFrame:
    source = df if keep_null else df.where(F.col(column).isNotNull())
    out = source.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    if top is not None:
        out = out.orderBy(F.desc("n"), "value").limit(top)
    return out


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each value among the non-NULL ones."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("value", "n", F.round(F.col("n") / total, 6).alias("share"))


def describe(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column."""
    names = ("q25", "q50", "q75")
    probs = [0.25, 0.5, 0.75]
    if approximate:
        quartiles = {c: {q: F.percentile_approx(c, p, 10_000).cast("double")
                         for q, p in zip(names, probs)} for c in columns}
    else:
        exact = exact_quantiles(df, columns, probs)
        quartiles = {c: {q: F.first(F.lit(v).cast("double")) for q, v in zip(names, exact[c])}
                     for c in columns}
    return rows_from_aggregates(df, "column_name", {
        c: {"n": F.count(F.col(c)),
            "mean": F.round(F.avg(c), 6),
            "std": F.round(F.stddev_samp(c), 6),
            "min": F.min(F.col(c).cast("double")),
            **{q: F.round(v, 6) for q, v in quartiles[c].items()},
            "max": F.max(F.col(c).cast("double"))}
        for c in columns})


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    Columns are stacked into (name, value) pairs that are de-duplicated with
    map-side combine, so no distinct set has to fit into one task.
    """
    if approximate:
        return rows_from_aggregates(df, "column_name", {
            c: {"n_distinct": F.approx_count_distinct(c)} for c in columns})
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])))
    return (pairs.groupBy("column_name", "value").agg(F.lit(1).alias("one"))
            .groupBy("column_name").agg(F.count("value").alias("n_distinct")))


def negative_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = rows_from_aggregates(df, "column_name", {
        c: {"negative_count": F.count_if(F.col(c) < 0)} for c in columns})
    return out.where("negative_count > 0")


def sentinel_profile(df: DataFrame, columns: Sequence[str], sentinel: float = 0.0) -> DataFrame:
    return rows_from_aggregates(df, "column_name", {
        c: {"sentinel_count": F.count_if(F.col(c) == sentinel),
            "null_count": F.count_if(F.col(c).isNull())} for c in columns})


def null_together(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.every(F.col(a).isNull() == F.col(b).isNull()).alias("always_together"),
                  F.count_if(F.col(a).isNull() & F.col(b).isNull()).alias("both_null"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def target_by_split(df: DataFrame, split: str, label: Column,
                    splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Target counts and shares, one row per class, one column pair per split."""
    labelled = df.select(split, label.alias("label"))
    wanted: list[Column] = []
    for s in splits:
        wanted.append(F.count_if(F.col(split) == s).alias(f"{s}_count"))
    counts = labelled.groupBy("label").agg(*wanted)
    totals = labelled.agg(F.struct(*wanted)).scalar()
    return counts.select(
        F.when(F.col("label") == 1, "Churn (1)").otherwise("No Churn (0)").alias("class"),
        *[F.col(f"{s}_count") for s in splits],
        *[F.round(F.col(f"{s}_count") / totals[f"{s}_count"], 6).alias(f"{s}_ratio")
          for s in splits])


def churn_overview(df: DataFrame, label: Column) -> DataFrame:
    y = df.select(label.alias("y"))
    return y.agg(F.count("*").alias("customers"),
                 F.coalesce(F.sum("y"), F.lit(0)).cast("bigint").alias("churned"),
                 F.coalesce(F.sum(1 - F.col("y")), F.lit(0)).cast("bigint").alias("retained"),
                 F.round(F.avg("y"), 6).alias("churn_rate"))


def churn_state_counts(df: DataFrame, label: Column) -> DataFrame:
    """Counts per state in fixed order; a state without rows shows 0."""
    return rows_from_aggregates(df.select(label.alias("y")), "state", {
        "유지": {"state_order": F.first(F.lit(1)), "n": F.count_if(F.col("y") == 0)},
        "이탈": {"state_order": F.first(F.lit(2)), "n": F.count_if(F.col("y") == 1)}})
