"""Data expectations: each check returns the violations, empty when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Ranges of keys whose summed row hashes are compared, and how many of them are compared on their own.
LEAVES = 4096
FEW_LEAVES = 256


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def expect_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df


def expect_same_features(left: Sequence[str], right: Sequence[str]) -> None:
    """Feature lists must agree in number and order."""
    if len(left) != len(right):
        raise ValueError(f"feature counts differ: {len(left)} and {len(right)}")
    if list(left) != list(right):
        raise ValueError("feature order differs")


def extra_columns(wide: DataFrame, narrow: DataFrame) -> list[str]:
    return [c for c in wide.columns if c not in narrow.columns]


def _hash_sums(df: DataFrame, key: str, shared: Sequence[str], name: str) -> DataFrame:
    """Rows and summed row hashes per range of the keys' hashes."""
    row = F.xxhash64(key, *shared).cast("decimal(20,0)")
    return df.groupBy(_leaf(key).alias("leaf")).agg(
        F.count("*").alias(f"n_{name}"), F.sum(row).alias(f"sum_{name}"))


def _leaf(key: str) -> Column:
    """Range of the key's hash, one of ``LEAVES``; -1 for keys that are NULL, which match nothing."""
    return F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(LEAVES))) \
        .cast("int")


def differing_leaves(a: DataFrame, b: DataFrame, key: str,
                     shared: Sequence[str]) -> tuple[list[int], int]:
    """Key ranges in which the tables differ, and the rows (of ``a``) in all others."""
    sums = _hash_sums(a, key, shared, "a").join(_hash_sums(b, key, shared, "b"), "leaf", "full")
    nodes = sums.collect()  # LEAVES + 1 rows at most

    far = [r.leaf for r in nodes if r.leaf < 0 or r.n_a != r.n_b or r.sum_a != r.sum_b]
    return far, sum(r.n_a for r in nodes if r.leaf not in set(far))


def variant_consistency(a: DataFrame, b: DataFrame, key: str, shared: Sequence[str]) -> DataFrame:
    """Rows, unmatched rows, and one mismatch count per shared column of two variants.

    Keys found on one side only are counted in ``unmatched``. Both tables are first reduced to sums
    of row hashes per key range; only rows of ranges whose sums differ are joined row by row, so
    equal tables are not joined at all.
    """
    far, equal = differing_leaves(a, b, key, shared)
    fields = ["n", "unmatched", *(f"mismatch_{c}" for c in shared)]
    if not far:
        return a.sparkSession.createDataFrame(
            [(equal, *[0] * (len(fields) - 1))], ", ".join(f"`{f}` long" for f in fields))

    def rows(df: DataFrame, mark: str) -> DataFrame:
        # a few leaves are named one by one; of many, all rows are joined
        some = df.where(_leaf(key).isin(far)) if len(far) <= FEW_LEAVES else df
        return some.select(key, F.lit(1).alias(f"_{mark}"),
                           *[F.col(c).alias(f"{mark}_{c}") for c in shared])

    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    rest = equal if len(far) <= FEW_LEAVES else 0
    return rows(a, "l").join(rows(b, "r"), key, "full").agg(
        (F.count("*") + rest).alias("n"), F.count_if(~both).alias("unmatched"),
        *[F.count_if(both & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).alias(f"mismatch_{c}")
          for c in shared])


def expect_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that do not have exactly one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n <> 1")


def expect_finite(df: DataFrame, key: Sequence[str], columns: Sequence[str],
                  low: float | None = None, high: float | None = None) -> DataFrame:
    """Values that are NULL, NaN, infinite or outside the open interval (low, high)."""
    cells = df.select(*key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns])))
    v = F.col("value")
    bad: Column = v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    if low is not None:
        bad = bad | (v <= low)
    if high is not None:
        bad = bad | (v >= high)
    return cells.where(bad)


def expect_equal(df: DataFrame, key: Sequence[str], a: Column, b: Column,
                 tolerance: float = 1e-12) -> DataFrame:
    close = F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
    return df.where(~close).select(*key, a.alias("left_value"), b.alias("right_value"))


def expect_iso_date(df: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Rows whose text is absent, empty or not a YYYY-MM-DD date."""
    text = F.col(column)
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    ok = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & parsed.isNotNull()
    return df.where(~F.coalesce(ok, F.lit(False))).select(
        *key, text.alias("value"),
        F.when(text.isNull() | (text == ""), "missing").otherwise("not a date").alias("problem"))
