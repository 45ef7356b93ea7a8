"""Readers: raw snapshots, split tables, metric tables, stored models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.contracts import Roles, raw_schema
from churnspark.functions.columns import nan_to_null

# Texts a CSV reader treats as missing.
NA_TOKENS = ("", "#N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Encodings Spark reads without further settings.
SPARK_CHARSETS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def missing_to_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """NaN in numbers and missing-value texts in strings become NULL."""
    fixed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            fixed[f.name] = nan_to_null(f.name)
        elif isinstance(f.dataType, T.StringType):
            fixed[f.name] = F.when(~F.col(f.name).isin(list(tokens)), F.col(f.name))
    return df.withColumns(fixed) if fixed else df


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             encoding: str = "utf-8", sep: str = ",",
             na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """CSV with header. With a schema, columns are matched by header name.

    Values are read as text first, so that every missing-value token is known
    before the cast; a text that is no number fails the read instead of
    turning into NULL silently.
    """
    if (encoding.lower() not in SPARK_CHARSETS
            and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true"):
        raise ValueError(f"{encoding} needs a session with spark.sql.legacy.javaCharsets=true")
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
    raw = reader.csv(path if isinstance(path, str) else list(path))
    if schema is None:
        return missing_to_null(raw, na_tokens)
    absent = [f.name for f in schema.fields if f.name not in raw.columns]
    if absent:
        raise ValueError(f"required columns missing: {absent}")
    text = raw.select(*[F.col(f"`{f.name}`") for f in schema.fields])
    text = missing_to_null(text, na_tokens)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                         for f in schema.fields])


def read_raw_csv(spark: SparkSession, path: str, roles: Roles, **options) -> DataFrame:
    return read_csv(spark, path, raw_schema(roles), **options)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return missing_to_null(spark.read.parquet(path))


def feature_list(df: DataFrame, target: str, drop: Sequence[str] = ()) -> list[str]:
    """Feature names and order from the schema; no data is read."""
    return [c for c in df.columns if c != target and c not in drop]


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def tail(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(n)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Union of all parts, or None unless every one exists."""
    if not all(path_exists(spark, p) for p in paths):
        return None
    return union_parts([spark.read.parquet(p) for p in paths])


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A table written by split; naming one reads its folder only."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def row_hash(df: DataFrame) -> DataFrame:
    """SHA-256 of each row; a cell is its length and its text, or a mark for NULL."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    cells = [F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return df.select(F.sha2(F.concat(*cells), 256).alias("h"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content fingerprint: row count and sum of row hashes.

    All 256 bits count: four slices of each row hash are added as exact decimals.
    """
    sums = [F.coalesce(F.sum(F.conv(F.substring("h", at, 16), 16, 10).cast("decimal(20,0)"))
                       .cast("decimal(38,0)"), F.lit(0)).cast("string")
            for at in (1, 17, 33, 49)]
    return row_hash(df).agg(F.count("*").alias("n_rows"),
                            F.concat_ws("-", *sums).alias("hash_sum"))


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 per file of a folder or pattern."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
