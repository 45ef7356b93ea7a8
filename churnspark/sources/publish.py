"""Publication of a table in one step: readers see the old version or the new one, never a mixture.

A version is written to a folder of its own, compared with its source by row hashes, described by a
manifest, and only then named in a small pointer file that is put in place by one rename.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.sources.tables import path_exists, table_fingerprint

POINTER = "CURRENT"


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target, files = _hadoop(spark, path)
    out = files.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def _switch(spark: SparkSession, target: str, version: str) -> None:
    """Points readers to a version; the rename replaces the old pointer at once."""
    fresh = f"{target}/{POINTER}-{version}"
    _write_text(spark, fresh, version)
    jvm = spark._jvm
    source, files = _hadoop(spark, fresh)
    place, _ = _hadoop(spark, f"{target}/{POINTER}")
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()).rename(source, place, how)


def parts_of(df: DataFrame, by: str | None) -> list[dict]:
    """Rows and hash sum of each part (each value of ``by``, a few), order-insensitive."""
    if by is None:
        return [{"part": None, **table_fingerprint(df).first().asDict()}]
    found = [r[0] for r in df.select(by).distinct().collect()]
    return [{"part": part, **table_fingerprint(df.where(F.col(by).eqNullSafe(F.lit(part)))
                                               .drop(by)).first().asDict()}
            for part in sorted(found, key=str)]


def publish(spark: SparkSession, source: str, target: str, by: str = "split") -> str:
    """Makes the table at ``source`` the current version of ``target``; refuses if it is absent.

    A failure at any point leaves readers with the version they had. Returns the new version.
    """
    if not path_exists(spark, source):
        raise FileNotFoundError(f"nothing to promote at {source}")
    df = spark.read.parquet(source)
    by = by if by in df.columns else None
    version = uuid4().hex
    path = f"{target}/versions/{version}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    written = spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    parts = parts_of(df, by)
    if parts_of(written, by) != parts:
        raise ValueError(f"the written version differs from {source}")
    before = current_version(spark, target)
    _write_text(spark, f"{target}/manifests/{version}.json",
                json.dumps({"version": version, "previous": before, "parts": parts}))
    _switch(spark, target, version)
    return version


def current_version(spark: SparkSession, target: str) -> str | None:
    pointer = f"{target}/{POINTER}"
    return spark.read.text(pointer).first().value if path_exists(spark, pointer) else None


def read_published(spark: SparkSession, target: str) -> DataFrame:
    version = current_version(spark, target)
    if version is None:
        raise FileNotFoundError(f"nothing was published at {target}")
    return spark.read.parquet(f"{target}/versions/{version}")


def manifest(spark: SparkSession, target: str) -> dict:
    """The manifest of the current version."""
    version = current_version(spark, target)
    return json.loads(spark.read.text(f"{target}/manifests/{version}.json", wholetext=True)
                      .first().value)
