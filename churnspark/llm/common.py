"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.session import shared_folder

#: Java / RE2 class of a word's characters: anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, under this application's own."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Deletes every table that this application's operators wrote on the way.

    Results are read from such tables, so call it when the last of them was read or written
    elsewhere.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the table to the shared folder and reads it back: cuts lineage, prunes columns."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame) -> DataFrame:
    """The two columns the operators need; a null text becomes empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
