"""Session building and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "*", shuffle_partitions: int = 8,
                  app_name: str = "churnspark") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.legacy.javaCharsets", "true")  # files in cp949, euc-kr
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without one: it then gets a fresh
    temporary folder, which is also set as the checkpoint folder.
    """
    sc = spark.sparkContext
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or sc.getConf().get("spark.checkpoint.dir")
              or sc.getCheckpointDir())
    if folder is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="churnspark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a table that several later jobs read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
