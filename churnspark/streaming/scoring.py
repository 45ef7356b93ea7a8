"""Row-wise scoring and segmenting of customer streams.

Both jobs are stateless, so they run in append mode without watermark; the
models are loaded once per query and shipped inside the plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from churnspark.plans.serve import Bundle, score_customers


def customer_stream(spark: SparkSession, path: str, schema: StructType,
                    files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(stream: DataFrame, bundle: Bundle, target: str, checkpoint: str,
                 prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
                 once: bool = True) -> StreamingQuery:
    """Score arriving customers into Parquet; ``once`` stops after what is there."""
    scored = score_customers(prepare(stream), bundle)
    return write_stream(scored, target, checkpoint, once)


def write_stream(df: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", target).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime="30 seconds")).start()
