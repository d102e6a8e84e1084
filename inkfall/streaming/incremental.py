"""Incremental runs: only new files, and running summaries of usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_files(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str) -> None:
    """Append what came into ``folder`` since the last call to ``out``; the checkpoint keeps what was read."""
    query = spark.readStream.schema(schema).parquet(folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def running_usage(stream: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Requests and tokens per stage and time window of a usage stream (ts, stage, tokens); later rows than ``late`` are left out."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window), "stage").agg(F.count("*").alias("requests"), F.sum("tokens").alias("tokens"))
