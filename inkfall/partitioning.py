"""Spreading inputs that a scan would leave to fewer tasks than there are cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows in at least as many partitions as there are cores; a larger input stays as it is scanned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
