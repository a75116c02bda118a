"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the input has fewer partitions than cores.

    For CPU-heavy per-row work (tokenising text) right after a scan of a few
    large row groups, where a single task would otherwise do all the work. On a
    big input (thousands of files) the scan already has far more partitions than
    cores and the DataFrame is returned unchanged: no extra shuffle at scale.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
