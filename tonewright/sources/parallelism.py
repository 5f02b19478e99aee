"""Enough tasks for the analysis of text, which costs far more than reading it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deals out the rows of a scan that has fewer splits than the cluster has slots.

    One large file with a single row group would otherwise be analyzed by one task. A scan with
    splits enough, which is any large one, is returned as it is and takes no shuffle.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= 2 * slots:
        return scan
    return scan.repartition(4 * slots, key)
