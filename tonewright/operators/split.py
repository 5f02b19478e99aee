"""Splits and buckets that stay the same from run to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable_bucket(key: Column, buckets: int) -> Column:
    """Bucket 0 … buckets-1 from a hash of the key.

    Unlike a drawn number it does not change when a lost partition is computed again, so a
    document can never land on both sides of a split.
    """
    head = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % buckets).cast("int")


def is_train(key: Column, percent: int = 60) -> Column:
    return stable_bucket(key, 100) < percent


def holdout_split(rows: DataFrame, percent: int = 60) -> tuple[DataFrame, DataFrame]:
    train = is_train(F.col("doc_id"), percent)
    return rows.where(train), rows.where(~train)


def random_split(
    rows: DataFrame, train: float = 0.6, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split, for callers that want it; repeatable on stored rows only."""
    first, second = rows.randomSplit([train, 1 - train], seed)
    return first, second
