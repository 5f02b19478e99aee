"""Predictions and how good they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def named_predictions(predicted: DataFrame) -> DataFrame:
    return predicted.select("name", "prediction")


def accuracy(predicted: DataFrame) -> DataFrame:
    """Share of predictions equal to the label; NULL when there is nothing to compare."""
    hit = (F.col("prediction").cast("double") == F.col("label")).cast("double")
    return predicted.agg(
        F.count("*").alias("n_test"),
        F.sum(hit.cast("bigint")).alias("n_correct"),
        F.avg(hit).alias("accuracy"),
    )
