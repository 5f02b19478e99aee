"""The classifier of ``pyspark.ml`` that the tests and the vector query compare with.

It trains on vectors, see :mod:`tonewright.operators.vectors`.
"""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame


def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(smoothing=smoothing)


def predict(model, vectors: DataFrame) -> DataFrame:
    """Predictions without the columns that only the estimator uses."""
    return model.transform(vectors).drop("features", "rawPrediction", "probability")
