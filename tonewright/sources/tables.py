"""Corpora kept as tables: ``documents(doc_id, text)`` and ``labels(doc_id, …)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonewright.sources.parallelism import spread

# Most labels to send to every executor, and about what one takes there.
LABELS_LIMIT = 256 << 20
_LABEL_BYTES = 64


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), "doc_id"
    )


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as documents."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return spread(
        pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")), "doc_id"
    )


def read_labels(spark: SparkSession, folder: str, target: str = "quality") -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet").select(
        "doc_id", F.col(target).cast("double").alias("label")
    )


def with_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that have a label, with it. Both sides have one row for each document."""
    return rows.join(labels, "doc_id")


def with_label_if_known(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows; the label is NULL for documents to be predicted.

    Labels within ``LABELS_LIMIT`` bytes are broadcast, since the rows hold whole documents and are many
    times as large as their labels.
    """
    if _LABEL_BYTES * labels.count() <= LABELS_LIMIT:
        labels = F.broadcast(labels)
    return rows.join(labels, "doc_id", "left")


def with_name(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the name of their document from ``names(doc_id, name)``."""
    return rows.join(names, "doc_id")
