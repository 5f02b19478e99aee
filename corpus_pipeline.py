"""The corpus pipeline: stages that each apply one operator to all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonewright.llm import language_id, near_duplicates, packing, pii, suffix_dedup
from tonewright.llm.shipping import ship
from tonewright.sources.workspace import materialize, temporary


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are null or have no letter, whether or not any document is labelled."""
    samples = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    judged = docs.select(
        F.struct(*docs.columns).alias("row"), language_id.language(F.col("text"), samples).alias("found")
    )
    return judged.where("found.letter").select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, one with the smallest id."""
    return near_duplicates.representatives(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that an earlier document has are cut out; what is left of a cut character goes."""
    others = [c for c in docs.columns if c != "text"]
    null = F.col("text").isNull().alias("__null_text")
    cleaned = suffix_dedup.remove_repeats(docs, (*others, null), as_text=True)
    text = F.when(~F.col("row.__null_text"), F.col("kept")).alias("text")
    return cleaned.select(*(text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    found = pii.find(docs, tuple(docs.columns))
    text = pii.masked(F.col("row.text"), F.col("spans")).alias("text")
    return found.select(*(text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces with their ids."""
    return packing.pack(docs)


def _sent(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage that first sends the package to the workers of its session."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", _sent(with_language)),
    ("near_duplicates", _sent(without_near_duplicates)),
    ("suffix_dedup", _sent(without_repeats)),
    ("pii", _sent(without_private_data)),
    ("packing", _sent(packed)),
]

#: Most stages have no form in SQL; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, lasting=True)
    return STAGES[-1][1](spark, docs, sf_dir)
