"""Fitted vectorizers and committees that outlive their session and grow by batches.

What is stored are counts and sums, which add up: an update reads its batch and writes what the batch
adds, and never comes back to the documents trained on before. A version is the list of these parts.
Once there are more than ``MOST_PARTS`` of them they are added up into one, so that reading a version
takes work by the size of the model and not by the number of updates.

A batch has a name, and a version knows its batches. A batch that is sent again, because the job that
sent it was lost, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonewright.functions.text import Analyzer
from tonewright.operators.committee import (
    TRAIN_BUCKETS,
    Committee,
    committee_of_sums,
    term_statistics,
)
from tonewright.operators.term_table import TermTable
from tonewright.operators.tfidf import (
    Vocabulary,
    document_frequency,
    smooth_idf,
    transform,
)
from tonewright.sources import store
from tonewright.sources.workspace import materialize

MOST_PARTS = 8


def _grown(
    spark: SparkSession,
    folder: str,
    table: str,
    added: DataFrame,
    keys: tuple[str, ...],
    before: store.Version | None,
) -> list[str]:
    """Parts of the next version: those before and the added rows, added up if there are many."""
    part = store.write_part(added, folder, table)
    parts = [*(before.tables[table] if before else []), part]
    if len(parts) <= MOST_PARTS:
        return parts
    rows = spark.read.schema(added.schema).parquet(*(f"{folder}/{p}" for p in parts))
    return [store.write_part(_added_up(rows, keys), folder, table)]


def _added_up(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    numbers = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in numbers))


def _expect(before: store.Version | None, **facts) -> None:
    """A batch must have been made the way the version was."""
    for name, value in facts.items():
        if before and before.facts[name] != value:
            raise ValueError(f"the store has {name} {before.facts[name]!r}, the batch {value!r}")


# --- vectorizer ---------------------------------------------------------------------------------


def update_vocabulary(
    counted: DataFrame, folder: str, batch: str, analyze: str = "unigram"
) -> store.Version:
    """Adds the documents of a counted batch to the vocabulary in a folder, or begins one.

    ``analyze`` is the name of the analyzer that counted them; :func:`transform_stored` uses it again.
    """
    spark = counted.sparkSession
    before = store.latest(spark, folder)
    _expect(before, kind="vocabulary", analyze=analyze)
    if before and batch in before.facts["batches"]:
        return before
    added = document_frequency(counted)
    parts = _grown(spark, folder, "terms", added, ("term",), before)
    facts = {
        "kind": "vocabulary",
        "analyze": analyze,
        "documents": (before.facts["documents"] if before else 0) + counted.count(),
        "batches": [*(before.facts["batches"] if before else []), batch],
    }
    number = before.number + 1 if before else 1
    return store.commit(spark, folder, number, {"terms": parts}, {"terms": added.schema}, facts)


def load_vocabulary(spark: SparkSession, folder: str, number: int | None = None) -> Vocabulary:
    """The vocabulary of a version: the same as if it were fitted on all of its documents at once."""
    version = store.load(spark, folder, number)
    if version.facts["kind"] != "vocabulary":
        raise ValueError(f"{folder} holds a {version.facts['kind']}")
    n = version.facts["documents"]
    terms = _added_up(version.read(spark, "terms"), ("term",))
    weighed = terms.withColumn("idf", smooth_idf(F.col("df"), n))
    return Vocabulary(n, TermTable.of(materialize(weighed, "vocabulary")))


def transform_stored(
    corpus: DataFrame, folder: str, number: int | None = None, analyze: Analyzer | None = None
) -> DataFrame:
    """Weights of documents under a stored vectorizer, with the analyzer that it names.

    ``analyze`` is for vectorizers that were fitted with a function of the caller's.
    """
    spark = corpus.sparkSession
    named = store.load(spark, folder, number)
    vocabulary = load_vocabulary(spark, folder, named.number)
    return transform(corpus, vocabulary, analyze or named.facts["analyze"])


# --- committee ----------------------------------------------------------------------------------


def _class_counts(bucketed: DataFrame, models: int) -> dict[str, list[int]]:
    """Documents of each class in each training bucket; at most ``models`` rows."""
    n = [F.count(F.when(F.col("label") == c, 1)).alias(f"n{c}") for c in (0, 1)]
    rows = bucketed.where(F.col("bucket") < models).groupBy("bucket").agg(*n).collect()
    return {str(r["bucket"]): [r["n0"], r["n1"]] for r in rows}


def update_committee(
    bucketed: DataFrame,
    folder: str,
    batch: str,
    vocabulary: Vocabulary,
    models: int = TRAIN_BUCKETS,
) -> store.Version:
    """Adds a weighted batch with ``label`` and ``bucket`` to the committee in a folder, or begins one.

    All batches must be weighed with the same vocabulary, whose size is held against the store's.
    Sums are kept by bucket, so the rounds of training are decided when the committee is loaded.
    """
    spark = bucketed.sparkSession
    before = store.latest(spark, folder)
    _expect(before, kind="committee", models=models, terms=vocabulary.size)
    if before and batch in before.facts["batches"]:
        return before
    added = term_statistics(bucketed, models, rounds=1)
    parts = _grown(spark, folder, "sums", added, ("model_id", "term"), before)
    counts = dict(before.facts["counts"]) if before else {}
    for bucket, new in _class_counts(bucketed, models).items():
        old = counts.get(bucket, [0, 0])
        counts[bucket] = [old[0] + new[0], old[1] + new[1]]
    facts = {
        "kind": "committee",
        "models": models,
        "terms": vocabulary.size,
        "counts": counts,
        "batches": [*(before.facts["batches"] if before else []), batch],
    }
    number = before.number + 1 if before else 1
    return store.commit(spark, folder, number, {"sums": parts}, {"sums": added.schema}, facts)


def _trained_on(models: int, rounds: int) -> Column:
    """Models that a bucket's sums go to: its own, and in round two the one before it."""
    own = F.col("model_id")
    before = ((own + models - 1) % models).cast("int")
    return F.array(own, before) if rounds == 2 else F.array(own)


def load_committee(
    spark: SparkSession, folder: str, number: int | None = None, rounds: int = 2
) -> Committee:
    """The committee of a version: the same as if it were trained on all of its documents at once.

    Reads the sums only. A bucket without documents has no model.
    """
    version = store.load(spark, folder, number)
    if version.facts["kind"] != "committee":
        raise ValueError(f"{folder} holds a {version.facts['kind']}")
    models = version.facts["models"]
    own = {int(b): (n[0], n[1]) for b, n in version.facts["counts"].items()}
    counts = own
    if rounds == 2:
        partner = {b: own.get((b + 1) % models, (0, 0)) for b in own}
        counts = {b: (own[b][0] + partner[b][0], own[b][1] + partner[b][1]) for b in own}
    rows = version.read(spark, "sums").withColumn("model_id", F.explode(_trained_on(models, rounds)))
    rows = rows.where(F.col("model_id").isin(*counts)) if counts else rows.limit(0)
    sums = materialize(_added_up(rows, ("model_id", "term")), "committee-sums")
    return committee_of_sums(sums, counts, version.facts["terms"])
