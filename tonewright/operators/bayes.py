"""Multinomial Naive Bayes for two classes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.operators.scoring import document_sums, score_counts, score_entries
from tonewright.operators.term_table import BROADCAST_LIMIT, TermTable
from tonewright.operators.tfidf import Vocabulary, explode_counts, explode_entries
from tonewright.sources.workspace import materialize, materialize_parts

# What the length of a document takes in a hashed relation, about.
_LENGTH_BYTES = 64


@dataclass(frozen=True)
class NaiveBayes:
    """Log priors, and ``table(term, df, idf, theta0, theta1)`` of log likelihoods."""

    pi: tuple[float, float]
    table: TermTable


def class_sums(weighted: DataFrame, train: Column) -> DataFrame:
    """Summed weight of each term in each class of the training rows.

    Rows outside the training part add nothing, but their terms get a row, so the result covers
    the vocabulary without a join to it.
    """
    part = F.when(train, F.col("label"))
    rows = explode_entries(weighted.withColumn("part", part))
    return rows.groupBy("term").agg(
        *(
            F.sum(F.when(F.col("part") == c, F.col("w")).otherwise(0.0)).alias(f"s{c}")
            for c in (0, 1)
        )
    )


def class_sums_of_counts(
    counted: DataFrame, vocabulary: Vocabulary, limit: int = BROADCAST_LIMIT
) -> Iterator[DataFrame]:
    """As :func:`class_sums` for the fitted documents as counts, with ``df`` and ``idf``, a frame for each part
    of the vocabulary.

    Weights are not put together by document: the length of each document comes to its counts, and the
    idf of a term, the same in all of its weights, meets their sum.
    """
    keys = [c for c in counted.columns if c != "counts"]
    norms = document_sums(counted, vocabulary.table, limit=limit, fitted=True).drop("n_terms")
    norms = materialize(norms, "lengths")
    if _LENGTH_BYTES * norms.count() <= limit:
        norms = F.broadcast(norms)
    same = [counted[c].eqNullSafe(norms[c]) for c in keys]
    known = counted.join(norms, same).select(counted["label"], counted["counts"], "norm")
    unit = F.col("tf") / F.col("norm")
    of = [F.sum(F.when(F.col("label") == c, unit).otherwise(0.0)).alias(f"s{c}") for c in (0, 1)]
    for part, take in vocabulary.table.parts(limit):
        sums = take(explode_counts(known)).groupBy("term").agg(*of)
        scaled = [(F.col(f"s{c}") * F.col("idf")).alias(f"s{c}") for c in (0, 1)]
        yield part.frame.join(sums, "term").select("term", "df", "idf", *scaled)


def fit_naive_bayes(
    weighted: DataFrame,
    vocabulary: Vocabulary,
    smoothing: float = 1.0,
    train: Column | None = None,
    documents: DataFrame | None = None,
    limit: int = BROADCAST_LIMIT,
) -> NaiveBayes:
    """Fits on a weighted corpus with labels, or on the part of it that ``train`` selects.

    Documents without terms count for the priors. ``documents`` are the same documents in a form that
    is cheaper to count, such as counted rows: a weighted corpus that isn't stored would be weighed once
    more for its class sizes. If they are counted rows and the vocabulary, which must be theirs, is beyond
    ``limit`` bytes, the sums are taken from them, a part of the vocabulary at a time.
    """
    counts = documents if train is None and documents is not None and "counts" in documents.columns else None
    train = F.lit(True) if train is None else train
    n = [F.count(F.when(train & (F.col("label") == c), 1)).alias(f"n{c}") for c in (0, 1)]
    sizes = (weighted if documents is None else documents).agg(*n).first()
    if counts is not None and vocabulary.table.size > limit:
        known = sums = materialize_parts(class_sums_of_counts(counts, vocabulary, limit), "class-sums")
    else:
        sums = materialize(class_sums(weighted, train), "class-sums")
        known = vocabulary.terms.join(sums, "term")
    totals = sums.agg(F.sum("s0").alias("s0"), F.sum("s1").alias("s1")).first()

    both = sizes["n0"] + sizes["n1"]
    pi = tuple(
        math.log(sizes[f"n{c}"] + smoothing) - math.log(both + 2 * smoothing) for c in (0, 1)
    )
    theta = [
        F.log(F.col(f"s{c}") + smoothing)
        - F.lit(math.log((totals[f"s{c}"] or 0.0) + vocabulary.size * smoothing))
        for c in (0, 1)
    ]
    model = known.select("term", "df", "idf", theta[0].alias("theta0"), theta[1].alias("theta1"))
    # Sums that already lie with their terms are made likelihoods wherever they are read.
    return NaiveBayes(pi, TermTable.of(model if known is sums else materialize(model, "naive-bayes")))


def _decide(scored: DataFrame, model: NaiveBayes, drop_empty: bool) -> DataFrame:
    """Class of the larger score; class 0 when they are equal."""
    score0 = F.col("theta0") + model.pi[0]
    score1 = F.col("theta1") + model.pi[1]
    kept = scored.where("n_terms > 0") if drop_empty else scored
    return (
        kept.withColumn("score0", score0)
        .withColumn("score1", score1)
        .withColumn("prediction", F.when(F.col("score1") > F.col("score0"), 1.0).otherwise(0.0))
        .drop("theta0", "theta1", "n_terms")
    )


def predict(weighted: DataFrame, model: NaiveBayes, drop_empty: bool = False) -> DataFrame:
    """Predictions for a weighted corpus.

    ``drop_empty`` leaves out documents without a known term instead of giving them the class
    with the larger prior.
    """
    scored = score_entries(weighted, model.table, "theta0", "theta1")
    return _decide(scored, model, drop_empty)


def predict_counts(counted: DataFrame, model: NaiveBayes, drop_empty: bool = False) -> DataFrame:
    """Predictions for a counted corpus, weighed and scored in one pass."""
    scored = score_counts(counted, model.table, "theta0", "theta1")
    return _decide(scored, model, drop_empty)
