"""Train a committee on buckets of the labeled documents and let it vote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.functions.text import Analyzer
from tonewright.operators.blocks import DealtCorpus, deal
from tonewright.operators.committee import (
    BUCKETS,
    TRAIN_BUCKETS,
    Committee,
    fit_committee,
    hard_vote,
    member_scores,
    soft_vote,
    with_bucket,
)
from tonewright.operators.evaluate import accuracy
from tonewright.operators.tfidf import (
    Vocabulary,
    count_terms,
    fit_transform,
    fit_vocabulary,
    weigh_dealt,
)
from tonewright.plans.train_predict import PreparedCorpus
from tonewright.sources.workspace import materialize


def bucketed_corpus(
    labeled: DataFrame, analyze: str | Analyzer = "unigram", buckets: int = BUCKETS
) -> tuple[Vocabulary, DataFrame]:
    vocabulary, weighted = fit_transform(labeled, analyze)
    return vocabulary, materialize(with_bucket(weighted, buckets), "bucketed")


def _entries(counted: DataFrame) -> int:
    return counted.agg(F.sum(F.greatest(F.size("counts"), F.lit(1)))).first()[0] or 0


def dealt_corpus(
    counted: DataFrame, vocabulary: Vocabulary, total: int | None = None
) -> DealtCorpus:
    """The weighted documents in blocks, as many as ``total`` entries take.

    They go to their blocks as counts, the smallest form that they have, and are weighed there.
    """
    counts = deal(counted, _entries(counted) if total is None else total, "block-counts")
    weighted = weigh_dealt(counts, vocabulary)
    counts.discard()
    return weighted


def committee_of(
    labeled: DataFrame, analyze: str | Analyzer = "unigram", models: int = TRAIN_BUCKETS
) -> tuple[Committee, DealtCorpus]:
    """The committee after its second round, and the corpus it came from, in blocks."""
    counted = materialize(count_terms(labeled, analyze), "counts")
    vocabulary = fit_vocabulary(counted)
    rows = dealt_corpus(with_bucket(counted), vocabulary)
    return fit_committee(rows, vocabulary, models), rows


def vote_on_holdout(labeled: DataFrame, vote=soft_vote, models: int = TRAIN_BUCKETS) -> DataFrame:
    """Votes on the documents of the buckets held out."""
    committee, rows = committee_of(labeled, models=models)
    return _votes(rows, committee, vote, F.col("bucket") >= models)


def vote_on_all(labeled: DataFrame, vote=hard_vote) -> DataFrame:
    """Votes on every document, those trained on too."""
    committee, rows = committee_of(labeled)
    return _votes(rows, committee, vote)


def vote_on_unlabeled(corpus: PreparedCorpus, vote=hard_vote) -> DataFrame:
    """Votes of the whole committee on the documents without a label.

    Both corpora lie in as many blocks, so that the committee's sums are where the second one looks them up.
    """
    total = max(_entries(corpus.labeled), _entries(corpus.unlabeled))
    rows = dealt_corpus(with_bucket(corpus.labeled), corpus.vocabulary, total)
    committee = fit_committee(rows, corpus.vocabulary, TRAIN_BUCKETS)
    rows.discard()
    return _votes(dealt_corpus(corpus.unlabeled, corpus.vocabulary, total), committee, vote)


def _votes(rows: DealtCorpus, committee: Committee, vote, chosen: Column | None = None) -> DataFrame:
    """Votes on the chosen documents; the tables are in the catalog no longer than needed."""
    voted = vote(member_scores(rows if chosen is None else rows.where(chosen), committee))
    rows.close()
    committee.close()
    return voted


def voted_accuracy(labeled: DataFrame) -> DataFrame:
    """Accuracy of the soft vote on the documents held out."""
    return accuracy(vote_on_holdout(labeled))


def resubstitution_accuracy(labeled: DataFrame) -> DataFrame:
    """Accuracy of the hard vote on every document."""
    return accuracy(vote_on_all(labeled))
