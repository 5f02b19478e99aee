"""Train on everything that is labeled, predict everything that is not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tonewright.functions.text import Analyzer
from tonewright.operators.bayes import fit_naive_bayes, predict_counts
from tonewright.operators.linear import fit_gradient_descent, predict_linear_counts
from tonewright.operators.tfidf import (
    Vocabulary,
    count_terms,
    fit_vocabulary,
    weigh,
)
from tonewright.operators.trees import predict_trees
from tonewright.plans.holdout import fit_trees
from tonewright.sources.files import write_predictions
from tonewright.sources.tables import with_label_if_known
from tonewright.sources.workspace import materialize, temporary

CLASSIFIERS = ("bayes", "svm", "logistic", "forest", "boosting")


@dataclass(frozen=True)
class PreparedCorpus:
    """Counted rows of both kinds, and the vocabulary and weights of the labeled ones."""

    labeled: DataFrame
    unlabeled: DataFrame
    vocabulary: Vocabulary
    weighted: DataFrame


def prepare(
    labeled: DataFrame, unlabeled: DataFrame, analyze: str | Analyzer = "unigram"
) -> PreparedCorpus:
    """For two corpora: ``labeled`` with a label, ``unlabeled`` with a name."""
    return _prepared(
        materialize(count_terms(labeled, analyze), "labeled"),
        materialize(count_terms(unlabeled, analyze), "unlabeled"),
    )


def prepare_tables(
    documents: DataFrame, labels: DataFrame, analyze: str | Analyzer = "unigram"
) -> PreparedCorpus:
    """For one corpus of which some documents have a label.

    All texts are analyzed in one pass, and the labels meet the counts instead of the texts.
    """
    counted = with_label_if_known(count_terms(documents, analyze), labels)
    stored = materialize(counted, "counted")
    return _prepared(stored.where("label IS NOT NULL"), stored.where("label IS NULL").drop("label"))


def _prepared(labeled: DataFrame, unlabeled: DataFrame) -> PreparedCorpus:
    vocabulary = fit_vocabulary(labeled)
    return PreparedCorpus(labeled, unlabeled, vocabulary, weigh(labeled, vocabulary, fitted=True))


def train_and_predict(
    corpus: PreparedCorpus, classifier: str = "bayes", drop_empty: bool = False, **options
) -> DataFrame:
    """Class of each unlabeled document, in ``prediction``."""
    if classifier == "bayes":
        model = fit_naive_bayes(
            corpus.weighted, corpus.vocabulary, documents=corpus.labeled, **options
        )
        return predict_counts(corpus.unlabeled, model, drop_empty)
    if classifier in ("svm", "logistic"):
        loss = "hinge" if classifier == "svm" else "logistic"
        model = fit_gradient_descent(corpus.weighted, loss, **options)
        return predict_linear_counts(corpus.unlabeled, corpus.vocabulary, model, drop_empty)
    if classifier not in CLASSIFIERS:
        raise ValueError(f"no such classifier: {classifier}")
    unlabeled = weigh(corpus.unlabeled, corpus.vocabulary)
    model = fit_trees(corpus.vocabulary, corpus.weighted, classifier, **options)
    return predict_trees(unlabeled, model, drop_empty)


def run(
    labeled: DataFrame,
    unlabeled: DataFrame,
    output: str,
    classifier: str = "bayes",
    analyze: str | Analyzer = "unigram",
    **options,
) -> None:
    """The whole job: two corpora in, a folder of ``name,prediction`` lines out.

    The tables written on the way are deleted once the lines are there.
    """
    with temporary(labeled.sparkSession):
        predicted = train_and_predict(prepare(labeled, unlabeled, analyze), classifier, **options)
        write_predictions(predicted, output)
