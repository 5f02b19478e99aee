"""Train on one part of the labeled documents, measure on the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.functions.text import Analyzer
from tonewright.operators.bayes import fit_naive_bayes, predict
from tonewright.operators.evaluate import accuracy
from tonewright.operators.linear import fit_gradient_descent, predict_linear
from tonewright.operators.split import is_train
from tonewright.operators.tfidf import Vocabulary, count_terms, fit_vocabulary, weigh
from tonewright.operators.trees import TreeModel, fit_boosting, fit_forest, predict_trees
from tonewright.sources.workspace import materialize


def weighted_corpus(
    labeled: DataFrame,
    analyze: str | Analyzer = "unigram",
    fit_on: str = "all",
    train: Column | None = None,
) -> tuple[Vocabulary, DataFrame]:
    """Vocabulary and stored weights of a labeled corpus.

    With ``fit_on="all"`` document frequencies include the documents held out, which is how the
    accuracy has been measured so far; ``"train"`` leaves them out.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on is 'all' or 'train', not {fit_on!r}")
    counted = materialize(count_terms(labeled, analyze), "counts")
    train = is_train(F.col("doc_id")) if train is None else train
    vocabulary = fit_vocabulary(counted if fit_on == "all" else counted.where(train))
    return vocabulary, materialize(weigh(counted, vocabulary), "weights")


def bayes_predictions(vocabulary: Vocabulary, weighted: DataFrame) -> DataFrame:
    train = is_train(F.col("doc_id"))
    model = fit_naive_bayes(weighted, vocabulary, train=train)
    return predict(weighted.where(~train), model)


def linear_predictions(weighted: DataFrame, loss: str, iterations: int) -> DataFrame:
    train = is_train(F.col("doc_id"))
    model = fit_gradient_descent(weighted.where(train), loss, iterations)
    return predict_linear(weighted.where(~train), model)


def fit_trees(vocabulary: Vocabulary, weighted: DataFrame, kind: str, **options) -> TreeModel:
    if kind == "forest":
        return fit_forest(weighted, vocabulary.size, **options)
    return fit_boosting(weighted, **options)


def tree_predictions(
    vocabulary: Vocabulary, weighted: DataFrame, kind: str, **options
) -> DataFrame:
    """Predictions of a ``forest`` or of ``boosting`` for the documents held out."""
    train = is_train(F.col("doc_id"))
    model = fit_trees(vocabulary, weighted.where(train), kind, **options)
    return predict_trees(weighted.where(~train), model)


def bayes_accuracy(
    labeled: DataFrame, analyze: str | Analyzer = "unigram", fit_on: str = "all"
) -> DataFrame:
    return accuracy(bayes_predictions(*weighted_corpus(labeled, analyze, fit_on)))


def linear_accuracy(
    labeled: DataFrame,
    loss: str,
    iterations: int = 100,
    analyze: str | Analyzer = "unigram",
    fit_on: str = "all",
) -> DataFrame:
    _, weighted = weighted_corpus(labeled, analyze, fit_on)
    return accuracy(linear_predictions(weighted, loss, iterations))


def tree_accuracy(
    labeled: DataFrame,
    kind: str,
    analyze: str | Analyzer = "unigram",
    fit_on: str = "all",
    **options,
) -> DataFrame:
    vocabulary, weighted = weighted_corpus(labeled, analyze, fit_on)
    return accuracy(tree_predictions(vocabulary, weighted, kind, **options))
