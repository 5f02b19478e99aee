"""Bigrams that occur together more often than their words would by chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.functions.text import sentence_terms
from tonewright.operators.term_table import BROADCAST_LIMIT, TermTable
from tonewright.sources.workspace import materialize


def count_pairs(corpus: DataFrame) -> DataFrame:
    """How often each term is followed by each other term of its sentence.

    Every term occurrence gives one row, the last one of a sentence with a NULL follower, so the
    counts of single terms can be had from this table without reading the text again.
    """
    sentence = corpus.select(F.explode_outer(sentence_terms(F.col("text"))).alias("terms"))
    pairs = F.transform(
        "terms", lambda t, i: F.struct(t.alias("first"), F.get("terms", i + 1).alias("second"))
    )
    rows = sentence.select(F.inline_outer(pairs)).where("first IS NOT NULL")
    return rows.groupBy("first", "second").agg(F.count("*").alias("n_pair"))


def count_singles(pairs: DataFrame) -> DataFrame:
    """Occurrences of each term, and in ``df`` the more numerous of its followers and leaders."""
    one, none = F.lit(1), F.lit(0)
    ends = F.array(
        F.struct(
            F.col("first").alias("term"),
            F.col("n_pair").alias("n"),
            one.alias("follows"),
            none.alias("leads"),
        ),
        F.struct(
            F.col("second").alias("term"),
            F.lit(0).cast("bigint").alias("n"),
            none.alias("follows"),
            one.alias("leads"),
        ),
    )
    return (
        pairs.select(F.inline(ends))
        .where("term IS NOT NULL")
        .groupBy("term")
        .agg(
            F.sum("n").alias("n"), F.greatest(F.sum("follows"), F.sum("leads")).alias("df")
        )
    )


def chi_square(n11: Column, first: Column, second: Column, total: Column) -> Column:
    """Chi-square of a two by two table, 0 when a margin is empty."""
    n12 = first - n11
    n21 = second - n11
    n22 = total - n11 - n12 - n21
    margins = (n11 + n12) * (n11 + n21) * (n12 + n22) * (n21 + n22)
    cross = n11 * n22 - n12 * n21
    return F.when(margins == 0, 0.0).otherwise(total * (cross * cross) / margins)


def score_bigrams(corpus: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Chi-square of every bigram of the corpus."""
    pairs = materialize(count_pairs(corpus), "pairs")
    singles = TermTable.of(materialize(count_singles(pairs), "singles"))
    total = singles.frame.agg(F.sum("n")).first()[0] or 0
    rows = pairs.where("second IS NOT NULL")
    with_first = singles.attach(
        rows.withColumnRenamed("first", "term"), spread="second", how="inner", limit=limit
    ).withColumnsRenamed({"term": "first", "n": "n_first"})
    with_both = singles.attach(
        with_first.withColumnRenamed("second", "term"), spread="first", how="inner", limit=limit
    ).withColumnsRenamed({"term": "second", "n": "n_second"})
    numbers = [F.col(c).cast("double") for c in ("n_pair", "n_first", "n_second")]
    return with_both.withColumn("chi_square", chi_square(*numbers, F.lit(float(total))))


def top_collocations(corpus: DataFrame, k: int = 300) -> DataFrame:
    """The ``k`` best bigrams. Scores equal to six places are ties and go by the words."""
    scored = score_bigrams(corpus).withColumn("chi_square", F.round("chi_square", 6))
    best = scored.orderBy(F.desc("chi_square"), "first", "second").limit(k)
    return best.select(
        F.concat_ws(" ", "first", "second").alias("bigram"), "n_pair", "chi_square"
    )
