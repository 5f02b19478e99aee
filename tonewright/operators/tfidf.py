"""TF-IDF on DataFrames.

A corpus has a ``doc_id``, a ``text`` and any further columns (label, name, bucket). Counting
happens inside each row, so documents never have to be put together again from single tokens:

* counted corpus: ``text`` replaced by ``counts``, an array of ``(term, tf)``
* weighted corpus: ``counts`` replaced by ``entries``, an array of ``(term, w)`` of length one
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.functions.binding import let
from tonewright.functions.text import Analyzer, analyzer
from tonewright.operators.blocks import DealtCorpus, DocumentBlocks, rewrite
from tonewright.operators.term_table import BROADCAST_LIMIT, TermTable
from tonewright.sources.workspace import materialize


def count_array(terms: Column) -> Column:
    """Distinct elements of an array with their counts, from the runs of its sorted form.

    Intermediate arrays are bound to lambda variables with :func:`let`. Were they columns, the
    optimizer could copy their whole computation into the lambdas that look things up in them,
    and repeat it for every element.
    """
    return let(F.sort_array(terms), _count_sorted)


def _count_sorted(ordered: Column) -> Column:
    placed = F.transform(ordered, lambda t, i: F.struct(t.alias("term"), i.alias("at")))
    starts = F.filter(
        placed, lambda r: (r["at"] == 0) | (F.get(ordered, r["at"] - 1) != r["term"])
    )

    def lengths(runs: Column) -> Column:
        def count(run: Column, i: Column) -> Column:
            end = F.coalesce(F.get(runs, i + 1)["at"], F.size(ordered))
            return F.struct(
                run["term"].alias("term"), (end - run["at"]).cast("bigint").alias("tf")
            )

        return F.transform(runs, count)

    return let(starts, lengths)


def count_terms(corpus: DataFrame, analyze: str | Analyzer = "unigram") -> DataFrame:
    """Counts the terms of each document within its row, without a shuffle."""
    counts = count_array(analyzer(analyze)(F.col("text")))
    return corpus.withColumn("counts", counts).drop("text")


def explode_counts(counted: DataFrame, outer: bool = False) -> DataFrame:
    """One row for each term of a document; ``outer`` keeps documents without terms."""
    return _explode(counted, "counts", "tf", outer)


def explode_entries(weighted: DataFrame, outer: bool = False) -> DataFrame:
    """Long form of a weighted corpus: one row for each non-zero weight."""
    return _explode(weighted, "entries", "w", outer)


def _explode(frame: DataFrame, values: str, number: str, outer: bool) -> DataFrame:
    # A plain explode makes the optimizer test the array for emptiness below the scan's
    # projections, where it is computed a second time. Dropping the empty rows afterwards does not.
    rows = frame.withColumn("item", F.explode_outer(values)).select(
        *_keys(frame, values), "item.term", f"item.{number}"
    )
    return rows if outer else rows.where("term IS NOT NULL")


def _keys(frame: DataFrame, values: str) -> list[str]:
    return [c for c in frame.columns if c != values]


def document_frequency(counted: DataFrame) -> DataFrame:
    """Number of documents that hold each term."""
    return (
        explode_counts(counted.select("counts"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def smooth_idf(df: Column, n: int) -> Column:
    return F.log((1 + F.lit(n)) / (1 + df)) + 1


@dataclass(frozen=True)
class Vocabulary:
    """Every term of the fitted documents: ``terms(term, df, idf)``, in no particular order.

    Terms are their own keys. A dense column index takes a sort, and only vectors need it: see
    :func:`tonewright.operators.vectors.index_terms`.
    """

    documents: int
    table: TermTable

    @property
    def terms(self) -> DataFrame:
        return self.table.frame

    @property
    def size(self) -> int:
        return self.table.rows


def fit_vocabulary(counted: DataFrame) -> Vocabulary:
    """Fits on a counted corpus. Documents without terms count as documents."""
    n = counted.count()
    terms = document_frequency(counted).withColumn("idf", smooth_idf(F.col("df"), n))
    return Vocabulary(n, TermTable.of(materialize(terms, "vocabulary")))


def weigh(counted: DataFrame, vocabulary: Vocabulary, fitted: bool = False) -> DataFrame:
    """TF-IDF weights of length one for each document.

    Terms outside the vocabulary are dropped before the length is taken. A document left without
    terms stays, with no entries. The regrouping by document is the only shuffle when the
    vocabulary is broadcast. ``fitted`` says that the vocabulary is that of these documents.
    """
    rows = vocabulary.table.attach(explode_counts(counted, outer=True), fitted=fitted)
    return _weighed(rows, _keys(counted, "counts"))


def _weighed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows ``(keys, term, tf, idf)`` put together by document, as weights of length one."""
    raw = F.col("tf") * F.col("idf")
    entry = F.when(F.col("idf").isNotNull(), F.struct("term", raw.alias("w")))
    grouped = rows.groupBy(*keys).agg(
        F.sqrt(F.sum(raw * raw)).alias("norm"), F.collect_list(entry).alias("raw")
    )
    unit = F.transform(
        "raw", lambda e: F.struct(e["term"].alias("term"), (e["w"] / F.col("norm")).alias("w"))
    )
    return grouped.select(*keys, unit.alias("entries"))


def weigh_dealt(
    counted: DealtCorpus, vocabulary: Vocabulary, limit: int = BROADCAST_LIMIT
) -> DealtCorpus:
    """As :func:`weigh`, for documents in blocks: written, and neither they nor their terms are moved.

    A vocabulary beyond ``limit`` bytes goes to the blocks, one row for each of their terms.
    """
    if vocabulary.table.size <= limit:
        return rewrite(counted, weigh(counted.frame, vocabulary), "block-weights")
    blocks = DocumentBlocks.over(counted, lambda f: explode_counts(f, outer=True))
    try:
        known = blocks.send(blocks.store(vocabulary.terms.select("term", "idf")), "idf")
        keys = _keys(counted.frame, "counts")
        return rewrite(counted, _weighed(known, keys), "block-weights")
    finally:
        blocks.close()


def fit_transform(
    corpus: DataFrame, analyze: str | Analyzer = "unigram"
) -> tuple[Vocabulary, DataFrame]:
    """Fitted vocabulary and weighted corpus. The text is analyzed once."""
    counted = materialize(count_terms(corpus, analyze), "counts")
    vocabulary = fit_vocabulary(counted)
    return vocabulary, weigh(counted, vocabulary)


def transform(
    corpus: DataFrame, vocabulary: Vocabulary, analyze: str | Analyzer = "unigram"
) -> DataFrame:
    """Weights of other documents, with the idf of the fitted ones."""
    return weigh(count_terms(corpus, analyze), vocabulary)


def rows_from_triples(triples: DataFrame) -> DataFrame:
    """Matrix cells ``(doc_id, idx, w)`` as one row of ``(idx, w)`` in column order each."""
    cells = F.sort_array(F.collect_list(F.struct("idx", "w")))
    return triples.groupBy("doc_id").agg(cells.alias("row"))


def dense_size_gb(rows: Column, columns: Column) -> Column:
    """Whole gigabytes a dense matrix of doubles would take.

    The number of cells may exceed 64 bits, so it is a decimal.
    """
    cells = rows.cast("decimal(19,0)") * columns.cast("decimal(18,0)")
    return F.floor(cells / F.lit(1 << 27).cast("decimal(10,0)")).cast("bigint")
