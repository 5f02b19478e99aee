"""Scores of documents as sums over their terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonewright.operators.term_table import BROADCAST_LIMIT, TermTable
from tonewright.operators.tfidf import explode_counts, explode_entries
from tonewright.sources.workspace import materialize_parts


def score_entries(weighted: DataFrame, table: TermTable, *columns: str) -> DataFrame:
    """Weighted sum of each column of a term table, and the number of entries, by document."""
    keys = [c for c in weighted.columns if c != "entries"]
    rows = table.attach(explode_entries(weighted, outer=True))
    sums = [F.coalesce(F.sum(F.col("w") * F.col(c)), F.lit(0.0)).alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*sums, F.count("w").alias("n_terms"))


def document_sums(
    counted: DataFrame, table: TermTable, *columns: str, limit: int = BROADCAST_LIMIT, fitted: bool = False
) -> DataFrame:
    """Sum of ``tf * idf`` times each column, ``norm`` and ``n_terms`` by document.

    A table beyond ``limit`` bytes meets the rows in parts, whose sums are written and added up: what is
    shuffled at once is a part of the rows. ``fitted``: see :meth:`TermTable.attach`.
    """
    keys = [c for c in counted.columns if c != "counts"]
    exploded = explode_counts(counted, outer=True)
    raw = F.col("tf") * F.col("idf")
    sums = [F.sum(raw * F.col(c)).alias(c) for c in columns]
    sums += [F.sum(raw * raw).alias("square"), F.count("idf").alias("n_terms")]
    parts = table.parts(limit)
    each = (
        part.attach(take(exploded), limit=limit, fitted=fitted).groupBy(*keys).agg(*sums) for part, take in parts
    )
    if len(parts) == 1:
        totals = next(each)
    else:
        whole = [F.sum(c).alias(c) for c in (*columns, "square", "n_terms")]
        totals = materialize_parts(each, "part-sums").groupBy(*keys).agg(*whole)
    return totals.select(*keys, *columns, F.sqrt("square").alias("norm"), "n_terms")


def score_counts(
    counted: DataFrame, table: TermTable, *columns: str, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """As :func:`score_entries`, straight from counts and a table that also has the ``idf``.

    The length of a document divides out of the sum, so weighing and scoring take one join and
    one aggregation with small partial results instead of two of each.
    """
    keys = [c for c in counted.columns if c != "counts"]
    totals = document_sums(counted, table, *columns, limit=limit)
    units = [F.coalesce(F.col(c) / F.col("norm"), F.lit(0.0)).alias(c) for c in columns]
    return totals.select(*keys, *units, "n_terms")
