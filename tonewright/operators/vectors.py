"""Sparse vectors for the estimators of ``pyspark.ml``."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tonewright.operators.term_table import TermTable, numbered
from tonewright.operators.tfidf import Vocabulary, explode_entries
from tonewright.sources.workspace import materialize

# ``pyspark.ml`` counts columns with 32 bits; tables of terms do not.
MOST_COLUMNS = (1 << 31) - 1


def index_terms(vocabulary: Vocabulary) -> TermTable:
    """Column number of each term in code-point order, from terms sorted in ranges."""
    ranged = vocabulary.terms.repartitionByRange("term").sortWithinPartitions("term")
    indexed = numbered(ranged, "term-ranges")
    return TermTable.of(materialize(indexed.select("term", "idx", "df", "idf"), "term-index"))


def to_vectors(weighted: DataFrame, index: TermTable) -> DataFrame:
    """Entries as a vector column, zeros implied.

    A vector is stored as a struct of its size, positions and values. The struct is built with
    built-in functions, and reading the written table with the vector type gives vectors without
    a Python function on the way.
    """
    if index.rows > MOST_COLUMNS:
        raise ValueError(f"a vector has at most {MOST_COLUMNS} columns, not {index.rows}")
    keys = [c for c in weighted.columns if c != "entries"]
    rows = index.attach(explode_entries(weighted, outer=True), drop=("df", "idf"))
    return _gathered(rows, keys, F.lit(index.rows))


def to_vector_blocks(weighted: DataFrame, index: TermTable, width: int = MOST_COLUMNS) -> DataFrame:
    """Entries as vectors of at most ``width`` columns: one row for each document and ``block`` of
    columns in which it has an entry.

    Column ``idx`` of the corpus is column ``idx % width`` of block ``idx // width``, so the number of
    terms has no bound. A document without entries has one empty vector, in block 0. Sums over the
    entries of a document (dot products, squared lengths) are sums over its blocks.
    """
    if not 0 < width <= MOST_COLUMNS:
        raise ValueError(f"a block has 1 to {MOST_COLUMNS} columns, not {width}")
    keys = [c for c in weighted.columns if c != "entries"]
    rows = index.attach(explode_entries(weighted, outer=True), drop=("df", "idf"))
    block = F.coalesce(F.expr(f"idx div {width}"), F.lit(0).cast("bigint"))
    placed = rows.withColumn("block", block).withColumn("idx", F.col("idx") % width)
    columns = F.least(F.lit(width).cast("bigint"), F.lit(index.rows) - F.col("block") * width)
    return _gathered(placed, [*keys, "block"], columns)


def _gathered(rows: DataFrame, keys: list[str], columns: Column) -> DataFrame:
    """Stored vectors of the rows ``(idx, w)`` of each key."""
    entry = F.when(F.col("w").isNotNull(), F.struct(F.col("idx").cast("int").alias("idx"), "w"))
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        columns.cast("int").alias("size"),
        F.col("entries.idx").alias("indices"),
        F.col("entries.w").alias("values"),
    )
    built = grouped.select(*keys, vector.alias("features"))
    fields = [built.schema[c] for c in keys] + [StructField("features", VectorUDT())]
    return materialize(built, "vectors", StructType(fields))


def digest(vector: Column) -> list[Column]:
    """What a sparse vector holds, in a few numbers that don't depend on the order of sums: its
    columns, its positions, and two sums over its values, one of them weighed by position."""
    stored = F.unwrap_udt(vector)
    pairs = F.arrays_zip(stored["indices"].alias("i"), stored["values"].alias("w"))
    plain = F.aggregate(stored["values"], F.lit(0.0), lambda a, w: a + w * w)
    placed = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + p["w"] * (p["i"] % 97 + 1))
    return [
        stored["size"].alias("n_columns"),
        F.size(stored["indices"]).alias("n_entries"),
        F.md5(F.array_join(stored["indices"].cast("array<string>"), ",")).alias("positions"),
        F.round(plain, 6).alias("squares"),
        F.round(placed, 6).alias("placed"),
    ]
