"""Tables with one row for each term, and how they meet the rows of a corpus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonewright.sources.workspace import materialize, temporary

# Largest table to send to every executor, in bytes.
BROADCAST_LIMIT = 256 << 20
# A term in more than one of this many rows is split before a shuffle join.
HOT_SHARE = 1000
# Rows that one part of a large table is for, about, and the most parts.
PART_ROWS = 1_000_000
MOST_PARTS = 8
# What a row takes in a hashed relation besides its term.
_ROW_OVERHEAD = 96


def numbered(dealt: DataFrame, name: str) -> DataFrame:
    """The rows of a dealt out table, written, with ``idx``: numbers from 0 without gaps.

    A running number over all rows would sort them in one task. Here the rows are numbered within
    each partition in the order of their terms, and shifted by the sizes of the partitions before
    it. Only those sizes, one row for each partition, are ever in one place.
    """
    terms = materialize(dealt.withColumn("part", F.spark_partition_id()), name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = terms.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("term"))
    placed = terms.withColumn("place", place).join(F.broadcast(starts), "part")
    return placed.withColumn("idx", F.col("start") + F.col("place") - 1).drop("part", "place", "start")


@dataclass(frozen=True)
class TermTable:
    """A written table unique on ``term`` with the number of documents ``df`` of each term.

    ``size`` and ``total`` are measured on the written table, so the choice of join rests on what
    is there and not on an estimate made before the data was seen.
    """

    frame: DataFrame
    rows: int
    size: int
    total: int

    @staticmethod
    def of(frame: DataFrame, extra: Column | None = None) -> TermTable:
        """Measures a table; ``extra`` is the bytes of a row beyond its term and plain numbers."""
        chars = F.octet_length("term")
        seen = frame.agg(
            F.count("*").alias("rows"),
            F.sum(chars if extra is None else chars + extra).alias("chars"),
            F.sum("df").alias("total"),
        )
        return TermTable.measured(frame, seen.first().asDict())

    @staticmethod
    def measured(frame: DataFrame, seen: dict) -> TermTable:
        """A table whose number of rows, term bytes and sum of ``df`` are already known."""
        rows = seen["rows"]
        width = 8 * (len(frame.columns) - 1) + _ROW_OVERHEAD
        return TermTable(frame, rows, (seen["chars"] or 0) + width * rows, seen["total"] or 0)

    def attach(
        self,
        rows: DataFrame,
        spread: str = "doc_id",
        how: str = "left",
        limit: int = BROADCAST_LIMIT,
        drop: tuple[str, ...] = ("df",),
        fitted: bool = False,
    ) -> DataFrame:
        """Joins the columns of this table to rows that have a ``term``.

        A table within the limit is broadcast and the rows stay where they are. A larger one is
        joined by shuffle. Common terms would then send a large part of the rows to one task, so
        each term gets as many salts as it has shares of ``1 / HOT_SHARE`` of the rows, and its row
        is copied once for each. Fewer than ``HOT_SHARE`` terms can have more than one salt, which
        bounds both the copies and the list of salts that is broadcast. Rows without a term match
        nothing and are scattered.

        The shares are counted in the rows themselves, since terms may be common there that are rare
        or unknown in the documents of this table. ``fitted`` says that the rows are those
        documents, so that ``df`` has the counts already.
        """
        if self.size <= limit:
            return rows.join(F.broadcast(self.frame.drop(*drop)), "term", how)
        hot = self._hot(self.frame.select("term", F.col("df").alias("n")), self.total)
        if not fitted:
            counts = rows.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n"))
            with temporary(rows.sparkSession):
                counts = materialize(counts, "row-counts")
                hot = self._hot(counts, counts.agg(F.sum("n")).first()[0] or 0)
                hot = materialize(hot, "common-terms", lasting=True)
        unmatched = F.when(F.col("term").isNull(), HOT_SHARE).otherwise(1)
        salted = rows.join(F.broadcast(hot), "term", "left").withColumn(
            "salt",
            F.pmod(F.xxhash64(spread), F.coalesce(F.col("salts"), unmatched)).cast("int"),
        )
        copies = self.frame.join(F.broadcast(hot), "term", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
        )
        met = salted.drop("salts").join(copies.drop("salts", *drop), ["term", "salt"], how)
        return met.drop("salt")

    def parts(self, limit: int = BROADCAST_LIMIT) -> list[tuple[TermTable, Callable[[DataFrame], DataFrame]]]:
        """The table in parts by a hash of the term, each with a function that takes the part's rows of a
        corpus. Rows without a term are in the first part.

        What a join by shuffle writes grows with the rows. One part after the other, it writes a fraction at
        a time, and the rows are read as often. A table within ``limit`` is one part.
        """
        n = 1 if self.size <= limit else min(MOST_PARTS, max(1, -(-self.total // PART_ROWS)))
        if n == 1:
            return [(self, lambda rows: rows)]

        def taken(i: int) -> Callable[[DataFrame], DataFrame]:
            part = F.pmod(F.xxhash64(F.lit("part"), "term"), F.lit(n))
            part = F.when(F.col("term").isNull(), 0).otherwise(part)
            return lambda rows: rows.where(part == i)

        takes = [taken(i) for i in range(n)]
        of = [TermTable(take(self.frame), self.rows // n, self.size // n, self.total // n) for take in takes]
        return list(zip(of, takes, strict=True))

    @staticmethod
    def _hot(counts: DataFrame, total: int) -> DataFrame:
        """Terms in more rows than one share, fewer than ``HOT_SHARE``, and their salts."""
        share = max(total // HOT_SHARE, 1)
        salts = (F.floor(F.col("n") / share) + 1).cast("int")
        return counts.where(F.col("n") > share).select("term", salts.alias("salts"))
