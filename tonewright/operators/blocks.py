"""Corpora that stay where they are while tables of terms come to them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec, Window
from pyspark.sql import functions as F

from tonewright.sources.workspace import (
    Buckets,
    delete,
    forget,
    materialize_buckets,
    materialize_dealt,
)


@dataclass(frozen=True)
class DealtCorpus:
    """A written corpus in blocks of documents, one row for each, with its ``block``.

    ``frame`` reads it, and groups that hold the block together find it so. ``kept`` is a condition
    on the rows, NULL for all of them.
    """

    table: Buckets
    blocks: int
    frame: DataFrame
    kept: Column | None = None

    def where(self, condition: Column) -> DealtCorpus:
        both = condition if self.kept is None else self.kept & condition
        return replace(self, frame=self.frame.where(condition), kept=both)

    def close(self) -> None:
        """Takes the table out of the catalog; its files stay until their scope ends."""
        forget(self.frame.sparkSession, self.table)

    def discard(self) -> None:
        """Deletes the table and its files; nothing may be read from it after."""
        self.close()
        delete(self.frame.sparkSession, self.table.path)


def _block_ids(spark: SparkSession, blocks: int) -> list[int]:
    """A number for each block, such that no two blocks are dealt to the same file."""
    numbers = spark.range(32 * blocks).select(F.col("id").cast("int"))
    places = numbers.groupBy(F.pmod(F.hash("id"), F.lit(blocks)).alias("place")).agg(F.min("id").alias("id"))
    return sorted(r["id"] for r in places.collect())


def blocks_for(spark: SparkSession, total: int) -> int:
    """Blocks of a corpus with ``total`` entries, about. Every block is sent its terms, so there are no more
    than keep the slots busy and their size in bounds."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-total // DocumentBlocks.ROWS))


def deal(corpus: DataFrame, total: int, name: str) -> DealtCorpus:
    """Moves the documents of a corpus to their blocks and writes them there.

    ``total`` is the number of entries in its rows, about, or in those of a larger corpus that is to
    have as many blocks.
    """
    spark = corpus.sparkSession
    blocks = blocks_for(spark, total)
    ids = _block_ids(spark, blocks)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(len(ids))).cast("int")
    block = F.get(F.array(*(F.lit(i) for i in ids)), place)
    table = materialize_buckets(corpus.withColumn("block", block), name, "block", blocks)
    return DealtCorpus(table, blocks, spark.table(table.name))


def rewrite(dealt: DealtCorpus, frame: DataFrame, name: str) -> DealtCorpus:
    """Writes rows made of a dealt corpus, which must still lie in their blocks, without moving them."""
    table = materialize_dealt(frame, name, "block", dealt.blocks)
    return DealtCorpus(table, dealt.blocks, dealt.frame.sparkSession.table(table.name))


# What a row takes in a hashed relation besides its term and columns.
_ROW_OVERHEAD = 96


class DocumentBlocks:
    """The rows of a corpus in blocks of documents, and the terms that each block has.

    Neither is moved after it has been written. A table of terms, once written by term, is looked
    up where the index of terms lies, and each block is sent one row for each of its terms; a block
    joins them to its rows and sums within its documents. Common terms need no salts, since each
    block gets its own copy of them.

    The layout is used by a session of its own, in which a join on block and term may rest on the
    blocks alone. ``rows`` has a ``doc_id`` and a ``term``; rows without a term match nothing and stay
    (see :meth:`send`). ``total`` is the number of rows, about.
    """

    #: Rows of a block, about.
    ROWS = 2_000_000

    def __init__(self, rows: DataFrame, total: int):
        slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = max(slots, -(-total // self.ROWS))
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
        self.tables: list[Buckets] = [materialize_buckets(dealt, "block-rows", "block", blocks)]
        self._open(rows.sparkSession, blocks)
        self.rows = self.session.table(self.tables[0].name)
        self._index()

    @classmethod
    def over(
        cls, dealt: DealtCorpus, exploded: Callable[[DataFrame], DataFrame]
    ) -> DocumentBlocks:
        """The blocks of a corpus that lies in them; ``exploded`` makes rows by term of its documents."""
        self = cls.__new__(cls)
        self.tables = []
        self._open(dealt.frame.sparkSession, dealt.blocks)
        corpus = self.session.table(dealt.table.name)
        self.rows = exploded(corpus if dealt.kept is None else corpus.where(dealt.kept))
        self._index()
        return self

    def _open(self, spark: SparkSession, blocks: int) -> None:
        self.blocks = blocks
        self.session = spark.newSession()
        self.session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self.session.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        self.session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def _index(self) -> None:
        index = self.rows.where("term IS NOT NULL").select("block", "term").distinct()
        self.tables.append(materialize_buckets(index, "block-terms", "term", self.blocks))
        self.index = self.session.table(self.tables[-1].name)

    def document(self) -> WindowSpec:
        return Window.partitionBy("block", "doc_id")

    def store(self, terms: DataFrame) -> Buckets:
        """Writes a table unique on ``term`` in the order of the index."""
        self.tables.append(materialize_buckets(terms, "block-table", "term", self.blocks))
        return self.tables[-1]

    def send(
        self,
        table: Buckets,
        *columns: str,
        how: str = "left",
        common: int = 0,
        width: Column | None = None,
        arrived: dict[str, Column] | None = None,
    ) -> DataFrame:
        """All rows, with the columns of their term from a stored table.

        Terms in many blocks are broadcast instead, up to ``common`` bytes of them, the most widespread
        first; ``width`` is the bytes of a row beyond its term; the join is a left one then. ``arrived`` names columns to be made of
        the stored ones, and to replace them, once they are in their block.
        """
        made = arrived or {c: F.col(c) for c in columns}
        values = [column.alias(name) for name, column in made.items()]
        stored = self.session.table(table.name).select("term", *columns)
        held = self.index.groupBy("term").agg(F.count("*").alias("held"))
        most = self._sent_to(stored.join(held, "term"), common, width)
        if most is None:
            rare = self.index.join(stored, "term").repartition(self.blocks, "block")
            return self.rows.join(rare.select("block", "term", *values), ["block", "term"], how)
        placed = stored.join(held, "term")
        rare = self.index.join(placed.where(F.col("held") <= most).drop("held"), "term")
        rare = rare.repartition(self.blocks, "block").select("block", "term", *values)
        often = placed.where(F.col("held") > most).select("term", *values)
        often = F.broadcast(often.withColumnsRenamed({c: f"{c}_often" for c in made}))
        # Both tables are unique on their keys, and no term is in both.
        met = self.rows.join(rare, ["block", "term"], "left").join(often, "term", "left")
        known = [F.coalesce(F.col(c), F.col(f"{c}_often")).alias(c) for c in made]
        met = met.select(*self.rows.columns, *known)
        return met

    def _sent_to(self, placed: DataFrame, common: int, width: Column | None) -> int | None:
        """The number of blocks beyond which terms fit in ``common`` bytes; NULL if there are none.

        One row for each number of blocks comes to the driver.
        """
        if not common:
            return None
        size = F.octet_length("term") + (F.lit(0) if width is None else width) + _ROW_OVERHEAD
        sizes = placed.groupBy("held").agg(F.sum(size).alias("size")).collect()
        most = None
        for r in sorted(sizes, key=lambda r: -r["held"]):
            common -= r["size"]
            # A term in one block is sent once, which is less than a broadcast.
            if common < 0 or r["held"] < 2:
                break
            most = r["held"] - 1
        return most

    def close(self) -> None:
        """Takes the tables out of the catalog; their files stay until their scope ends."""
        forget(self.session, *self.tables)
