"""Linear classifiers trained by full-batch gradient descent."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tonewright.operators.blocks import DocumentBlocks
from tonewright.operators.scoring import score_counts, score_entries
from tonewright.operators.term_table import BROADCAST_LIMIT, TermTable, numbered
from tonewright.operators.tfidf import Vocabulary, explode_entries
from tonewright.sources.workspace import materialize, temporary


def hinge_residual(margin: Column, label: Column) -> Column:
    """Factor of the features in the gradient of the hinge loss."""
    sign = 2 * label - 1
    return F.when(margin * sign < 1.0, -sign).otherwise(0.0)


def logistic_residual(margin: Column, label: Column) -> Column:
    """Factor of the features in the gradient of the log loss."""
    return 1.0 / (1.0 + F.exp(-margin)) - label


LOSSES = {"hinge": hinge_residual, "logistic": logistic_residual}


@dataclass(frozen=True)
class LinearModel:
    """``table(term, df, coef)`` without intercept, and the number of steps taken.

    ``threshold`` is the margin above which the class is 1: a margin of 0 is a probability of one
    half, so it serves both losses.
    """

    table: TermTable
    steps: int
    threshold: float = 0.0


def fit_gradient_descent(
    weighted: DataFrame,
    loss: str,
    iterations: int = 100,
    step: float = 1.0,
    reg: float = 0.01,
    tolerance: float = 0.001,
    limit: int = BROADCAST_LIMIT,
) -> LinearModel:
    """Gradient descent from zero with L2 shrinkage and a step of ``step / sqrt(k)``.

    Terms are numbered once and the rows packed into arrays, which stay where they are for the whole
    training (:func:`pack`). An iteration is one job: the coefficients, a number for each term, are
    broadcast; each task goes over its blocks and gives one partial sum for each of its terms; these
    are added up by ranges of terms. Of the tables written here only the model's stays. Coefficients of more than ``limit`` bytes stay in tables, and blocks
    of documents get the ones that they need (:class:`DocumentBlocks`).
    """
    with temporary(weighted.sparkSession):
        stored = materialize(weighted.select("doc_id", "label", "entries"), "train")
        n = stored.count()
        counts = explode_entries(stored).groupBy("term").agg(F.count("*").alias("df"))
        index = TermTable.of(materialize(numbered(counts, "train-terms"), "train-index"))
        if 8 * index.rows > limit:
            return _descend_by_joins(stored, n, loss, iterations, step, reg, tolerance, limit)
        packed = pack(stored, index)
        coef, taken = np.zeros(index.rows), 0
        try:
            for k in range(1, iterations + 1):
                rate = step / sqrt(k)
                old, coef = coef, coef * (1 - rate * reg) - rate * (_gradient(packed, coef, loss) / max(n, 1))
                taken = k
                if k == 1:  # the blocks are persisted now
                    packed.cleanShuffleDependencies()
                moved, length = sqrt(np.nansum((coef - old) ** 2)), sqrt(np.nansum(coef * coef))
                if k > 1 and moved < tolerance * max(length, 1.0):
                    break
        finally:
            packed.unpersist()
        written = materialize(_with_numbers(index.frame, coef), f"{loss}-{taken}", lasting=True)
    return LinearModel(TermTable(written, index.rows, index.size, index.total), taken)


#: Entries of a block, about.
BLOCK_ROWS = 2_000_000
#: Terms of a range that partial sums are added up in.
RANGE = 1 << 17


def pack(stored: DataFrame, index: TermTable) -> RDD:
    """The entries of a weighted corpus as blocks of arrays, persisted; a document lies in one block.

    A block has the numbers of its terms, the place among them and the weight of each entry, and the
    first entry and label of each unit: the entries of a document with one label. ``docs`` has the
    document of each unit if ids repeat with other labels. NULL labels are NaN.
    """
    rows = index.attach(explode_entries(stored), how="inner", drop=("df",), fitted=True)
    slots = stored.sparkSession.sparkContext.defaultParallelism
    dealt = rows.select("doc_id", "label", "idx", "w").repartition(slots, "doc_id")
    most = BLOCK_ROWS

    def block(rows: pa.Table, codes: np.ndarray) -> pa.RecordBatch:
        label = rows["label"].to_numpy()
        told = np.nan_to_num(label, nan=-1.0)
        new = (codes[1:] != codes[:-1]) | (told[1:] != told[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new]))
        docs = codes[starts]
        terms, at = np.unique(rows["idx"].to_numpy(), return_inverse=True)
        parts = {
            "terms": terms,
            "at": at.astype(np.int32),
            "w": rows["w"].to_numpy(),
            "starts": starts,
            "label": label[starts],
            "docs": docs if (docs[1:] == docs[:-1]).any() else None,
        }
        return pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(parts, 5)], pa.binary())})

    def blocks(batches):
        held, size, enough = [], 0, most
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= enough:
                rows, codes = table(held)
                cut = int(np.searchsorted(codes, codes[-1]))
                if cut:
                    yield block(rows.slice(0, cut), codes[:cut])
                held, size = rows.slice(cut).to_batches(), size - cut
                enough = size + most
        if size:
            yield block(*table(held))

    def table(held: list) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids = pa.concat_arrays(rows["doc_id"].chunks).dictionary_encode(null_encoding="encode")
        return rows, ids.indices.to_numpy()

    packed = dealt.sortWithinPartitions("doc_id", "label").mapInArrow(blocks, "block binary")
    return packed.rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def _residuals(loss: str) -> Callable:
    """As in ``LOSSES``, on arrays; what is NULL there is NaN here."""

    def hinge(margin, label):
        sign = 2 * label - 1
        return np.where(margin * sign < 1.0, -sign, 0.0)

    def logistic(margin, label):
        return 1.0 / (1.0 + np.exp(-margin)) - label

    return {"hinge": hinge, "logistic": logistic}[loss]


def _gradient(packed: RDD, coef: np.ndarray, loss: str) -> np.ndarray:
    """Sum of weight times residual for each term. As in SQL, sums leave out what is NULL (here NaN),
    and are NULL if nothing is left."""
    context = packed.context
    sent, residual, width, size = context.broadcast(coef), _residuals(loss), RANGE, len(coef)

    def margins(b: dict, c: np.ndarray) -> np.ndarray:
        known = ~np.isnan(c)
        margin = np.add.reduceat(b["w"] * np.where(known, c, 0.0)[b["at"]], b["starts"])
        if b["docs"] is not None:
            margin = np.bincount(b["docs"], margin)[b["docs"]]
        if not known.all():
            any_known = np.add.reduceat(known[b["at"]].astype(float), b["starts"])
            if b["docs"] is not None:
                any_known = np.bincount(b["docs"], any_known)[b["docs"]]
            margin[any_known == 0] = np.nan
        return margin

    def partial_sums(blocks):
        total, told, mine = np.zeros(size), np.zeros(size, bool), np.zeros(size, bool)
        for raw in blocks:
            b = pickle.loads(raw)
            with np.errstate(over="ignore"):
                r = residual(margins(b, sent.value[b["terms"]]), b["label"])
            known = ~np.isnan(r)
            lengths = np.diff(b["starts"], append=len(b["at"]))
            product = b["w"] * np.repeat(np.where(known, r, 0.0), lengths)
            total[b["terms"]] += np.bincount(b["at"], product, len(b["terms"]))
            mine[b["terms"]] = True
            if known.all():
                told[b["terms"]] = True
            else:
                told[b["terms"][np.unique(b["at"][np.repeat(known, lengths)])]] = True
        total[~told] = np.nan
        for first in range(0, size, width):
            here = np.flatnonzero(mine[first : first + width])
            if len(here):
                yield first // width, (here.astype(np.int32), total[first + here])

    def added(parts) -> np.ndarray:
        total, told = np.zeros(width), np.zeros(width, bool)
        for here, values in parts:
            known = ~np.isnan(values)
            total[here[known]] += values[known]
            told[here[known]] = True
        return np.where(told, total, np.nan)

    ranges = max(1, -(-size // width))
    try:
        sums = packed.mapPartitions(partial_sums).groupByKey(min(ranges, packed.getNumPartitions()))
        gradient = np.full(ranges * width, np.nan)
        for place, values in sums.mapValues(added).collect():
            gradient[place * width : (place + 1) * width] = values
        sums.cleanShuffleDependencies()
        return gradient[:size]
    finally:
        sent.destroy()


def _with_numbers(index: DataFrame, coef: np.ndarray) -> DataFrame:
    """``term, df, coef`` of an index of terms and the numbers of its terms, NaN as NULL."""
    sent = index.sparkSession.sparkContext.broadcast(coef)

    def looked_up(batches):
        for batch in batches:
            found = pa.array(sent.value[batch["idx"].to_numpy()], from_pandas=True)
            yield pa.RecordBatch.from_arrays([batch["term"], batch["df"], found], ["term", "df", "coef"])

    return index.select("term", "df", "idx").mapInArrow(looked_up, "term string, df bigint, coef double")


def _descend_by_joins(
    stored: DataFrame,
    n: int,
    loss: str,
    iterations: int,
    step: float,
    reg: float,
    tolerance: float,
    limit: int,
) -> LinearModel:
    """The descent in tables. The old coefficient travels through the aggregation with the gradient, so
    the update takes no join of its own; each iteration's coefficients are written out, which keeps the
    plan at one iteration however many there are."""
    residual = LOSSES[loss]
    rows = (
        explode_entries(stored.repartition("doc_id"))
        .sortWithinPartitions("doc_id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    table, blocks, sent, taken = None, None, None, 0

    def updated(known: DataFrame, document: WindowSpec, rate: float) -> DataFrame:
        margin = F.sum(F.col("w") * F.col("coef")).over(document)
        gradient = F.sum(F.col("w") * F.col("residual")) / n
        return (
            known.withColumn("residual", residual(margin, F.col("label")))
            .groupBy("term")
            .agg(
                F.count("*").alias("df"), F.max("coef").alias("old"), gradient.alias("gradient")
            )
            .select(
                "term",
                "df",
                "old",
                (F.col("old") * (1 - rate * reg) - rate * F.col("gradient")).alias("coef"),
            )
        )

    try:
        for k in range(1, iterations + 1):
            rate = step / sqrt(k)
            if blocks is not None:
                known = blocks.send(sent, "coef", how="inner")
                sent = blocks.store(updated(known, blocks.document(), rate))
                written = blocks.session.table(sent.name)
            else:
                known = rows.withColumn("coef", F.lit(0.0))
                if table is not None:
                    known = rows.join(F.broadcast(table.frame.drop("df")), "term")
                written = materialize(
                    updated(known, Window.partitionBy("doc_id"), rate), f"{loss}-{k}"
                )
            moved = F.col("coef") - F.col("old")
            change = written.agg(
                F.count("*").alias("rows"),
                F.sum(F.octet_length("term")).alias("chars"),
                F.sum("df").alias("total"),
                F.coalesce(F.sum(moved * moved), F.lit(0.0)).alias("moved"),
                F.coalesce(F.sum(F.col("coef") * F.col("coef")), F.lit(0.0)).alias("length"),
            ).first()
            table = TermTable.measured(written.select("term", "df", "coef"), change.asDict())
            taken = k
            if k > 1 and sqrt(change["moved"]) < tolerance * max(sqrt(change["length"]), 1.0):
                break
            if blocks is None and table.size > limit and k < iterations:
                rows.unpersist()
                entries = explode_entries(stored).select("term", "doc_id", "label", "w")
                blocks = DocumentBlocks(entries, table.total)
                sent = blocks.store(table.frame)
    finally:
        rows.unpersist()
        if blocks is not None:
            blocks.close()
    last = table.frame if blocks is None else stored.sparkSession.read.parquet(sent.path)
    last = materialize(last.select("term", "df", "coef"), f"{loss}-model", lasting=True)
    return LinearModel(TermTable.measured(last, change.asDict()), taken)


def predict_linear(weighted: DataFrame, model: LinearModel, drop_empty: bool = False) -> DataFrame:
    """Margin and class (an integer) of each document."""
    return _decided(score_entries(weighted, model.table, "coef"), model, drop_empty)


def predict_linear_counts(
    counted: DataFrame, vocabulary: Vocabulary, model: LinearModel, drop_empty: bool = False
) -> DataFrame:
    """As :func:`predict_linear`, for counted documents: weighed and scored in one pass, in which nothing
    but sums of documents is shuffled. The coefficients go to all terms of the vocabulary."""
    known = vocabulary.terms.join(model.table.frame.drop("df"), "term", "left")
    table = TermTable.of(materialize(known, "coefficients"))
    return _decided(score_counts(counted, table, "coef"), model, drop_empty)


def _decided(scored: DataFrame, model: LinearModel, drop_empty: bool) -> DataFrame:
    kept = scored.where("n_terms > 0") if drop_empty else scored
    return kept.withColumnRenamed("coef", "margin").withColumn(
        "prediction", (F.col("margin") > model.threshold).cast("int")
    ).drop("n_terms")
