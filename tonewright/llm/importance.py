"""Importance resampling towards a target: documents are drawn by how likely their words are there.

Features are runs of one to three words, hashed into buckets. Each bucket's gain is the rounded log
ratio of its smoothed shares in the target and in the corpus; a document's weight is the sum of its
features' gains. A Gumbel term from a hash of the id is added, and the highest scores are drawn,
which draws without replacement in proportion to the weights.

Both passes over the texts stay in the task that reads them. A task sends its counts as one array
of buckets; the gains come back as one array, so a weight is a sum of lookups. The cutoff is found
without sorting the corpus: a quantile sketch brackets it, exact counts above and inside the bracket
validate it or widen it, and only the bracket is sorted. Drawn rows are ranked by a range sort in
which the row's number is the last key, so that rows with equal ids and scores can be split over
tasks. Nothing but bucket counts, the bracket and three counts reach the driver.

Defined results: a null or empty text, or one without a word, has no features and weight 0; a null
id counts as the empty string in its hash and comes first among ties; equal rows have equal scores,
are drawn one by one, and stand next to each other; an empty target leaves all documents with the
gains of the corpus alone; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonewright.llm.gram_hash import runs_of, words_of
from tonewright.sources import workspace

BUCKETS = 10_000
#: Bytes of text that are worked on at once; longer texts are taken in parts.
BLOCK = 4 << 20
#: Of the sketch: its error in ranks is the number of rows divided by this.
ACCURACY = 10_000

_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def blocks(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``BLOCK`` bytes, with the number of the first."""
    begin, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > BLOCK:
            yield begin, held
            begin, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield begin, held


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each part of a block: words of each text, and (text, checksum) of its runs of words.

    A text beyond ``BLOCK`` is cut between words; its last two words are carried to the next part.
    """
    if len(texts) > 1 or len(texts[0]) <= BLOCK:
        words = words_of(texts)
        yield np.bincount(words.text, minlength=len(texts)), runs_of(words)
        return
    text, at, carried = texts[0], 0, None
    while at < len(text):
        found = _SEPARATOR.search(text, min(len(text), at + BLOCK))
        end = found.start() if found else len(text)
        words = words_of([text[at:end]])
        known = 0
        if carried is not None:
            known = len(carried.crc)
            words = words.after(carried)
        yield np.array([len(words.crc) - known]), runs_of(words, known)
        carried = words.last(2)
        at = end


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    The driver receives one row for each bucket that occurs, at most ``buckets``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in blocks(batch.column(0).to_pylist()):
                for _, runs in features(texts):
                    for _, crc in runs:
                        total += np.bincount(crc % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    texts = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    counted = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded log ratios of the smoothed shares, in thousandths."""
    n = len(corpus)
    above, below = float(int(corpus.sum()) + n), float(int(target.sum()) + n)
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * above / (float(s + 1) * below)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each document."""
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counted = np.zeros((3, n), dtype=np.int64)
            for begin, texts in blocks(batch.column(1).to_pylist()):
                here = slice(begin, begin + len(texts))
                for words, runs in features(texts):
                    counted[0, here] += words
                    for text, crc in runs:
                        counted[1, here] += np.bincount(text, minlength=len(texts))
                        # sums of whole numbers below 2^53 are exact in doubles
                        sums = np.bincount(text, weights=gain[crc % len(gain)], minlength=len(texts))
                        counted[2, here] += sums.astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counted)], names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def scored(weighed: DataFrame, seed: int) -> DataFrame:
    """Adds the score: the weight and a Gumbel term from the hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    term = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    return weighed.withColumn("score", F.col("weight") + term)


def bracket(rows: DataFrame, drawn: int, n: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """Scores ``low`` and ``high`` between which the ``drawn``-th highest lies, and how many of the
    rows are above ``high``.

    The sketch only proposes; counts decide, and a bracket that misses is widened on both sides.
    """
    margin, middle = 2.0 / accuracy, 1 - drawn / n
    while True:
        ends = [max(0.0, middle - margin), min(1.0, middle + margin)]
        low, high = rows.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        if margin >= 1:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        above, inside = rows.agg(
            F.count(F.when(F.col("score") > high, 1)),
            F.count(F.when(F.col("score").between(low, high), 1)),
        ).first()
        if above < drawn <= above + inside:
            return low, high, above
        margin *= 8


def placed(rows: DataFrame) -> DataFrame:
    """Adds ``place`` (from 1) by falling score, then id, by a range sort.

    Offsets are one row for each partition of the sort, so they are broadcast.
    """
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    stored = workspace.materialize(dealt.withColumn("at", at), "placed", lasting=True)
    part = F.shiftright("at", 33)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    past = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"))
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    return (
        stored.withColumn("part", part)
        .join(F.broadcast(before), "part")
        .withColumn("place", F.col("before") + inside + 1)
        .drop("part", "at", "before")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    drawn_of: tuple[int, int] = (5, 100),
    least_words: int = 20,
    buckets: int = BUCKETS,
    seed: int = 42,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document.

    Of the documents with ``least_words`` words, ``floor(n * a / b)`` are drawn for ``drawn_of``
    ``(a, b)``; the others have no rank.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    numbered = scored(weigh(docs, gain), seed).withColumn("row", F.monotonically_increasing_id())
    stored = workspace.materialize(numbered, "scored", lasting=True)
    long_enough = F.col("n_words") >= least_words
    candidates = stored.where(long_enough)
    n = candidates.count()
    drawn = drawn_of[0] * n // drawn_of[1]
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    no_rank = F.lit(None).cast("bigint").alias("rank")
    if not drawn:
        return stored.select(*names, no_rank)
    low, high, above = bracket(candidates, drawn, n)
    score = F.col("score")
    sure = placed(candidates.where(score > high)).select(*names, F.col("place").alias("rank"))
    edge = placed(candidates.where(score.between(low, high)))
    rank = (F.col("place") + above).alias("rank")
    edge = edge.select(*names, F.when(rank <= drawn, rank).alias("rank"))
    rest = stored.where(~long_enough | (score < low)).select(*names, no_rank)
    return sure.unionByName(edge).unionByName(rest)
