"""Packs tokenized documents into training sequences by vector bin packing.

A sequence is a bin with three capacities: tokens, segments and loss-bearing tokens. The
dot-product heuristic fills one bin after the other: of all waiting pieces that fit, the one whose
demand vector has the largest dot product with the capacities that are left goes in. When none
fits, the longest waiting piece is cut to fill the rest.

Each task packs the documents it reads, window by window, and hands what doesn't fill a sequence
to its next window, so nothing is shuffled and memory is bounded by one window. What is left at a
task's end is cut at powers of two, which need no padding.

Defined results: a null or empty text is the end id alone; equal documents are packed each on its
own; a document of any length is cut as often as needed; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonewright.llm.token_cache import SpaceSplitEncoder

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 4096
SCHEMA = (
    "doc_id {key}, start bigint, length bigint, ids binary, loss_tokens bigint, "
    "doc_tokens bigint, sequence_id bigint, offset bigint"
)


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. With 512 segments, documents of two ids still fill 1024 tokens,
    and those of one id end at a power of two."""

    tokens: int = 1024
    segments: int = 512
    loss_tokens: int = 1024


@dataclass
class Piece:
    """Ids ``start`` to ``start + length`` of a document; loss begins at id ``prompt``."""

    doc: object
    ids: bytes
    total: int
    prompt: int
    start: int
    length: int

    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.prompt))

    def head(self, tokens: int, loss: int) -> int:
        """The longest beginning within both bounds."""
        return max(0, min(self.length, tokens, max(0, self.prompt - self.start) + loss))

    def split(self, length: int) -> tuple[Piece, Piece]:
        first = Piece(self.doc, self.ids, self.total, self.prompt, self.start, length)
        rest = Piece(
            self.doc, self.ids, self.total, self.prompt, self.start + length, self.length - length
        )
        return first, rest


def pack_window(
    pieces: list[Piece], limits: Limits, last: bool
) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences for the pieces, and the pieces of an unfilled sequence (none if ``last``)."""
    bins: list[list[Piece]] = []
    waiting: list[Piece] = []
    for piece in pieces:
        while piece.length and (
            piece.length >= limits.tokens or piece.loss() >= limits.loss_tokens
        ):
            whole, piece = piece.split(piece.head(limits.tokens, limits.loss_tokens))
            bins.append([whole])
        if piece.length:
            waiting.append(piece)
    scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
    demand = np.array([[p.length, 1, p.loss()] for p in waiting], dtype=np.float64).reshape(-1, 3)
    demand /= scale
    tokens = np.array([p.length for p in waiting], dtype=np.int64)
    losses = np.array([p.loss() for p in waiting], dtype=np.int64)
    open_ = np.ones(len(waiting), dtype=bool)
    left = len(waiting)
    while left:
        if left * 2 < len(waiting):
            at = np.flatnonzero(open_)
            waiting = [waiting[i] for i in at]
            demand, tokens, losses = demand[at], tokens[at], losses[at]
            open_ = np.ones(left, dtype=bool)
        content: list[Piece] = []
        room, segments, loss = limits.tokens, limits.segments, limits.loss_tokens
        while left and room and segments and loss:
            score = demand @ (np.array([room, segments, loss]) / scale)
            score[~open_ | (tokens > room) | (losses > loss)] = -1.0
            best = int(score.argmax())
            if score[best] >= 0:
                piece = waiting[best]
                open_[best] = False
                left -= 1
            else:
                best = int(np.where(open_, tokens, -1).argmax())
                piece, rest = waiting[best].split(waiting[best].head(room, loss))
                if not piece.length:
                    break
                waiting[best] = rest
                tokens[best], losses[best] = rest.length, rest.loss()
                demand[best] = np.array([rest.length, 1, rest.loss()]) / scale
            content.append(piece)
            room -= piece.length
            segments -= 1
            loss -= piece.loss()
        if not left and room and segments and loss and not last:
            return bins, content
        bins.append(content)
    return bins, []


def at_powers_of_two(content: list[Piece]) -> list[list[Piece]]:
    """Cuts a short sequence into sequences whose lengths are powers of two."""
    total = sum(p.length for p in content)
    queue, bins = list(reversed(content)), []
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part: list[Piece] = []
        while size:
            piece = queue.pop()
            if piece.length > size:
                piece, rest = piece.split(size)
                queue.append(rest)
            part.append(piece)
            size -= piece.length
        bins.append(part)
    return bins


def pack(
    docs: DataFrame,
    limits: Limits = Limits(),
    vocabulary: str = VOCABULARY,
    end_id: int = 0,
    prompt: str | None = None,
) -> DataFrame:
    """Pieces of all documents: ids, place in the document, sequence and offset in it.

    ``prompt`` names a column whose ids come before those of ``text`` and bear no loss.
    """
    lead = F.lit(None).cast("string") if prompt is None else F.col(prompt).cast("string")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), lead.alias("prompt"))
    schema = SCHEMA.format(key=rows.schema["doc_id"].dataType.simpleString())
    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SpaceSplitEncoder.of(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        counter = TaskContext.get().partitionId() << 40
        carried: list[Piece] = []
        kind = None

        def emitted(bins: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal counter
            columns: list[list] = [[] for _ in range(8)]
            for content in bins:
                offset = 0
                for p in content:
                    ids = p.ids[4 * p.start : 4 * (p.start + p.length)]
                    row = (p.doc, p.start, p.length, ids, p.loss(), p.total, counter, offset)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += p.length
                counter += 1
            long = pa.int64()
            kinds = [kind, long, long, pa.binary(), long, long, long, long]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for begin in range(0, batch.num_rows, WINDOW):
                part = batch.slice(begin, WINDOW)
                names, texts, prompts = (part.column(i).to_pylist() for i in range(3))
                heads = encoder.encode_all(prompts)
                pieces = carried
                for doc, before, ids in zip(names, heads, encoder.encode_all(texts), strict=True):
                    ids = before + ids + end
                    pieces.append(Piece(doc, ids, len(ids) // 4, len(before) // 4, 0, len(ids) // 4))
                bins, carried = pack_window(pieces, limits, last=False)
                yield emitted(bins)
        if carried:
            yield emitted(at_powers_of_two(carried))

    return rows.mapInArrow(run, schema)
