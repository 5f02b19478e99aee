"""Removes repeated byte strings by refining suffix buckets.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
id. Strings are compared as suffixes cut at ``LENGTH``, by bucket-pointer refinement: suffixes
start in the bucket of their first bytes and are sorted by the bucket identifiers at later offsets,
8 bytes to 16, 16 to 32, 32 to ``LENGTH``; each level reuses the identifiers of the one before, and
suffixes alone in their bucket take no further part. (Identifiers are replaced level by level, not
inside a level, because the comparison must end after exactly ``LENGTH`` bytes.)

A suffix array of everything would shuffle several bytes for each byte of text. Each string is
therefore listed under the smallest hash among its short substrings, its anchor, which equal strings
share, and only strings whose anchor occurs in two documents or more are sent to be sorted:

1. Tasks send each anchor once for the documents they read; buckets find the anchors that two
   tasks share, and those that one task met twice it knows itself.
2. For these anchors, the stretch of text whose strings fall to the anchor goes to the anchor's
   bucket, again once for each task and distinct stretch, so common passages are not piled up. Equal
   stretches are settled at once, the others by refinement.
3. The removed runs meet their documents.

The number of buckets grows with the rows, so the number of anchors of a bucket stays the same. An
anchor with more than ``HOT`` stretches (a short phrase in many different surroundings) would fill
its bucket alone: its strings are sent one by one, each below a hash of its own ``LENGTH`` bytes, which
equal strings share, and one of each for a batch. Hot anchors are known by a bitmap of bounded size;
an anchor that only shares a bit with one is split as well, everywhere, with the same result.

Defined results: a null text counts as empty; texts shorter than ``LENGTH`` keep all bytes; a null
``doc_id`` comes after all others; rows with the same id never remove each other's bytes, and equal
rows have equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonewright.llm import key_filter
from tonewright.llm.batches import cuts, giving_back, giving_back_after
from tonewright.sources.workspace import materialize, temporary

LENGTH = 50
GRAM = 16
BATCH = 8192
#: Stretches below one anchor, as all batches met them, from which its strings are sent one by one.
HOT = 2048
#: Bytes of text that are hashed or refined at once, which takes about 100 bytes of memory for each.
AT_ONCE = 1 << 19
LAST = np.iinfo(np.int64).max
_ODD = 0x9E3779B97F4A7C15


def _gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position, built by doubling."""
    h, size, factor = buffer.astype(np.uint64), 1, _ODD
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor = factor * factor % (1 << 64)
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of strings with the same anchor: text index, first start, number of starts, hash.

    Starts count from the beginning of the own text.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.empty(0, dtype=np.int64)
    if len(buffer) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    window = LENGTH - GRAM + 1
    h = _gram_hashes(buffer)
    least, reach = h, 1
    while reach * 2 <= window:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    count = len(buffer) - LENGTH + 1
    least = np.minimum(least[:count], least[window - reach : window - reach + count])
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)[:count]
    begins = ends - sizes
    inside = np.arange(count) + LENGTH <= ends[text]
    change = np.empty(count, dtype=bool)
    change[0] = True
    change[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    length = np.diff(np.append(first, count))
    kept = inside[first]
    first, length = first[kept], length[kept]
    return text[first], first - begins[text[first]], length, least[first]


def refine(buffer: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Numbers such that two starts have the same one exactly if their ``LENGTH`` bytes are equal.

    Every start needs ``LENGTH`` bytes behind it. A start that is alone in its bucket is given a
    number of its own and not refined any more.
    """
    out = np.full(len(starts), -1, dtype=np.int64)
    spread = LENGTH - 32
    code, width = buffer.astype(np.uint64), 1
    while width < 8:
        code = (code[:-width] << np.uint64(8 * width)) | code[width:]
        width *= 2
    wanted = np.zeros(len(buffer), dtype=bool)
    for offset in (0, 8, 16, 24):
        wanted[starts + offset] = True
        wanted[starts + offset + spread] = True
    at = np.flatnonzero(wanted)
    pointer = np.zeros(len(buffer), dtype=np.int64)
    pointer[at] = np.unique(code[at], return_inverse=True)[1]
    number, alive = 0, np.arange(len(starts))
    for step in (8, 16, spread):
        s = starts[alive]
        if step == spread:
            needed = s
        elif step == 16:
            needed = np.unique(np.concatenate([s, s + spread]))
        else:
            needed = np.unique(np.concatenate([s, s + 16, s + spread, s + spread + 16]))
        pairs = pointer[needed] * len(buffer) + pointer[needed + step]
        refined = np.zeros(len(buffer), dtype=np.int64)
        refined[needed] = np.unique(pairs, return_inverse=True)[1]
        pointer = refined
        bucket = pointer[s]
        size = np.bincount(bucket, minlength=1)
        if step != spread:
            single = size[bucket] == 1
            lone = alive[single]
            out[lone] = number + np.arange(len(lone))
            number += len(lone)
            alive = alive[~single]
        else:
            out[alive] = number + bucket
        if not len(alive):
            break
    return out


def repeated_starts(
    stretches: list[bytes], groups: np.ndarray, docs: np.ndarray
) -> list[tuple[int, int, int]]:
    """Runs ``(stretch, first, number)`` of starts whose string is in a smaller document too.

    ``groups`` holds the anchors: only strings below the same one can be equal.
    """
    index: dict[bytes, int] = {}
    which = np.array([index.setdefault(x, len(index)) for x in stretches], dtype=np.int64)
    least = np.full(len(index), LAST, dtype=np.int64)
    np.minimum.at(least, which, docs)
    runs = [
        (int(i), 0, len(stretches[i]) - LENGTH + 1) for i in np.flatnonzero(docs > least[which])
    ]
    # one of each distinct stretch, and only where an anchor has several
    first = np.unique(which, return_index=True)[1]
    own = groups[first]
    _, inverse, count = np.unique(own, return_inverse=True, return_counts=True)
    open_ = first[count[inverse] > 1]
    if not len(open_):
        return runs
    members: dict[int, list[int]] = {}
    for i in np.flatnonzero(docs == least[which]):
        members.setdefault(int(which[i]), []).append(int(i))
    # whole anchors at a time: a bucket is bounded, but the arrays of its refinement are far larger
    open_ = open_[np.argsort(groups[open_], kind="stable")]
    edges = np.append(np.unique(groups[open_], return_index=True)[1], len(open_))
    sizes = np.add.reduceat([len(stretches[i]) for i in open_], edges[:-1]).tolist()
    for begin, end in cuts(sizes, len(sizes), AT_ONCE):
        part = open_[edges[begin] : edges[end]]
        for at, first_start, n in _repeated([stretches[i] for i in part], least[which[part]]):
            runs += [(i, first_start, n) for i in members[int(which[part[at]])]]
    return runs


def _repeated(texts: list[bytes], least: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs ``(text, first, number)`` of starts in distinct stretches whose string is in one with a
    smaller ``least`` document."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
    number = refine(buffer, starts)
    # the smallest document of each string; members of a distinct stretch share its fate or are
    # removed already, but a stretch's own smallest document decides for the others
    lowest = np.full(number.max() + 1, LAST, dtype=np.int64)
    np.minimum.at(lowest, number, least[owner])
    repeated = lowest[number] < least[owner]
    change = np.flatnonzero(
        np.concatenate([[True], (repeated[1:] != repeated[:-1]) | (owner[1:] != owner[:-1])])
    )
    length = np.diff(np.append(change, len(repeated)))
    for at, n in zip(change, length, strict=True):
        if repeated[at]:
            t = int(owner[at])
            yield t, int(starts[at] - begins[t]), int(n)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for begin in range(0, batch.num_rows, BATCH):
        yield batch.slice(begin, BATCH)


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _sizes(column: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


_MET = "bucket bigint, batch bigint, docs binary, keys binary, index binary, low binary, known binary"


@giving_back
def _send_anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """For each bucket the anchors met, and for each batch its documents, below a bucket of its own.

    ``index`` and ``low`` tell the document and the lower half of the hash of an anchor; ``known``
    is twice the number of its stretches, plus 1 if the batch met the anchor in several documents.
    """
    number = TaskContext.get().partitionId() << 24
    for whole in batches:
        for batch in _parts(whole):
            body = batch.column(1)
            edges = list(cuts(_sizes(body), 512, AT_ONCE))
            found = [anchors(_utf8(body.slice(i, j - i)))[::3] for i, j in edges]
            index = np.concatenate([f[0] + i for f, (i, _) in zip(found, edges, strict=True)]).astype(np.uint16)
            hashes = np.concatenate([f[1] for f in found])
            order = np.lexsort((index, hashes))
            hashes, index = hashes[order], index[order]
            many = np.unique(hashes, return_counts=True)[1]
            fresh = np.ones(len(hashes), dtype=bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (index[1:] != index[:-1])
            hashes, index = hashes[fresh], index[fresh]
            head = np.ones(len(hashes), dtype=bool)
            head[1:] = hashes[1:] != hashes[:-1]
            again = np.zeros(len(hashes), dtype=bool)
            again[:-1] = ~head[1:]
            again |= ~head
            low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            known_as = 2 * np.minimum(many, 0x7FFF)[np.cumsum(head) - 1] + again
            sent = np.flatnonzero(head)
            sent = sent[np.argsort(bucket[sent], kind="stable")]
            edges = np.searchsorted(bucket[sent], np.arange(buckets + 1))
            known = np.flatnonzero(again)
            rows: list[list] = [[] for _ in range(7)]

            def add(*row):
                for column, value in zip(rows, row, strict=True):
                    column.append(value)

            add(
                -1 - number, number, _ids(batch.column(0)).tobytes(),
                batch.column(2).to_numpy(zero_copy_only=False).tobytes(),
                index[known].tobytes(), low[known].tobytes(), b"",
            )
            for b in np.flatnonzero(np.diff(edges)):
                at = sent[edges[b] : edges[b + 1]]
                add(
                    int(b), number, b"", b"", index[at].tobytes(), low[at].tobytes(),
                    known_as[at].astype(np.uint16).tobytes(),
                )
            number += 1
            long, raw = pa.int64(), pa.binary()
            kinds = [long, long, raw, raw, raw, raw, raw]
            names = [c.split()[0] for c in _MET.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)


def _shared_anchors(table: pa.Table, hot: int) -> pa.Table:
    """Of a bucket, the anchors that several batches sent; rows about batches pass through.

    A row below a negative batch has the anchors with more than ``hot`` stretches.
    """
    if table.column("bucket")[0].as_py() < 0:
        return table
    index = [np.frombuffer(x, np.uint16) for x in table.column("index").to_pylist()]
    low = [np.frombuffer(x, np.uint32) for x in table.column("low").to_pylist()]
    known = np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("known").to_pylist()])
    row = np.repeat(np.arange(len(low)), [len(x) for x in low])
    index, low = np.concatenate(index), np.concatenate(low)
    own, inverse, count = np.unique(low, return_inverse=True, return_counts=True)
    many = own[np.bincount(inverse, weights=known >> 1, minlength=len(own)) > hot]
    back = (count[inverse] > 1) & (known & 1 == 0)
    row, index, low = row[back], index[back], low[back]
    edges = np.searchsorted(row, np.arange(table.num_rows + 1))
    cut = [slice(edges[i], edges[i + 1]) for i in range(table.num_rows)]
    bucket, batch = table.column("bucket").to_pylist(), table.column("batch").to_pylist()
    index, low = [index[c].tobytes() for c in cut], [low[c].tobytes() for c in cut]
    if len(many):
        bucket.append(bucket[0])
        batch.append(-1 - bucket[0])
        index.append(b"")
        low.append(many.tobytes())
    empty = pa.array([b""] * len(bucket), pa.binary())
    return pa.table(
        {
            "bucket": pa.array(bucket, pa.int64()),
            "batch": pa.array(batch, pa.int64()),
            "docs": empty,
            "keys": empty,
            "index": pa.array(index, pa.binary()),
            "low": pa.array(low, pa.binary()),
            "known": empty,
        }
    )


_CANDIDATES = "id bigint, key bigint, low binary"


def _by_document(table: pa.Table) -> pa.Table:
    """The shared anchors of each document of a batch; hot anchors have no ``id``."""
    rows = table.to_pylist()
    if rows[0]["batch"] < 0:
        return pa.table(
            {
                "id": pa.nulls(len(rows), pa.int64()),
                "key": pa.nulls(len(rows), pa.int64()),
                "low": pa.array([r["low"] for r in rows], pa.binary()),
            }
        )
    about = next(r for r in rows if r["bucket"] < 0)
    docs, keys = np.frombuffer(about["docs"], np.int64), np.frombuffer(about["keys"], np.int64)
    index = np.concatenate([np.frombuffer(r["index"], np.uint16) for r in rows])
    low = np.concatenate([np.frombuffer(r["low"], np.uint32) for r in rows])
    order = np.argsort(index, kind="stable")
    index, low = index[order], low[order]
    own, first = np.unique(index, return_index=True)
    ends = np.append(first, len(index))
    return pa.table(
        {
            "id": pa.array(docs[own], pa.int64()),
            "key": pa.array(keys[own], pa.int64()),
            "low": pa.array([low[ends[i] : ends[i + 1]].tobytes() for i in range(len(own))], pa.binary()),
        }
    )


_STRETCHES = "bucket bigint, ids binary, keys binary, starts binary, anchors binary, sizes binary, bytes binary"
_PACKED = "part bigint, ids binary, keys binary, lows binary, highs binary"
_RUNS = "id bigint, key bigint, runs binary"
#: Bytes of text for each bucket of anchors, and documents whose runs are put together at once.
BUCKET_BYTES, PART = 7 << 20, 1 << 16


def _squeezed(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values if isinstance(values, bytes) else values.tobytes())


def _opened(table: pa.Table, name: str, kind) -> np.ndarray:
    """A column of compressed arrays, one after the other."""
    parts = (zstandard.ZstdDecompressor().decompress(x) for x in table.column(name).to_pylist())
    return np.concatenate([np.frombuffer(x, kind) for x in parts])


@giving_back
def _hot_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = [np.frombuffer(x, np.uint32) for x in batch.column(0).to_pylist()]
        at = np.concatenate([*low, np.empty(0, np.uint32)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])


@giving_back
def _send_stretches(
    batches: Iterator[pa.RecordBatch], buckets: int, bits: bytes
) -> Iterator[pa.RecordBatch]:
    """Stretches of text below shared anchors by bucket, one of each for a batch; below the hot
    anchors of ``bits``, their strings.

    A further copy with a larger id is known to be repeated: its whole stretch goes as a removed
    run, below a negative bucket, with the sizes of runs in ``sizes``.
    """
    mask = np.frombuffer(bits, dtype=np.uint8)
    for batch in batches:
        ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        met: dict[bytes, int] = {}
        pieces: list[bytes] = []
        sent: list[list] = [[], []]
        order = np.argsort(ids, kind="stable")
        sizes = np.array(_sizes(batch.column(2)))[order].tolist()
        for begin, end in cuts(sizes, 512, AT_ONCE):
            part = order[begin:end]
            rows = batch.take(pa.array(part))
            texts = _utf8(rows.column(2))
            lows = [np.frombuffer(x, np.uint32) for x in rows.column(3).to_pylist()]
            text, start, count, hashes = anchors(texts)
            mark = (text.astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))
            wanted = [np.uint64(i << 32) | x.astype(np.uint64) for i, x in enumerate(lows)]
            at = np.flatnonzero(np.isin(mark, np.concatenate([*wanted, mark[:0]])))
            row, size = part[text[at]], count[at] + LENGTH - 1
            bit = (hashes[at] & np.uint64(key_filter.BITS - 1)).astype(np.int64)
            hot = (mask[bit >> 3] >> (bit & 7)) & 1 == 1
            gone, split = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
            single: list[tuple[int, int, int, int]] = []
            lost: list[tuple[int, int, int, int]] = []
            strings: list[bytes] = []
            for i, (t, s, n) in enumerate(zip(text[at].tolist(), start[at].tolist(), size.tolist(), strict=True)):
                piece = texts[t][s : s + n]
                gone[i] = ids[met.setdefault(piece, row[i])] < ids[row[i]]
                if gone[i]:
                    continue
                if not hot[i]:
                    pieces.append(piece)
                    continue
                split[i], own, until = True, int(row[i]), -1
                for first in range(s, s + n - LENGTH + 1):
                    string = piece[first - s : first - s + LENGTH]
                    if ids[met.setdefault(string, own)] >= ids[own]:
                        strings.append(string)
                        single.append((own, first, LENGTH, xxhash.xxh3_64_intdigest(string)))
                    elif until == first:
                        lost[-1] = (own, lost[-1][1], lost[-1][2] + 1, 0)
                        until = first + 1
                    else:
                        lost.append((own, first, LENGTH, 0))
                        until = first + 1
            pieces += strings
            for out, which, more in zip(sent, (~gone & ~split, gone), (single, lost), strict=True):
                out.append((row[which], start[at][which], size[which], hashes[at][which]))
                if more:
                    out.append(tuple(np.array(c, k) for c, k in zip(zip(*more), (np.int64,) * 3 + (np.uint64,), strict=True)))
        out: list[list] = [[] for _ in range(7)]

        def add(b, row, start, size, hashes, body):
            values = (
                b, _squeezed(np.diff(ids[row], prepend=0)), _squeezed(keys[row].astype(np.int64)),
                _squeezed(start.astype(np.int32)), _squeezed(hashes.astype(np.uint32)),
                _squeezed(size.astype(np.int32)), _squeezed(body),
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)

        row, start, size, hashes = (np.concatenate(x) for x in zip(*sent[0], strict=True))
        bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            take = order[edges[b] : edges[b + 1]]
            add(int(b), row[take], start[take], size[take], hashes[take], b"".join([pieces[i] for i in take.tolist()]))
        row, start, size, hashes = (np.concatenate(x) for x in zip(*sent[1], strict=True))
        if len(row):
            # settled here; the bucket's number only spreads the work
            add(-1 - int(ids[row[0]] % buckets), row, start, size, hashes, b"")
        names = [c.split()[0] for c in _STRETCHES.split(", ")]
        kinds = [pa.int64(), *[pa.binary()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def _packed_runs(
    ids: np.ndarray, keys: np.ndarray, begin: np.ndarray, end: np.ndarray, parts: int
) -> pa.Table:
    """Removed runs, one row for each part of the documents: a bucket meets most documents, so rows
    for each bucket and document would grow with the square of the input."""
    mixed = (ids.astype(np.uint64) * np.uint64(_ODD)) ^ keys.astype(np.uint64)
    part = ((mixed * np.uint64(_ODD)) >> np.uint64(33)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    numbers, first = np.unique(part[order], return_index=True)
    edges = np.append(first, len(order))
    names = [c.split()[0] for c in _PACKED.split(", ")]
    columns: list[list] = [numbers.astype(np.int64).tolist(), [], [], [], []]
    for i in range(len(numbers)):
        take = order[edges[i] : edges[i + 1]]
        values = (ids[take], keys[take], begin[take].astype(np.int32), end[take].astype(np.int32))
        for column, value in zip(columns[1:], values, strict=True):
            column.append(_squeezed(np.ascontiguousarray(value)))
    kinds = [pa.int64(), *[pa.binary()] * 4]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _by_row(table: pa.Table) -> pa.Table:
    """Removed runs of each document of a part, as pairs of 32-bit integers."""
    ids, keys = _opened(table, "ids", np.int64), _opened(table, "keys", np.int64)
    pairs = np.stack([_opened(table, "lows", np.int32), _opened(table, "highs", np.int32)], axis=1)
    order = np.lexsort((pairs[:, 0], keys, ids))
    ids, keys, pairs = ids[order], keys[order], pairs[order]
    head = np.ones(len(ids), dtype=bool)
    head[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(head)
    ends = np.append(first, len(ids))
    return pa.table(
        {
            "id": pa.array(ids[first], pa.int64()),
            "key": pa.array(keys[first], pa.int64()),
            "runs": pa.array([pairs[ends[i] : ends[i + 1]].tobytes() for i in range(len(first))], pa.binary()),
        }
    )


@giving_back_after
def _sort_bucket(table: pa.Table, parts: int) -> pa.Table:
    opened = (zstandard.ZstdDecompressor().decompress(x) for x in table.column("ids").to_pylist())
    ids = np.concatenate([np.cumsum(np.frombuffer(x, np.int64)) for x in opened])
    keys = _opened(table, "keys", np.int64)
    starts = _opened(table, "starts", np.int32).astype(np.int64)
    sizes = _opened(table, "sizes", np.int32).astype(np.int64)
    if table.column("bucket")[0].as_py() < 0:
        return _packed_runs(ids, keys, starts, starts + sizes, parts)
    body = _opened(table, "bytes", np.uint8).tobytes()
    ends = np.cumsum(sizes)
    pieces = [body[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    runs = np.array(repeated_starts(pieces, _opened(table, "anchors", np.uint32), ids), dtype=np.int64)
    runs = runs.reshape(-1, 3)
    which, begin = runs[:, 0], starts[runs[:, 0]] + runs[:, 1]
    return _packed_runs(ids[which], keys[which], begin, begin + runs[:, 2] + LENGTH - 1, parts)


@giving_back
def _cut(batches: Iterator[pa.RecordBatch], as_text: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 1024):
            batch = whole.slice(begin, 1024)
            sizes, removed, spans, kept = [], [], [], []
            for text, parts in zip(_utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                pairs = np.frombuffer(b"".join(parts or []), np.int32).reshape(-1, 2)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                reach = np.maximum.accumulate(pairs[:, 1])
                head = np.ones(len(pairs), dtype=bool)
                head[1:] = pairs[1:, 0] > reach[:-1]
                first = np.flatnonzero(head)
                lows = pairs[first, 0]
                highs = reach[np.append(first[1:], len(pairs)) - 1] if len(pairs) else lows
                sizes.append(len(text))
                removed.append(int((highs - lows).sum()))
                spans.append(len(first))
                at, rest = 0, []
                for low, high in zip(lows.tolist(), highs.tolist(), strict=True):
                    rest.append(text[at:low])
                    at = high
                body = b"".join([*rest, text[at:]])
                kept.append(body.decode(errors="ignore") if as_text else body)
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, long), pa.array(removed, long),
                    pa.array(spans, long), pa.array(kept, pa.string() if as_text else pa.binary()),
                ],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def _rows(docs: DataFrame, *columns) -> DataFrame:
    """Text with the id that orders documents (null: the largest) and a hash of id and text."""
    return docs.select(
        *columns,
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("id"),
        F.xxhash64("text").alias("key"),
        F.col("text").cast("string").alias("text"),
    )


def sent_stretches(docs: DataFrame) -> DataFrame:
    """What is to be sorted, by bucket: the stretches below shared anchors, in compressed arrays."""
    hot = HOT

    def shared_anchors(table: pa.Table) -> pa.Table:
        return _shared_anchors(table, hot)

    rows = _rows(docs).where(F.octet_length("text") >= LENGTH)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(0, (size // BUCKET_BYTES).bit_length())
    met = rows.select("id", "text", "key").mapInArrow(partial(_send_anchors, buckets=buckets), _MET)
    shared = met.groupBy("bucket").applyInArrow(shared_anchors, _MET)
    candidates = shared.groupBy("batch").applyInArrow(_by_document, _CANDIDATES)
    candidates = materialize(candidates, "candidates")
    many = candidates.where("id IS NULL").select("low").mapInArrow(_hot_anchors, "at bigint")
    bits = key_filter.bits_of(many, "at")
    one = candidates.where("id IS NOT NULL").groupBy("id", "key").agg(F.first("low").alias("low"))
    texts = rows.join(one, ["id", "key"]).select("id", "key", "text", "low")
    return texts.mapInArrow(partial(_send_stretches, buckets=buckets, bits=bits), _STRETCHES)


def removed_runs(docs: DataFrame) -> DataFrame:
    """``id, key, runs``: the removed runs of documents that have any, as binary pairs.

    ``id`` is the document's id or the largest integer, ``key`` a hash of its text. Runs leave a
    bucket as they came in, many documents to a row, and are put together by parts of the documents.
    """
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(slots, docs.count() // PART)

    def sort_bucket(table: pa.Table) -> pa.Table:
        return _sort_bucket(table, parts)

    packed = sent_stretches(docs).groupBy("bucket").applyInArrow(sort_bucket, _PACKED)
    return packed.groupBy("part").applyInArrow(_by_row, _RUNS)


@giving_back
def _uncut(batches: Iterator[pa.RecordBatch], bits: bytes, as_text: bool) -> Iterator[pa.RecordBatch]:
    """Results of the rows that have no removed run for certain."""
    for batch in key_filter.chosen(batches, bits, present=False):
        none = pa.nulls(batch.num_rows, pa.list_(pa.binary()))
        yield from _cut(iter([pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), none], ["row", "text", "parts"])]), as_text)


def remove_repeats(
    docs: DataFrame, carry: tuple = ("doc_id",), as_text: bool = False
) -> DataFrame:
    """``row`` (the carried columns), ``n_bytes, n_removed, n_spans, kept`` (the remaining bytes).

    As text, ``kept`` goes without what is left of a character of which bytes were removed. Documents
    without removed runs are finished where they are read and not shuffled.
    """
    with temporary(docs.sparkSession):
        runs = materialize(removed_runs(docs), "runs", lasting=True)
    rows = _rows(docs, F.struct(*carry).alias("row"))
    rows = rows.select(F.xxhash64("id", "key").alias("at"), "row", "text", "id", "key")
    bits = key_filter.bits_of(runs.select(F.xxhash64("id", "key").alias("at")), "at")
    kind, body = rows.schema["row"].dataType.simpleString(), "string" if as_text else "binary"
    schema = f"row {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept {body}"
    whole = rows.mapInArrow(partial(_uncut, bits=bits, as_text=as_text), schema)
    some = rows.mapInArrow(
        partial(key_filter.chosen, bits=bits), f"at bigint, row {kind}, text string, id bigint, key bigint"
    )
    met = some.join(runs, ["id", "key"], "left")
    met = met.select("row", "text", F.when(F.col("runs").isNotNull(), F.array("runs")).alias("parts"))
    return whole.unionByName(met.mapInArrow(partial(_cut, as_text=as_text), schema))
