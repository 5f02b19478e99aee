"""Runs of repeated words in documents, found in a grammar of the words.

A run is a stretch of words with a smallest period of q words, at least ``LEAST`` words and two
periods long, that cannot be extended. Every run has six words in a row that occur again q words
later, and such stretches cover it; so it lies within an island of words covered by stretches of
six that occur twice in the document. The rest of a text is not compressed: no run touches it.

Each island's word ids are compressed by Re-Pair, and what Re-Pair leaves is paired up into a balanced
tree, so that one nonterminal derives the island. A run crosses the boundary between the two
halves of the lowest nonterminal that derives all of it. So for each nonterminal, once, the runs
across its boundary are computed: for each period, how far equality with the words one period on
reaches to both sides of the boundary, by prefix hashes of the words at one place where the
nonterminal stands. The smallest period of a stretch is kept and compared word by word; a
nonterminal for which a hash lied is computed again without hashes. Stretches are translated to all
places of the derivation, and overlapping ones of one period are merged.

Queries of all nonterminals of a block of texts are answered together. Rows stay in the task that
read them, and memory is that of one block, or of one text that is longer.

Defined results: a null or empty text, or one of spaces, has no words and no runs, and collapses to
the empty text; equal rows are handled each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.llm.importance import blocks
from tonewright.llm.repair import compress

LEAST = 12
#: Words in a row that occur again one period later in any run: LEAST - q, or q, at least.
_SHARED = LEAST // 2
#: Periods that are tried at once.
_AT_ONCE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True

Run = tuple[int, int, int]


def scrambled(values: np.ndarray) -> np.ndarray:
    """A fixed 64-bit hash of each number."""
    x = (values.astype(np.uint64) + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """An id for each word of the texts, equal for equal words, and where each text's words begin."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = ~_SPACES[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    places = np.cumsum(inside, dtype=np.int32)
    offsets = np.append(places[starts] - 1, places[-1]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    coded = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = np.concatenate([[0], np.cumsum(starts)[ends - 1]])
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), begins


def islands(ids: np.ndarray, begins: np.ndarray) -> list[tuple[int, int]]:
    """Stretches covered by ``_SHARED`` words in a row that occur twice in their text."""
    n = len(ids) - _SHARED + 1
    if n < 2:
        return []
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    value = scrambled(ids)
    gram = scrambled(text[:n])
    for k in range(_SHARED):
        gram = gram * _BASE + value[k : k + n]
    inside = np.flatnonzero(text[:n] == text[_SHARED - 1 :])
    order = inside[np.argsort(gram[inside], kind="stable")]
    same = gram[order][1:] == gram[order][:-1]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    change = np.zeros(len(ids) + 1, dtype=np.int32)
    at = order[twice]
    change[at] += 1  # a place is in ``order`` once
    change[at + _SHARED] -= 1
    covered = np.cumsum(change[:-1]) > 0
    opens = covered.copy()
    opens[1:] &= ~covered[:-1] | (text[1:] != text[:-1])
    closes = covered.copy()
    closes[:-1] &= ~covered[1:] | (text[1:] != text[:-1])
    low, high = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long_enough = high - low >= LEAST
    return list(zip(low[long_enough].tolist(), high[long_enough].tolist(), strict=True))


class Nonterminals:
    """Nonterminals of at least ``LEAST`` words: sizes of both halves and all places."""

    def __init__(self):
        self.halves: list[tuple[int, int]] = []
        self.places: list[list[int]] = []

    def derive(self, ids: list[int], low: int) -> None:
        """Compresses the island that begins at ``low`` and adds its nonterminals."""
        dense: dict[int, int] = {}
        sequence = [dense.setdefault(i, len(dense)) for i in ids]
        rules, rest = compress(sequence, len(dense))
        terminals = len(dense)
        size = [1] * terminals
        for left, right in rules:
            size.append(size[left] + size[right])
        while len(rest) > 1:  # pairs of neighbours, level by level
            level = []
            for i in range(0, len(rest) - 1, 2):
                rules.append((rest[i], rest[i + 1]))
                size.append(size[rest[i]] + size[rest[i + 1]])
                level.append(len(size) - 1)
            rest = level + rest[len(level) * 2 :]
        stands: dict[int, list[int]] = {rest[0]: [low]}
        for x in range(len(size) - 1, terminals - 1, -1):  # a rule stands above those it uses
            at = stands.pop(x, None)
            if at is None:
                continue
            left, right = rules[x - terminals]
            a = size[left]
            self.halves.append((a, size[right]))
            self.places.append(at)
            if a >= LEAST:
                stands.setdefault(left, []).extend(at)
            if size[right] >= LEAST:
                stands.setdefault(right, []).extend([p + a for p in at])


class Equality:
    """How far words equal those some places on, by hashes of prefixes."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.power = np.cumprod(np.full(len(ids) + 1, _BASE))
        value = scrambled(ids) * self.power[:-1]
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value)])

    def reach(self, at: np.ndarray, period: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """For each place, the number of words from it on (``back``: before it) that equal the word
        one period later, up to ``limit``; a false hash may only make it too large."""
        out = np.zeros(len(at), dtype=np.int64)
        last = len(self.ids) - 1
        first = at - 1 if back else at
        match = self.ids[np.clip(first, 0, last)] == self.ids[np.clip(first + period, 0, last)]
        live = np.flatnonzero((limit > 0) & match)
        at, period, limit = at[live], period[live], limit[live]
        found = np.zeros(len(live), dtype=np.int64)
        step = 1 << int(limit.max(initial=1)).bit_length() - 1
        factor = self.power[period - 1]  # the base to the power of the period
        while step:
            fits = np.flatnonzero(found + step <= limit)
            low = at[fits] - found[fits] - step if back else at[fits] + found[fits]
            q = period[fits]
            here = (self.sums[low + step] - self.sums[low]) * factor[fits]
            equal = here == self.sums[low + q + step] - self.sums[low + q]
            found[fits[equal]] += step
            step >>= 1
        out[live] = found
        return out


def exact_stretches(ids: np.ndarray, low: int, a: int, b: int) -> list[Run]:
    """Stretches across one boundary without hashes: (start, end, smallest period)."""
    middle, high, best = low + a, low + a + b, {}
    for q in range((a + b) // 2, 0, -1):
        equal = ids[low : high - q] == ids[low + q : high]
        for i in {middle, middle - q}:
            if i < low or i + q > high:
                continue
            before, behind = equal[: i - low][::-1], equal[i - low :]
            back = len(before) if before.all() else int(before.argmin())
            reach = len(behind) if behind.all() else int(behind.argmin())
            if back + reach >= max(q, LEAST - q):
                best[i - back, i + q + reach] = q
    return [(s, e, q) for (s, e), q in best.items()]


def stretches(ids: np.ndarray, found: Nonterminals) -> Iterator[tuple[int, Run]]:
    """(nonterminal, (start, end, period)) of the stretches across each boundary, at its first place."""
    halves = np.array(found.halves, dtype=np.int64).reshape(-1, 2)
    first = np.array([at[0] for at in found.places], dtype=np.int64)
    most = halves.sum(axis=1) // 2
    equality = Equality(ids)
    ends = np.cumsum(most)
    begin = 0
    while begin < len(first):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - most[begin] + _AT_ONCE, side="right")))
        some = slice(begin, end)
        node = np.repeat(np.arange(begin, end), most[some])
        period = np.arange(len(node)) - np.repeat(np.cumsum(most[some]) - most[some], most[some]) + 1
        low, a = first[node], halves[node, 0]
        high = low + a + halves[node, 1]
        middle = low + a
        parts = []
        for at in (middle, middle - period):
            fits = np.flatnonzero((at >= low) & (at + period <= high))
            i, q, n = at[fits], period[fits], node[fits]
            reach = equality.reach(i, q, high[fits] - i - q, back=False)
            back = equality.reach(i, q, i - low[fits], back=True)
            long_enough = back + reach >= np.maximum(q, LEAST - q)
            parts.append(np.stack([n, i - back, i + q + reach, q])[:, long_enough])
        rows = np.concatenate(parts, axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
        if rows.shape[1]:
            same = (rows[:3, 1:] == rows[:3, :-1]).all(axis=0)
            rows = rows[:, np.concatenate([[True], ~same])]  # the smallest period of a stretch
        wrong: set[int] = set()
        kept = rows.T.tolist()
        for n, s, e, q in kept:
            if n not in wrong and not np.array_equal(ids[s : e - q], ids[s + q : e]):
                wrong.add(n)
        for n, s, e, q in kept:
            if n not in wrong:
                yield n, (s, e, q)
        for n in wrong:
            for run in exact_stretches(ids, int(first[n]), *found.halves[n]):
                yield n, run
        begin = end


def merged(intervals: set[Run]) -> list[Run]:
    """Maximal stretches: those of one period that share a period's words are one."""
    out: list[Run] = []
    for s, e, q in sorted(intervals, key=lambda x: (x[2], x[0], -x[1])):
        if out and out[-1][2] == q and s <= out[-1][1] - q:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e, q)
        else:
            out.append((s, e, q))
    return out


def find(texts: list[bytes]) -> list[list[Run]]:
    """For each text its runs as (start, length, period), by start, then period."""
    ids, begins = word_ids(texts)
    found = Nonterminals()
    for low, high in islands(ids, begins):
        found.derive(ids[low:high].tolist(), low)
    intervals: set[Run] = set()
    for n, (s, e, q) in stretches(ids, found):
        places = found.places[n]
        for at in places:
            by = at - places[0]
            intervals.add((s + by, e + by, q))
    out: list[list[Run]] = [[] for _ in texts]
    runs = merged(intervals)
    owner = np.searchsorted(begins, [s for s, _, _ in runs], side="right") - 1
    for (s, e, q), i in zip(runs, owner.tolist(), strict=True):
        out[i].append((s - int(begins[i]), e - s, q))
    for own in out:
        own.sort(key=lambda run: (run[0], run[2]))
    return out


def collapse(text: bytes, runs: list[Run]) -> bytes:
    """The words, joined by a space, without those behind the first period of a run."""
    words = text.split()
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs (start, length, period), collapsed (UTF-8)`` of every document."""
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    names = ["doc_id", "runs", "collapsed"]
    run_kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in blocks(batch.column(1).to_pylist()):
                runs = find(texts)
                flat = [r for own in runs for r in own]
                columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                values = pa.StructArray.from_arrays(columns, fields=list(run_kind))
                offsets = np.cumsum([0, *(len(own) for own in runs)]).astype(np.int32)
                collapsed = [collapse(t, own) for t, own in zip(texts, runs, strict=True)]
                arrays = [
                    batch.column(0).slice(begin, len(texts)),
                    pa.ListArray.from_arrays(pa.array(offsets), values),
                    pa.array(collapsed, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema)


def longest_first(a: Column, b: Column) -> Column:
    """Order of runs: the longest, then the first, then the smallest period."""
    return (
        F.when(a["length"] != b["length"], F.when(a["length"] > b["length"], -1).otherwise(1))
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .otherwise(F.signum(a["period"] - b["period"]).cast("int"))
    )


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for a tenth of the ids its words with a tail that repeats itself.

    With h the CRC-32 of the id and g = h / 10: from word g % n on, the words go round in a period of
    1 + (n - a) / (3 + g % 8) words.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    period = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    once = F.slice(words, a + 1, period)
    rounds = F.flatten(F.array_repeat(once, F.ceil((n - a) / period).cast("int")))
    tail = F.slice(rounds, F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)
