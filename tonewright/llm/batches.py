"""Bounded memory in tasks: batches cut by bytes, and memory given back when a task has ended."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc


def cuts(sizes: Sequence[int], rows: int, size: int) -> Iterator[tuple[int, int]]:
    """``(begin, end)`` of consecutive parts of at most ``rows`` rows and ``size`` altogether; a row
    that is larger by itself is a part of its own."""
    begin = held = 0
    for at, n in enumerate(sizes):
        if at > begin and (at - begin >= rows or held + n > size):
            yield begin, at
            begin, held = at, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def parts(batch: pa.RecordBatch, column: int, rows: int = 2000, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded bytes in a column of texts."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for begin, end in cuts(sizes, rows, size):
        yield batch.slice(begin, end - begin)


def give_back() -> None:
    """Returns memory that allocators keep for later; Spark's Python workers outlive their tasks, and
    the next one in line may belong to another operator."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_HELD: dict[tuple, object] = {}


def sole(key: tuple, build: Callable[[], object]) -> object:
    """What an operator keeps in a worker from task to task, such as a model. A worker keeps one of
    these: when another operator comes, the last one's is dropped."""
    if key not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[key] = build()
    return _HELD[key]


def giving_back(function: Callable) -> Callable:
    """A function on batches that gives memory back after its last one."""

    @wraps(function)
    def run(batches, *args, **kwargs):
        try:
            yield from function(batches, *args, **kwargs)
        finally:
            give_back()

    return run


def giving_back_after(function: Callable) -> Callable:
    """The same for a function on one group, whose result is a whole."""

    @wraps(function)
    def run(*args, **kwargs):
        try:
            return function(*args, **kwargs)
        finally:
            give_back()

    return run
