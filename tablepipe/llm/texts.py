"""Texts of an Arrow batch as words, without a Python object a word."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def words(column: pa.Array, classes: np.ndarray | None = None, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts in turn, as bytes; number of words of each text).

    ``classes``: a class for each of the 256 bytes; words are also cut between
    bytes of two classes over 0, and between any two of class 2.  ``lower``: A-Z
    become a-z."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)  # where a text begins
    edge[offsets] = True
    begins = edge[:-1] | ~np.concatenate([[True], ink[:-1]])
    if classes is not None and len(data):
        kind = classes[data]
        begins[1:] |= (kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
    first = ink & begins
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
    places = np.flatnonzero(first)
    kept = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
    np.cumsum(ink, out=kept[1:])
    bounds = np.append(kept[places], kept[-1])
    counts = np.diff(np.searchsorted(places, offsets))
    found = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[ink])])
    return found, counts


def pieces(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``most`` bytes of text, or one row."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(sizes), 0
        while at < len(sizes):
            base = total[at - 1] if at else 0
            to = max(int(np.searchsorted(total, base + most, side="right")), at + 1)
            yield b.slice(at, to - at)
            at = to


def slim(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving free memory back to the system when its
    task ends: Spark's Python workers live on, and what they hold counts against
    the tasks of later stages."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            import ctypes

            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim:
                trim(0)

    return wrapped
