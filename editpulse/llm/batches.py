"""Words of Arrow text batches as integer codes, for use inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts that are worked on together inside one task; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


class Words(NamedTuple):
    """codes[offsets[i]:offsets[i + 1]] are the words of text i, as positions in ``vocabulary``."""

    codes: np.ndarray
    offsets: np.ndarray
    vocabulary: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column without nulls (null: empty), with 64-bit offsets from 0.

    Offsets are moved here because some Arrow kernels read those of a slice as if it were whole.
    """
    texts = pc.fill_null(batch.column(column), "")
    if not len(texts):
        return pa.array([], pa.large_string())
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    own = (data or pa.py_buffer(b"")).slice(int(ends[0]), int(ends[-1] - ends[0]))
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), own)


def give_back() -> None:
    """For the end of a task: workers live on beside the JVM, so what Arrow's and C's allocators keep for later goes back."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``most`` bytes of text, so that memory is bounded by the longest text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(texts_of(batch, column)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values and offsets from 0 of a list array without nulls."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def words(texts: pa.Array) -> Words:
    """Words are the runs of characters other than space and U+0009 to U+000D."""
    values, offsets = flat(pc.ascii_split_whitespace(texts))
    encoded = values.dictionary_encode()
    codes, vocabulary = encoded.indices.to_numpy(), encoded.dictionary
    empty = pc.index(vocabulary, pa.scalar("", vocabulary.type)).as_py()
    if empty >= 0:
        real = codes != empty
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        codes = codes[real]
    return Words(codes, offsets, vocabulary)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each (start, count), one after another."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each run of equal integer ``keys``, one table a run; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = tuple(key[:, a])
            if held and own != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
