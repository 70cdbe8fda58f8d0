"""Texts of an Arrow batch as flat byte arrays, and their words.

The text operators read whole texts inside ``mapInArrow`` tasks.  A batch is cut into blocks of a
bounded number of text bytes (one longer text makes a block of its own), so the arrays a task
holds do not grow with the partition.  Words are found on UTF-8 bytes: every byte of a character
beyond ASCII is at least 0x80, so byte classes over ASCII are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: the characters of a word: digits, ASCII letters and everything beyond ASCII
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
#: everything but ASCII white space
SOLID_BYTE = np.ones(256, dtype=bool)
SOLID_BYTE[[0x20, 9, 10, 11, 12, 13]] = False


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts back to back, offsets); a null text is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    n, at = len(arr), arr.offset
    bufs = arr.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(bufs[1], np.int64, n + 1, at * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows whose texts hold at most ``max_bytes`` together."""
    for batch in batches:
        data, off = flat(batch.column(text))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def spans(data: np.ndarray, off: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of ``member`` bytes; no run crosses a text's end."""
    m = member[data]
    n = len(m)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start, end = m.copy(), m.copy()
    start[1:] &= ~m[:-1] | cut[1:n]
    end[:-1] &= ~m[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def distinct(data: np.ndarray, s: np.ndarray, e: np.ndarray, keep: np.ndarray | None = None):
    """(code per span, list of the distinct byte strings) of non-overlapping spans in order."""
    if not len(s):
        return np.zeros(0, np.int32), []
    if keep is None:
        mark = np.zeros(len(data) + 1, np.int8)
        mark[s] += 1
        mark[e] -= 1
        keep = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    body = np.ascontiguousarray(data[keep])
    off = np.zeros(len(s) + 1, np.int64)
    np.cumsum(e - s, out=off[1:])
    a = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s),
                                         [None, pa.py_buffer(off), pa.py_buffer(body)]).dictionary_encode()
    return a.indices.to_numpy(zero_copy_only=False), a.dictionary.to_pylist()


def words(data: np.ndarray, off: np.ndarray, member: np.ndarray = WORD_BYTE, lower: bool = True):
    """(code per word, row per word, distinct words as bytes), in reading order."""
    if lower:
        data = LOWER[data]
    s, e, row = spans(data, off, member)
    code, vocab = distinct(data, s, e, member[data])
    return code, row, vocab


def hash64(vocab: list[bytes], seed: int = 0) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w, seed) for w in vocab), np.uint64, len(vocab))


def row_starts(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Index of the first word of each row, and the number of words at the end."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, back to back."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(first - starts, counts)


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs ``values[bounds[i]:bounds[i+1]]`` as binary cells."""
    body = np.ascontiguousarray(values)
    off = (bounds * body.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(off), pa.py_buffer(body)])


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def per_block(fn: Callable, text: str = "text", max_bytes: int = BLOCK_BYTES) -> Callable:
    """A ``mapInArrow`` function from ``fn(rows, bytes, offsets) -> RecordBatch or None``."""
    def run(batches):
        for rows, data, off in blocks(batches, text, max_bytes):
            out = fn(rows, data, off)
            if out is not None:
                yield out
    return run
