"""Vectorised words and hashes of many texts at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 8 << 20

_codes = np.arange(256)
BLANK = (_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D))
#: Bytes of the words [^\x20\x09-\x0D]+.
PLAIN = ~BLANK
#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, once A-Z are lower-cased.
LETTERS = (_codes >= 0x80) | ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x61) & (_codes <= 0x7A))
SAME = _codes.astype(np.uint8)
LOWERED = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)

_random = np.random.default_rng(20240607)
BYTE_MIX = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_MIX = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a public counter-based generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """STEP to the powers 0..n-1, modulo 2**64."""
    out = np.full(max(n, 1), STEP, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    return column


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and where each begins (with one more end); NULL is empty."""
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return whole, offsets - offsets[0]


def chunked(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` bytes of text; a longer text makes a range of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = buffers(text_column(batch, text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield (
                batch.slice(start, stop - start),
                data[offsets[start] : offsets[stop]],
                offsets[start : stop + 1] - offsets[start],
            )
            start = stop


@dataclass
class Words:
    """Words in text order: byte range, 64-bit hash, and the row each lies in."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row: np.ndarray
    first: np.ndarray  # index of each row's first word, with one more end


def words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray | None = None, hashed: bool = True
) -> Words:
    if fold is not None:
        data = fold[data]
    n = len(data)
    part = inside[data]
    opens = part.copy()
    closes = part.copy()
    if n:
        opens[1:] &= ~part[:-1]
        closes[:-1] &= ~part[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        opens[edges] = part[edges]
        closes[edges - 1] = part[edges - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    length = end - start
    if hashed and len(start):
        kept = np.flatnonzero(part)
        at = kept - np.repeat(start, length)
        values = BYTE_MIX[data[kept]] * powers(int(length.max()))[at]
        begins = np.cumsum(length) - length
        value = mix(np.add.reduceat(values, begins) + length.astype(np.uint64))
    else:
        value = np.zeros(0, np.uint64)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, value, row, first)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words of one row, and the index of the first word."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.row[: n - k + 1] == w.row[k - 1 :])
    total = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        total += w.hash[i : n - k + 1 + i] * WORD_MIX[i]
    return mix(total[at]), at


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cover(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any of the ranges."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from values on end and the length of each list."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... count[0] values, then the same for the next range."""
    total = int(count.sum())
    before = np.cumsum(count) - count
    return np.arange(total) - np.repeat(before, count) + np.repeat(start, count)
