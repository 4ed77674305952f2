"""Remove repeated byte strings with a collection suffix order built column by column.

A block's segments are a string collection, read in symbols of four bytes.  A suffix and the
one a symbol shorter belong to one chain; a string has a chain for each remainder of their
lengths.  Round j inserts, for every chain at once, the suffix of j symbols: its place
follows from the rank of its first symbol in the transform of the round before, and the
transform and the common prefixes of neighbours grow by one symbol per chain.  They live in
files that each round reads and writes from start to end.  Neighbours that share a window's
length of bytes are one group of equal windows.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.repeats import Kind, removed

WINDOW = 100
#: Bytes of a symbol; they and a length of up to 7 make a number of 64 bits.
WIDTH = 4


class Columns:
    """Arrays kept in files of a task's own folder, read and written whole in sequence."""

    def __init__(self, folder: str, **kinds: np.dtype):
        self.folder, self.kinds, self.turn = folder, kinds, dict.fromkeys(kinds, 0)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.{self.turn[name]}"

    def read(self, name: str) -> np.ndarray:
        return np.fromfile(self.path(name), self.kinds[name])

    def write(self, name: str, values: np.ndarray) -> None:
        """The next state is a file of its own; the one before goes."""
        if self.turn[name]:
            os.unlink(self.path(name))
        self.turn[name] += 1
        values.astype(self.kinds[name], copy=False).tofile(self.path(name))


def merge(old: np.ndarray, is_old: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(is_old), old.dtype)
    out[is_old] = old
    out[at] = values
    return out


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of the symbol at each byte, in symbol order; bytes and length of each code.

    A symbol that reaches beyond its string is cut there and comes before all longer ones
    that begin with it.  Code 0 is a string's end.
    """
    length = np.minimum(np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data)), WIDTH).astype(np.uint64)
    padded = np.append(data, np.zeros(WIDTH, np.uint8))
    value = np.zeros(len(data), np.uint64)
    for k in range(WIDTH):
        value = value << np.uint64(8) | padded[k : k + len(data)] * (length > k)
    values, code = np.unique(value << np.uint64(3) | length, return_inverse=True)
    values = np.append(np.uint64(0), values)
    return (code + 1).astype(np.uint32), values >> np.uint64(3), (values & np.uint64(7)).astype(np.int64)


def by_symbol(transform: np.ndarray) -> np.ndarray:
    """Rows sorted by symbol, then by row, without the ends."""
    key = transform.astype(np.uint64) << np.uint64(32) | np.arange(len(transform), dtype=np.uint64)
    key.sort()
    ends = len(key) - np.count_nonzero(transform)
    return (key[ends:] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def collection_order(data: np.ndarray, offsets: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all suffixes in collection order, and common prefixes up to ``cap``.

    A place is the suffix's first byte plus its string's number, so that the end of each
    string has a place too.
    """
    n_strings = len(offsets) - 1
    code, value, length = symbols(data, offsets)
    code = np.append(code, np.uint32(0))
    # A chain is as if its string ended so far behind its end that whole symbols remain.
    beyond = np.repeat(np.arange(WIDTH), n_strings)
    string = np.tile(np.arange(n_strings), WIDTH)
    end = offsets[1:][string] + beyond
    size = (np.diff(offsets)[string] + beyond) // WIDTH
    n = len(size)

    def symbol(chain: np.ndarray, j: int) -> np.ndarray:
        """First symbol of each chain's suffix of ``j`` symbols, or its end."""
        return np.where(size[chain] >= j, code[np.maximum(end[chain] - WIDTH * j, 0)], 0)

    row = np.arange(n)
    with tempfile.TemporaryDirectory(prefix="columns-") as folder:
        files = Columns(folder, transform=np.uint32, shared=np.uint8)
        files.write("transform", symbol(row, 1))
        files.write("shared", np.zeros(n))
        for j in range(1, int(size.max(initial=0)) + 1):
            transform, shared = files.read("transform"), files.read("shared")
            # The suffix at row n + i goes on at row tail[i] of the round before.
            tail = by_symbol(transform)
            live = np.flatnonzero(size >= j)
            owner = np.full(len(transform), -1, np.int32)
            owner[row[live]] = live
            chain = owner[tail]
            at = np.flatnonzero(chain >= 0)
            chain, at = chain[at], at + n
            row[chain] = at
            is_old = np.ones(n + len(tail), bool)
            is_old[at] = False
            files.write("transform", merge(transform, is_old, at, symbol(chain, j + 1)))
            joined = merge(shared, is_old, at, 0)
            # Common prefixes of pairs of neighbours of which one is new.
            touched = ~is_old
            touched[1:] |= ~is_old[:-1]
            touched[: n + 1] = False
            low = np.flatnonzero(touched)
            left, right = tail[low - 1 - n], tail[low - n]
            a, b = transform[left], transform[right]
            same = a == b
            joined[low[~same]] = equal_bytes(a[~same], b[~same], value, length)
            pairs = np.stack([left[same] + 1, right[same] + 1], axis=1).ravel()
            if len(pairs):
                least = np.minimum.reduceat(np.append(shared, np.uint8(255)), pairs)[::2]
                joined[low[same]] = np.minimum(least + length[a[same]], cap)
            files.write("shared", joined)
        transform, shared = files.read("transform"), files.read("shared")
    # From its end, each chain is followed through the finished order.
    above = np.empty(len(transform), np.int64)
    above[by_symbol(transform)] = np.arange(n, len(transform))
    place = np.empty(len(transform), np.int64)
    row = np.arange(n)
    place[row] = end + string
    for j in range(1, int(size.max(initial=0)) + 1):
        live = np.flatnonzero(size >= j)
        row[live] = above[row[live]]
        place[row[live]] = end[live] - WIDTH * j + string[live]
    one_end = np.append(np.arange(n_strings), np.arange(n, len(place)))
    return place[one_end], shared[one_end]


def equal_bytes(a: np.ndarray, b: np.ndarray, value: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes that two symbols have in common from their beginning."""
    apart = value[a] ^ value[b]
    common = sum((apart < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(WIDTH))
    return np.minimum(common, np.minimum(length[a], length[b]))


def judge(bodies: pa.Array, doc: np.ndarray, start: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of segments that lie in windows which start earlier elsewhere."""
    data, offsets = T.buffers(bodies)
    if len(bodies) < 1:
        return (np.zeros(0, np.int64),) * 3
    place, shared = collection_order(data, offsets, kind.window)
    ends = offsets[1:] + np.arange(len(bodies))
    of = np.searchsorted(ends, place)
    at = place - of - offsets[of]
    full = offsets[of + 1] - offsets[of] - at >= kind.window
    group = np.cumsum(shared < kind.window)[full]
    of, at = of[full], at[full]
    by = np.lexsort((start[of] + at, doc[of], group))
    g, d, p = group[by], doc[of][by], (start[of] + at)[by]
    head = np.concatenate(([True], g[1:] != g[:-1]))
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = by[(d != d[first]) | (p != p[first])]
    flat = np.zeros(len(data), bool)
    flat[offsets[of[again]] + at[again]] = True
    # Covered ranges: stretches of repeated window starts, each with a window's length.
    lead = np.flatnonzero(flat)
    row = np.searchsorted(offsets, lead, side="right") - 1
    opens = np.concatenate(([True], (lead[1:] - lead[:-1] > kind.window) | (row[1:] != row[:-1])))[: len(lead)]
    begin = lead[opens]
    upto = np.append(lead[np.flatnonzero(opens)[1:] - 1], lead[-1:]) + kind.window
    which = row[opens]
    return which, begin - offsets[which], upto - offsets[which]


def byte_units(data: np.ndarray, offsets: np.ndarray):
    begin = np.arange(len(data))
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    return T.BYTE_MIX[data], row, offsets, begin, begin + 1


# Chunks and blocks are so small that the arrays made of them stay in a core's cache.
KIND = Kind(
    "suffixes", WINDOW, (32, 90, WINDOW), byte_units, judge, by_start=True,
    block_bytes=256 << 10, step_bytes=512 << 10, chunk_bytes=128 << 10,
)
FIELDS = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def finish(doc_id: pa.Array, data, offsets, first, begin, end, covered) -> pa.RecordBatch:
    """Cut the covered bytes out of every text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    gone = np.bincount(np.repeat(np.arange(n), size), covered, minlength=n).astype(np.int64)
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(covered)]
    opens[edges] = covered[edges]
    n_spans = np.bincount(np.searchsorted(offsets, np.flatnonzero(opens), side="right") - 1, minlength=n)
    kept = data[~covered]
    bounds = np.concatenate(([0], np.cumsum(size - gone)))
    body = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(kept)])
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(size, pa.int64()), pa.array(gone), pa.array(n_spans.astype(np.int64)), body],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
    )


def dedup(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """Every document without the bytes covered by 100-byte strings that also start earlier.

    Earlier means a smaller doc_id, or the same document and an earlier start; overlapping
    strings count, and strings are judged on the input.  Returns ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and the ``kept`` bytes.

    NULL and empty texts have no bytes.  A NULL doc_id counts as smaller than all others.
    Rows that repeat a doc_id are one document: equal starts do not remove each other, so
    repeated rows get equal results.  Texts are read whole (up to 2**28 bytes each); an empty
    table gives an empty result.  Only ``doc_id`` and ``text`` are used.
    """
    return removed(docs, kind, finish, FIELDS)


def op1(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
