"""Remove repeated word sequences by relative Lempel-Ziv parsing against reference blocks.

The segments of a block are the reference: an index of their word sequences in suffix order,
with the smallest document of any stretch of it at hand.  Every segment is factored
greedily: the longest match, from the place reached so far, with a reference text of a
smaller document.  A factor of at least a window's length is a duplicate span; windows that
cross a factor boundary are looked up on their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.fm_index import suffix_array
from clickscore.llm.repeats import Kind, removed

WINDOW = 13


class ReferenceBlock:
    """Longest matches with texts of smaller documents, for many places at once."""

    def __init__(self, text: np.ndarray, doc: np.ndarray):
        self.text = text
        self.order = suffix_array(text)
        self.least = [doc[self.order]]
        while (1 << len(self.least)) <= len(text):
            half = 1 << (len(self.least) - 1)
            low = self.least[-1]
            self.least.append(np.minimum(low[: len(low) - half], low[half:]))

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest document in each stretch [low, high) of the suffix order."""
        out = np.empty(len(low), np.int64)
        level = np.frexp(high - low)[1] - 1
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            row = self.least[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(k))])
        return out

    def bound(self, low, high, depth, word, after: bool) -> np.ndarray:
        """First suffix of a stretch whose word at ``depth`` is not below (or is above) ``word``."""
        low, high = low.copy(), high.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) >> 1
            found = self.text[self.order[mid] + depth[live]]
            less = found <= word[live] if after else found < word[live]
            low[live[less]] = mid[less] + 1
            high[live[~less]] = mid[~less]
            live = live[low[live] < high[live]]
        return low

    def longest(self, place: np.ndarray, doc: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the longest match from each place with a smaller document."""
        size = np.zeros(len(place), np.int64)
        live = np.flatnonzero(limit > 0)
        low, high = np.zeros(len(place), np.int64), np.full(len(place), len(self.text), np.int64)
        while len(live):
            word = self.text[place[live] + size[live]]
            a = self.bound(low[live], high[live], size[live], word, False)
            b = self.bound(a, high[live], size[live], word, True)
            ok = a < b
            ok[ok] = self.smallest(a[ok], b[ok]) < doc[live[ok]]
            live, a, b = live[ok], a[ok], b[ok]
            low[live], high[live] = a, b
            size[live] += 1
            live = live[size[live] < limit[live]]
        return size


def judge(bodies: pa.Array, doc: np.ndarray, start: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ranges of segments that lie in windows a smaller document holds."""
    data, offsets = T.buffers(bodies)
    w = T.words(data, offsets, T.PLAIN)
    n = len(bodies)
    if not len(w.hash):
        return (np.zeros(0, np.int64),) * 3
    number = np.unique(w.hash, return_inverse=True)[1] + 1
    count = np.diff(w.first)
    first = w.first[:-1] + np.arange(n)  # an end mark follows every segment
    text = np.zeros(len(number) + n, np.int64)
    text[T.spread(first, count)] = number
    order = np.unique(doc, return_inverse=True)[1]
    owner = np.repeat(order, count + 1)
    block = ReferenceBlock(text, owner)

    begins, lengths, rows = [], [], []
    at, live = np.zeros(n, np.int64), np.flatnonzero(count > 0)
    bounds: list[tuple[np.ndarray, np.ndarray]] = []
    while len(live):
        size = block.longest(first[live] + at[live], order[live], count[live] - at[live])
        long = size >= kind.window
        begins.append(at[live[long]])
        lengths.append(size[long])
        rows.append(live[long])
        step = np.maximum(size, 1)
        at[live] += step
        bounds.append((live, at[live].copy()))
        live = live[at[live] + kind.window <= count[live] + kind.window - 1]
        live = live[at[live] < count[live]]
    # Windows across a factor boundary: those that start less than a window before it.
    row = np.concatenate([np.repeat(r, kind.window - 1) for r, _ in bounds])
    place = np.concatenate([(b[:, None] - np.arange(1, kind.window)).ravel() for _, b in bounds])
    ok = (place >= 0) & (place + kind.window <= count[row])
    keys = np.unique(row[ok] * (int(count.max()) + 1) + place[ok])
    row, place = keys // (int(count.max()) + 1), keys % (int(count.max()) + 1)
    size = block.longest(first[row] + place, order[row], np.full(len(row), kind.window))
    found = size >= kind.window
    which = np.concatenate([*rows, row[found]])
    begin = np.concatenate([*begins, place[found]])
    upto = begin + np.concatenate([*lengths, np.full(int(found.sum()), kind.window)])
    covered = T.cover(len(text), first[which] + begin, first[which] + upto)
    begin, upto = T.runs(covered)
    which = np.searchsorted(first, begin, side="right") - 1
    return which, begin - first[which], upto - first[which]


def word_units(data: np.ndarray, offsets: np.ndarray):
    w = T.words(data, offsets, T.PLAIN)
    return w.hash, w.row, w.first, w.start, w.end


KIND = Kind("references", WINDOW, (4, 11, WINDOW), word_units, judge, by_start=False, block_bytes=4 << 20)
FIELDS = "n_words bigint, n_removed bigint, kept binary"


def finish(doc_id: pa.Array, data, offsets, first, begin, end, covered) -> pa.RecordBatch:
    """Join the words that are not covered by single spaces."""
    n = len(offsets) - 1
    count = np.diff(first)
    row = np.repeat(np.arange(n), count)
    gone = np.bincount(row, covered, minlength=n).astype(np.int64)
    left = np.flatnonzero(~covered)
    size = end[left] - begin[left]
    # One space after every kept word but a text's last.
    owner = row[left]
    more = np.append(owner[1:] == owner[:-1], False)[: len(left)]
    width = size + more
    flat = np.full(int(width.sum()), 0x20, np.uint8)
    flat[T.spread(np.cumsum(width) - width, size)] = data[T.spread(begin[left], size)]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, width, minlength=n).astype(np.int64))))
    body = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(flat)])
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(count.astype(np.int64)), pa.array(gone), body], names=["doc_id", "n_words", "n_removed", "kept"]
    )


def dedup(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """Every document without the words covered by 13-word windows of a smaller doc_id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are judged on the input.  Returns
    ``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` words joined by one space.

    NULL and empty texts have no words.  A NULL doc_id counts as smaller than all others.
    Rows that repeat a doc_id are one document and never remove each other's words.  Texts
    are read whole (up to 2**28 words each); an empty table gives an empty result.  Only
    ``doc_id`` and ``text`` are used.
    """
    return removed(docs, kind, finish, FIELDS)


def op4(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, w[i : i + 12] AS win FROM (
        SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)
), first AS (
    SELECT win, min(doc_id) AS first_doc FROM windows GROUP BY win HAVING count(DISTINCT doc_id) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i
    FROM windows JOIN first USING (win) WHERE doc_id > first_doc
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), kept AS (
    SELECT words.doc_id, count(gone.i) AS n_removed,
           string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS text
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
