"""Find benchmark passages in training documents with an FM-index per shard.

The benchmark's windows are the query set; they are read in blocks of at most
``BLOCK_BYTES`` of benchmark text and each block meets all documents.  The driver holds one
block at a time; of several blocks the findings are written.  A task cuts its
documents into shards of a few MB, maps words to the block's vocabulary, indexes every
stretch of words that could hold a window, searches all windows backward through
wavelet-matrix ranks, locates the occurrences by sampled suffix positions and merges them to
removal spans.  Documents are never shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.fm_index import FmIndex
from clickscore.llm.frames import small_batches, stored

WINDOW = 13
#: The driver and a task take about 60 times a block while its windows are built.
BLOCK_BYTES = 1 << 20
MIN_HIT_SHARE = 20  # contaminated: 20 * n_hit >= n_words

FOUND = (
    "doc_id bigint, row_hash bigint, n_words bigint, "
    "items array<string>, span_start array<int>, span_end array<int>"
)
LISTS = {"items": "string", "span_start": "int", "span_end": "int"}
COUNTED = "doc_id bigint, row_hash bigint, n_words bigint"


@dataclass
class Windows:
    """Distinct windows of a block of items, right-aligned word numbers, and their items."""

    vocabulary: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    item_first: np.ndarray
    items: np.ndarray
    names: list[str]


def build_windows(rows: list[tuple[str, str]]) -> Windows | None:
    """Windows of (item name, text) rows: 13 consecutive words, or all of a shorter item."""
    column = pa.array([text for _, text in rows], type=pa.large_binary())
    data, offsets = T.buffers(column)
    w = T.words(data, offsets, T.LETTERS, T.LOWERED)
    vocabulary, number = np.unique(w.hash, return_inverse=True)
    count = np.diff(w.first)
    own = np.flatnonzero(count)
    if not len(own):
        return None
    each = np.maximum(count[own] - WINDOW + 1, 1)
    owner = np.repeat(own, each)
    end = T.spread(w.first[own] + np.minimum(count[own], WINDOW), each)
    place = end.astype(np.int32)[:, None] + np.arange(-WINDOW, 0, dtype=np.int32)
    inside = place >= w.first[owner].astype(np.int32)[:, None]
    every = np.where(inside, (number + 1).astype(np.int32)[np.maximum(place, 0)], np.int32(0))
    del place, inside
    # Numbers begin at 1, so the zeros before a shorter window tell its length.
    _, first_at, which = np.unique(every.view(f"V{4 * WINDOW}").ravel(), return_index=True, return_inverse=True)
    pairs = np.unique(which * len(rows) + owner)
    patterns = every[first_at]
    return Windows(
        vocabulary, patterns, np.count_nonzero(patterns, axis=1),
        np.searchsorted(pairs, np.arange(len(patterns) + 1) * len(rows)), pairs % len(rows), [n for n, _ in rows],
    )


def search_shard(w: T.Words, n_rows: int, win: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard: (first word, window length) and distinct (row, item) pairs."""
    none = np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(win.vocabulary, w.hash), len(win.vocabulary) - 1)
    known = win.vocabulary[at] == w.hash
    number = np.where(known, at + 1, 0).astype(np.int64)
    # Stretches of known words inside one row, long enough for the shortest window.
    same_row = np.concatenate(([False], w.row[1:] == w.row[:-1])) if len(w.row) else none.astype(bool)
    label = np.cumsum(~known | ~same_row)
    size = np.bincount(label[known], minlength=(label[-1] + 1 if len(label) else 1))
    used = np.flatnonzero(known & (size[label] >= win.lengths.min())) if len(label) else none
    if not len(used):
        return none, none, none, none
    ends = np.append(np.flatnonzero(np.diff(label[used])) + 1, len(used))
    text = np.insert(number[used], ends, 0)
    origin = np.insert(used, ends, -1)
    index = FmIndex(text, len(win.vocabulary))
    low, high = index.search(win.patterns, win.lengths)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    word = origin[index.locate(T.spread(low, count))]
    row = w.row[word]
    n_items = np.diff(win.item_first)
    distinct = np.unique(row * len(win.lengths) + window)
    d_row, d_window = distinct // len(win.lengths), distinct % len(win.lengths)
    owners = win.items[T.spread(win.item_first[d_window], n_items[d_window])]
    pairs = np.unique(np.repeat(d_row, n_items[d_window]) * len(win.names) + owners)
    return word, win.lengths[window], pairs // len(win.names), pairs % len(win.names)


def search_batches(batches: Iterator[pa.RecordBatch], win: Windows) -> Iterator[pa.RecordBatch]:
    names = np.array(win.names, dtype=object)
    for batch, data, offsets in T.chunked(batches):
        n = batch.num_rows
        w = T.words(data, offsets, T.LETTERS, T.LOWERED)
        word, length, row, item = search_shard(w, n, win)
        start, end = T.runs(T.cover(len(w.hash), word, word + length))
        # Neighbouring rows may touch: cut spans where a row ends.
        cuts = w.first[1:-1]
        if len(start):
            hit = T.cover(len(w.hash), start, end)
            edge = np.zeros(len(hit) + 1, bool)
            edge[cuts] = True
            opens = hit & (np.concatenate(([True], ~hit[:-1])) | edge[:-1])
            closes = hit & (np.concatenate((~hit[1:], [True])) | edge[1:])
            start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        span_row = w.row[start] if len(start) else np.zeros(0, np.int64)
        base = w.first[span_row]
        per_row = np.bincount(span_row, minlength=n)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(np.diff(w.first), pa.int64()),
                T.ragged(names[item], np.bincount(row, minlength=n), pa.string()),
                T.ragged((start - base).astype(np.int32), per_row, pa.int32()),
                T.ragged((end - base).astype(np.int32), per_row, pa.int32()),
            ],
            names=["doc_id", "row_hash", "n_words", "items", "span_start", "span_end"],
        )


def named_items(items: DataFrame) -> DataFrame:
    return items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def block_count(named: DataFrame) -> int:
    """In how many blocks of about ``BLOCK_BYTES`` the query set is read."""
    total = named.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    return -(-total // BLOCK_BYTES) or 1


def block_windows(named: DataFrame, i: int, n: int) -> Windows | None:
    """The windows of block ``i``, the items of a hash range; only these come to the driver."""
    block = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    return build_windows([tuple(r) for r in named.filter(block == i).toLocalIterator()])


def occurrences(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``n_words``, items with occurring windows, and merged hit spans.

    Spans are word ranges ``[span_start, span_end)`` of the lower-cased words; they are
    disjoint and sorted.  NULL and empty texts have no words.  Items without words have no
    window; items with equal ids count once.  Repeated rows get equal results.  Only
    ``doc_id`` and ``text`` are used, so other columns may have any name.  Texts of any
    length are searched whole; blocks are hash ranges of whole items, so a single item that is
    longer than a block makes one of its own length; empty tables give an empty result or no hits.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text")
    named = named_items(items)
    n = block_count(named)
    if n == 1:
        win = block_windows(named, 0, 1)
        if win:
            return rows.mapInArrow(lambda it: search_batches(it, win), FOUND)
    found = None
    for i in range(n if n > 1 else 0):
        win = block_windows(named, i, n)
        if win:
            # Written, so that the driver lets the block go before it reads the next one.
            hits = stored(rows.mapInArrow(lambda it, w=win: search_batches(it, w), FOUND).filter(F.size("span_start") > 0), "hits")
            found = found.union(hits) if found else hits
        del win
    counted = rows.mapInArrow(count_batches, COUNTED)
    if found is None:
        none = {c: F.array().cast(f"array<{kind}>") for c, kind in LISTS.items()}
        return counted.withColumns(none)
    return merged(found, counted)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches):
        n_words = np.diff(T.words(data, offsets, T.LETTERS, T.LOWERED).first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_words, pa.int64())], names=["doc_id", "row_hash", "n_words"]
        )


def merged(found: DataFrame, counted: DataFrame) -> DataFrame:
    """Every counted row with the findings of all blocks together."""
    words = F.transform(
        F.arrays_zip("span_start", "span_end"), lambda s: F.sequence(s["span_start"], s["span_end"] - 1)
    )
    one = found.select(
        F.col("doc_id").alias("own_id"), F.col("row_hash").alias("own_hash"), "items", F.flatten(words).alias("hit")
    )
    hit = F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit"))))
    both = one.groupBy("own_id", "own_hash").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), hit.alias("hit")
    )
    start = F.filter("hit", lambda x, i: (i == 0) | (F.get(F.col("hit"), i - 1) != x - 1))
    end = F.filter("hit", lambda x, i: (i == F.size("hit") - 1) | (F.get(F.col("hit"), i + 1) != x + 1))
    spans = both.select(
        "own_id", "own_hash", "items", start.alias("span_start"), F.transform(end, lambda x: x + 1).alias("span_end")
    )
    return counted.join(
        spans, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("row_hash") == F.col("own_hash")), "left"
    ).select(
        "doc_id", "row_hash", "n_words",
        *[F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c) for c, kind in LISTS.items()],
    )


def judge(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``occurrences`` with ``n_hit``, ``n_items`` and ``contaminated``."""
    hit = F.aggregate(
        F.transform(F.arrays_zip("span_start", "span_end"), lambda s: (s["span_end"] - s["span_start"]).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    found = occurrences(docs, items).withColumn("n_hit", hit)
    distinct = F.array_sort(F.array_distinct("items"))
    return found.withColumns(
        {
            "items": distinct,
            "n_items": F.size(distinct).cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (MIN_HIT_SHARE * F.col("n_hit") >= F.col("n_words")),
        }
    )


def op3(docs: DataFrame, items: DataFrame) -> DataFrame:
    return judge(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


SQL = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, w[i : i + 12] AS win FROM (
        SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT len(win) AS size FROM windows
), places AS (
    SELECT doc_id, i, size, w[i : i + size - 1] AS win FROM (
        SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM d, sizes WHERE len(w) >= size)
), hits AS (
    SELECT DISTINCT p.doc_id, p.i, p.size, w.item_id FROM places p JOIN windows w ON p.win = w.win
), words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM hits))
    GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
