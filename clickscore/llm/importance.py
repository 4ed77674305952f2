"""Resampling towards a target distribution: hashed n-gram weights, Gumbel scores, a distributed radix sort.

Every text becomes its runs of one to three words, each in one of ``BUCKETS`` hash buckets.
The buckets' counts over all documents and over the target texts give a gain per bucket, an
array of fixed size that goes to every task; a document's weight is the sum of the gains of
its features.  Weight plus seeded Gumbel noise is the score, and the highest scores are drawn.

Scores are ranked by a least-significant-digit radix sort (``radix_positions``): one stable
counting-sort pass per digit of the composite key.  A pass counts the digits of every block
of rows, prefix sums over (digit, block) give each block's first destination per digit, and a
row's destination is that plus its place among the block's rows of the same digit.  The
destinations are the rows' positions in the next pass and, after the last one, their ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import small_batches, stored

BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 5
SEED = 42
#: Longest run of words that is a feature.
RUN = 3

#: Bits of one digit at most, and rows of one block of a counting pass.
DIGIT_BITS = 12
BLOCK_BITS = 14

POLYNOMIAL = 0xEDB88320
#: Words up to this many bytes take their checksum from a table of byte and distance to the end.
SHORT = 63


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


BYTES = _byte_table()


def _pushed(c: np.ndarray) -> np.ndarray:
    """Checksum registers after one more zero byte."""
    return BYTES[c & 0xFF] ^ (c >> np.uint32(8))


def _far() -> np.ndarray:
    """[distance to the word's end, byte]: what a byte adds to the register."""
    rows = [BYTES]
    for _ in range(SHORT):
        rows.append(_pushed(rows[-1]))
    return np.stack(rows)


def _shift_tables() -> np.ndarray:
    """[n, byte place, byte value]: that part of a register after ``n`` zero bytes, n <= SHORT + 1."""
    own = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    rows = [own]
    for _ in range(SHORT + 1):
        rows.append(_pushed(rows[-1]))
    return np.stack(rows)


FAR = _far()
SHIFT = _shift_tables()
ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(SHORT + 2)], np.uint32)


def _shifted(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums followed by ``n`` zero bytes, linear part only; long shifts in steps."""
    flat = SHIFT.reshape(-1)
    c, left = c.copy(), n
    while True:
        step = np.minimum(left, SHORT + 1)
        at = step * 1024
        c = (
            flat[at + (c & 0xFF)]
            ^ flat[at + 256 + ((c >> np.uint32(8)) & 0xFF)]
            ^ flat[at + 512 + ((c >> np.uint32(16)) & 0xFF)]
            ^ flat[at + 768 + (c >> np.uint32(24))]
        )
        left = left - step
        if not len(left) or int(left.max()) <= 0:
            return c
        if int(left.max()) > 64 * SHORT:
            return _shifted_far(c, left)


def _shifted_far(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The same for words of any length: 2**k zero bytes at a time for every bit of ``n``."""
    own = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    table = _pushed(own)
    while int(n.max()) > 0:
        odd = (n & 1).astype(bool)
        c = np.where(odd, _through(table, c), c)
        table, n = _through(table, table), n >> 1
    return c


def _through(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (
        table[0][c & 0xFF]
        ^ table[1][(c >> np.uint32(8)) & 0xFF]
        ^ table[2][(c >> np.uint32(16)) & 0xFF]
        ^ table[3][c >> np.uint32(24)]
    )


def word_checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each byte range: exclusive sums of the bytes' parts, one call for a longer word."""
    n = end - start
    out = np.zeros(len(n), np.uint32)
    short = np.flatnonzero(n <= SHORT)
    if len(short):
        size = n[short]
        at = T.spread(start[short], size)
        parts = FAR[np.repeat(end[short], size) - 1 - at, data[at]]
        out[short] = np.bitwise_xor.reduceat(parts, np.cumsum(size) - size) ^ ZEROS[size]
    for i in np.flatnonzero(n > SHORT):
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes())
    return out


def feature_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, T.Words]:
    """Bucket and row of every run of one to ``RUN`` words of the texts, with the words themselves.

    The checksum of a run is put together from those of its words: a checksum followed by
    ``n`` bytes is the checksum shifted by ``n`` zero bytes, exclusive-or that of the bytes.
    """
    data = T.LOWERED[data]
    w = T.words(data, offsets, T.LETTERS, hashed=False)
    crc = word_checksums(data, w.start, w.end)
    size = w.end - w.start
    joined = _shifted(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc
    found, rows, run = [crc], [w.row], crc
    for k in range(1, RUN):
        run = _shifted(run[:-1], size[k:] + 1) ^ joined[k:]
        inside = w.row[:-k] == w.row[k:] if len(w.row) > k else np.zeros(0, bool)
        found.append(run[inside])
        rows.append(w.row[k:][inside])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(rows), w


def _counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for _, data, offsets in T.chunked(batches):
        total += np.bincount(feature_buckets(data, offsets, buckets)[0], minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """How many features of all texts lie in each bucket; a task returns at most ``buckets`` rows."""
    rows = texts.select("text").mapInArrow(lambda it: _counts(it, buckets), "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: 1000 times the log ratio of its smoothed shares, floored."""
    spark = docs.sparkSession
    s, t = (
        bucket_counts(x, buckets).select("bucket", F.col("n").alias(n)) for x, n in ((docs, "s"), (target, "t"))
    )
    counts = (
        spark.range(buckets).select(F.col("id").alias("bucket"))
        .join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    )
    # The array has a fixed size, so it fits the driver and every task.
    rows = np.array([tuple(r) for r in counts.select("bucket", "s", "t").collect()], np.int64)
    s_n, t_n = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    s_n[rows[:, 0]], t_n[rows[:, 0]] = rows[:, 1], rows[:, 2]
    ratio = ((t_n + 1.0) * (s_n.sum() + float(buckets))) / ((s_n + 1.0) * (t_n.sum() + float(buckets)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches):
        bucket, row, w = feature_buckets(data, offsets, len(gains))
        n = batch.num_rows
        # Sums of these integers are exact in doubles.
        weight = np.bincount(row, gains[bucket], minlength=n).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(w.first).astype(np.int64)),
                pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                pa.array(weight),
            ],
            names=["doc_id", "n_words", "n_features", "weight"],
        )


def noise(seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a hash of the seed and the id; a NULL id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row of ``docs``."""
    small_batches(docs.sparkSession)
    gains = bucket_gains(docs, target, buckets)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(
        lambda it: _weights(it, gains), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    return rows.withColumn("score", F.col("weight") + noise(seed))


def _key_parts(low: int | None, high: int | None, value: Column, descending: bool) -> list[tuple[Column, int]]:
    """The value's distance from its first place in the order, as parts of (non-negative long, bits)."""
    if low is None or low == high:
        return []
    bits = (high - low).bit_length()
    if bits < 63:
        return [((F.lit(high) - value) if descending else (value - F.lit(low)), bits)]
    # Ranges beyond a long: upper and lower half of the value, the upper one moved to begin at zero.
    upper, lower = F.shiftright(value, 32) + (1 << 31), value.bitwiseAND(0xFFFFFFFF)
    parts = [(upper, 32), (lower, 32)]
    return [((F.lit(0xFFFFFFFF) - v, n) if descending else (v, n)) for v, n in parts]


def _digits(parts: list[tuple[Column, int]]) -> list[Column]:
    """Digits of the composite key, the least significant first; ``parts`` begin with the most significant."""
    out = []
    for value, bits in reversed(parts):
        passes = -(-bits // DIGIT_BITS)
        width = -(-bits // passes)
        out += [F.shiftright(value, i * width).bitwiseAND((1 << width) - 1).cast("int") for i in range(passes)]
    return out


def radix_positions(rows: DataFrame, order: list[tuple[str, bool]], name: str = "radix") -> DataFrame:
    """``rows`` with ``position`` 0, 1, 2... by ``order``, pairs of a long column and whether it descends.

    NULL comes last.  Rows that agree in all of ``order`` keep the order in which they were
    first written.  Rows are written with their position after every pass, so each pass starts
    from files; a block holds at most 2**BLOCK_BITS rows whatever the keys are, so that one
    key may hold all rows.
    """
    aggs = []
    for c, _ in order:
        aggs += [F.min(c), F.max(c), F.max(F.col(c).isNull().cast("int"))]
    # Numbered once when written; partition and place in it tell rows apart ever after.
    cur = stored(rows.withColumn("position", F.monotonically_increasing_id()), name)
    span = cur.agg(*aggs).first()
    parts: list[tuple[Column, int]] = []
    for i, (c, descending) in enumerate(order):
        low, high, nulls = span[3 * i : 3 * i + 3]
        if nulls and low is not None:
            parts.append((F.col(c).isNull().cast("long"), 1))
        worst = F.lit(low if descending else high)
        parts += _key_parts(low, high, F.coalesce(F.col(c), worst), descending)
    # A pass of one digit also turns the first numbers into positions without gaps.
    for digit in _digits(parts) or [F.lit(0)]:
        cur = stored(_counting_pass(cur, digit), name)
    return cur


def _counting_pass(cur: DataFrame, digit: Column) -> DataFrame:
    """One stable counting sort: positions by (digit, position)."""
    keys = ["digit", "block"]
    cut = cur.withColumns({"digit": digit, "block": F.shiftright("position", BLOCK_BITS)})
    counts = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # Prefix sums: blocks within a digit, then the digits, of which there are at most 2**DIGIT_BITS.
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    bases = totals.select("digit", (F.sum("n").over(W.orderBy("digit")) - F.col("n")).alias("base"))
    earlier = F.sum("n").over(W.partitionBy("digit").orderBy("block")) - F.col("n")
    first = counts.withColumn("earlier", earlier).join(bases, "digit").select(
        *keys, (F.col("base") + F.col("earlier")).alias("first")
    )
    local = F.row_number().over(W.partitionBy(*keys).orderBy("position")) - 1
    placed = cut.withColumn("local", local).join(first, keys)
    return placed.select(
        *[c for c in cur.columns if c != "position"], (F.col("first") + F.col("local")).cast("long").alias("position")
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``.

    ``rank`` is 1, 2, 3... for the ``percent`` of the documents with ``min_words`` words that
    have the highest scores, ties to the smaller ``doc_id`` and then in reading order, and NULL
    for the others.

    NULL, empty and wordless texts have no features, weight 0 and no rank.  A NULL ``doc_id``
    is written as empty text for the noise and comes last among equal scores.  Repeated rows
    are drawn one by one.  Texts of any length are read whole; other columns are ignored.
    Without documents the result is empty; without target texts all weights are as the smoothed
    counts give them.
    """
    scored = stored(weighted(docs, target, buckets, seed), "weights")
    fit = F.col("n_words") >= min_words
    ranked = radix_positions(scored.filter(fit), [("score", True), ("doc_id", False)])
    drawn = F.floor(percent * scored.filter(fit).count() / F.lit(100)).cast("long")
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    kept = ranked.withColumn("rank", rank).drop("position")
    return kept.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))


def op11(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


SQL = f"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, {POLYNOMIAL}) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS tab FROM steps WHERE k = 8),
texts AS (
  SELECT 0 AS side, doc_id AS id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark
), word_lists AS (
  SELECT side, id, r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), feats AS (
  SELECT side, r, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM word_lists
), grouped AS (SELECT side, r, f, count(*) AS n FROM feats GROUP BY ALL),
names AS (
  SELECT f, unhex_bytes FROM (SELECT DISTINCT f, [('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT
    FOR i IN range(strlen(f))] AS unhex_bytes FROM grouped)
), hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, unhex_bytes),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % {BUCKETS} AS bucket
  FROM names, crc
), counted AS (SELECT side, r, bucket, sum(n)::BIGINT AS n FROM grouped JOIN hashed USING (f) GROUP BY ALL),
totals AS (
  SELECT coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS big_s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS big_t
  FROM counted
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1.0::DOUBLE) * (big_s + {BUCKETS}.0::DOUBLE))
    / ((s + 1.0::DOUBLE) * (big_t + {BUCKETS}.0::DOUBLE))))::BIGINT AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s,
    coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM counted GROUP BY bucket), totals
), weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN gains USING (bucket) WHERE side = 0 GROUP BY r
), scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM word_lists LEFT JOIN weights USING (r) WHERE side = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
    count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) AS n FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= {MIN_WORDS} AND place <= {DRAW_PERCENT} * n // 100 THEN place::BIGINT END AS rank
FROM ranked
"""
