"""Jaccard join of word-shingle sets: fixed-size subsets for light sets, inverted lists for heavy.

Equal sets are collapsed first.  Light sets (up to a boundary size chosen from the cost of
both ways on the sizes at hand) list every subset of the size that a linked pair must share.
Heavy sets enter inverted lists of the few tokens, first in one order of all tokens, of
which a linked pair must share one; tokens that many sets would list, counted over the whole table,
come last in that order, so that lists stay short at any number of documents.  Short lists are
joined, with size and position bounds, and what is left
is checked by a sketch that bounds the overlap, then exactly.  Sets that meet in a long list
form families; a family is cut into blocks, pairs of blocks are tested inside tasks,
and a task returns one row per set, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import small_batches, stored
from clickscore.llm.graph import components
from clickscore.llm.repeats import doc_order


@dataclass(frozen=True)
class Limits:
    """Words of a shingle, and per cent of the union that the intersection has at least.

    The smaller of two linked sets has at least ``percent`` of the larger one's size.
    """

    shingle: int
    percent: int

    @property
    def need(self) -> int:
        """100 * intersection >= percent * union is of * intersection >= need * (sum of sizes)."""
        return self.percent // gcd(self.percent, 100 + self.percent)

    @property
    def of(self) -> int:
        return (100 + self.percent) // gcd(self.percent, 100 + self.percent)


#: The contract of op9.
OP9 = Limits(shingle=4, percent=85)

#: A token that more documents than this list comes last in the order of tokens.  Where that holds
#: for more than HOT_MOST tokens, twice the number counts, and so on: every task holds the hot ones.
HOT_LEAST = 40
HOT_MOST = 500_000
#: Documents whose listed tokens one task counts, and tokens that are held before they are sent.
COUNTED_DOCS = 5000
HELD_TOKENS = 2_000_000
#: Sizes for which subsets are considered at all, and what one list entry costs in subsets.
LIGHT_LIMIT = 20
SCAN_COST = 8
#: Longest list whose pairs are joined; longer ones make families.
SHORT_LIST = 256
#: Tokens of a family's sets that one block holds.
BLOCK_TOKENS = 200_000
SKETCH = 256
CHUNK_BYTES = 4 << 20

COUNTS = "bucket int, value binary, n binary"
PROFILE = "kind int, value bigint, n bigint"
SETS = "doc bigint, n int, s1 bigint, s2 bigint, n_light int, keys array<bigint>, sketch binary"
TOKENS = "doc bigint, n int, s1 bigint, s2 bigint, tokens array<bigint>"
LINKED = "a bigint, b bigint, n_links bigint"


def required(n: int, m: int, lim: Limits = OP9) -> int:
    """Shared tokens that sets of these sizes need to be linked."""
    return -(-lim.need * (n + m) // lim.of)


def listed(n, lim: Limits = OP9):
    """How many tokens of a set of ``n``, first in order, go to inverted lists."""
    return n - (-(-lim.percent * n // 100)) + 1


def subset_sizes(n: int, lim: Limits = OP9) -> list[int]:
    """Sizes of the subsets that a set of ``n`` may have to share with a partner."""
    sizes = {required(n, m, lim) for m in range(-(-lim.percent * n // 100), 100 * n // lim.percent + 1)}
    return sorted(c for c in sizes if c <= n)


def subset_count(n: int, lim: Limits = OP9) -> int:
    return sum(comb(n, c) for c in subset_sizes(n, lim))


def boundary(sizes: dict[int, int], lim: Limits = OP9) -> int:
    """Largest light size: where listing subsets costs less than scanning lists."""

    def cost(x: int) -> int:
        light = sum(k * subset_count(n, lim) for n, k in sizes.items() if n <= x)
        # Sets close below the boundary may have heavy partners and use both ways.
        return light + sum(SCAN_COST * k * listed(n, lim) for n, k in sizes.items() if 100 * n > lim.percent * x)

    return min(range(LIGHT_LIMIT + 1), key=lambda x: (cost(x), x))


def sets_of(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of every text on end, and where each text's begin."""
    w = T.words(data, offsets, T.PLAIN, T.LOWERED)
    token, at = T.shingles(w, shingle)
    row = w.row[at] if len(at) else at
    count = np.diff(w.first)
    few = np.flatnonzero((count > 0) & (count < shingle))
    if len(few):
        lone = count[few].astype(np.uint64) * T.WORD_MIX[50]
        for i in range(shingle - 1):
            has = count[few] > i
            lone[has] += w.hash[w.first[few[has]] + i] * T.WORD_MIX[51 + i]
        token, row = np.concatenate((token, T.mix(lone))), np.concatenate((row, few))
    by = np.lexsort((token, row))
    token, row = token[by], row[by]
    if len(token):
        new = np.concatenate(([True], (token[1:] != token[:-1]) | (row[1:] != row[:-1])))
        token, row = token[new], row[new]
    return token, np.searchsorted(row, np.arange(len(offsets)))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[first[1:]] - total[first[:-1]]


def identity(token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share."""
    salted = token ^ np.uint64(0x5DEECE66D)
    return T.mix(sums(T.mix(token), first)).view(np.int64), T.mix(sums(T.mix(salted), first)).view(np.int64)


def profile_batches(batches: Iterator[pa.RecordBatch], buckets: int, lim: Limits) -> Iterator[pa.RecordBatch]:
    """Set sizes (bucket -1), and the listed tokens of a task's documents with counts, by hash buckets."""
    sizes = np.zeros(LIGHT_LIMIT * 2 + 1, np.int64)
    held: list[np.ndarray] = []

    def rows(bucket: list[int], value: list[np.ndarray], n: list[np.ndarray]) -> pa.RecordBatch:
        cells = [pa.array([x.astype(np.int64).tobytes() for x in c], pa.binary()) for c in (value, n)]
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *cells], names=["bucket", "value", "n"])

    def counted() -> pa.RecordBatch:
        tokens, count = np.unique(np.concatenate(held), return_counts=True)
        bucket = (tokens % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        used, first = np.unique(bucket[by], return_index=True)
        parts = (np.split(x[by], first[1:]) for x in (tokens.view(np.int64), count))
        return rows(used.tolist(), *parts)

    for _, data, offsets in T.chunked(batches, size=CHUNK_BYTES):
        token, first = sets_of(data, offsets, lim.shingle)
        n = np.diff(first)
        sizes += np.bincount(n[n < len(sizes)], minlength=len(sizes))
        fresh = np.setdiff1d(np.unique(identity(token, first)[0], return_index=True)[1], np.flatnonzero(n == 0))
        held.append(token[T.spread(first[fresh], listed(n[fresh], lim))])
        if sum(map(len, held)) > HELD_TOKENS:
            yield counted()
            held.clear()
    if sum(map(len, held)):
        yield counted()
    used = np.flatnonzero(sizes)
    if len(used):
        yield rows([-1], [used], [sizes[used]])


def profile_counts(table: pa.Table, least: int) -> pa.Table:
    """One bucket's numbers added up: set sizes (kind 0), or tokens that more than ``least`` documents list (kind 1)."""
    value, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("value", "n"))
    value, at = np.unique(value, return_inverse=True)
    total = np.zeros(len(value), np.int64)
    np.add.at(total, at, n)
    kind = int(table.column("bucket")[0].as_py() >= 0)
    kept = total > least * kind
    return pa.table({"kind": np.full(kept.sum(), kind, np.int32), "value": value[kept], "n": total[kept]})


def hot_cut(often: DataFrame) -> int:
    """The least of ``HOT_LEAST`` and its doubles that at most ``HOT_MOST`` tokens exceed."""
    level = F.length(F.bin(F.floor((F.col("n") - 1) / HOT_LEAST).cast("long")))  # n > HOT_LEAST * 2 ** (level - 1)
    found = {r["level"]: r["count"] for r in often.groupBy(level.alias("level")).count().collect()}  # a row per level
    return next(HOT_LEAST << x for x in range(64) if sum(k for at, k in found.items() if at > x) <= HOT_MOST)


def subset_keys(token: np.ndarray, first: np.ndarray, rows: np.ndarray, lim: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all required subsets of the given sets, and the set of each."""
    n = np.diff(first)[rows]
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for size in np.unique(n).tolist():
        own = rows[n == size]
        values = T.mix(token[first[own][:, None] + np.arange(size)] ^ np.uint64(0xB5297A4D))
        total = values.sum(axis=1, dtype=np.uint64)
        for c in subset_sizes(size, lim):
            salt = np.array([c], np.uint64) * T.STEP
            out = np.array(list(combinations(range(size), size - c)), np.int64).reshape(comb(size, c), size - c)
            less = total[:, None] - values[:, out].sum(axis=2, dtype=np.uint64)
            keys.append(T.mix(less + salt).ravel())
            owners.append(np.repeat(own, len(out)))
    return np.concatenate(keys), np.concatenate(owners)


def set_batches(batches: Iterator[pa.RecordBatch], hot: np.ndarray, light: int, lim: Limits) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches, size=CHUNK_BYTES):
        rows = batch.num_rows
        token, first = sets_of(data, offsets, lim.shingle)
        n = np.diff(first)
        row = np.repeat(np.arange(rows), n)
        s1, s2 = identity(token, first)
        # The order of tokens: hot ones last, else by hash.
        at = np.minimum(np.searchsorted(hot, token), max(len(hot) - 1, 0))
        late = hot[at] == token if len(hot) else np.zeros(len(token), bool)
        by = np.argsort(row * 2 + late, kind="stable")
        heavy = np.flatnonzero(100 * n > lim.percent * light)
        count = listed(n[heavy], lim)
        prefix, prefix_row = token[by][T.spread(first[heavy], count)], np.repeat(heavy, count)
        subset, subset_row = subset_keys(token, first, np.flatnonzero((n > 0) & (n <= light)), lim)
        order = np.argsort(np.concatenate((subset_row * 2, prefix_row * 2 + 1)), kind="stable")
        keys = np.concatenate((subset, prefix))[order].view(np.int64)
        n_light = np.bincount(subset_row, minlength=rows)
        buckets = np.bincount(row * SKETCH + (token >> np.uint64(56)).astype(np.int64), minlength=rows * SKETCH)
        flat = np.minimum(buckets, 65535).astype(np.uint16)
        places = np.arange(rows + 1, dtype=np.int32) * (SKETCH * 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(n.astype(np.int32)), pa.array(s1), pa.array(s2), pa.array(n_light.astype(np.int32)),
                T.ragged(keys, n_light + np.bincount(prefix_row, minlength=rows), pa.int64()),
                pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(places), pa.py_buffer(flat)]),
            ],
            names=["doc", "n", "s1", "s2", "n_light", "keys", "sketch"],
        )


def token_batches(batches: Iterator[pa.RecordBatch], lim: Limits) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches, size=CHUNK_BYTES):
        token, first = sets_of(data, offsets, lim.shingle)
        s1, s2 = identity(token, first)
        n = np.diff(first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n.astype(np.int32)), pa.array(s1), pa.array(s2), T.ragged(token.view(np.int64), n, pa.int64())],
            names=["doc", "n", "s1", "s2", "tokens"],
        )


def sketch_batches(batches: Iterator[pa.RecordBatch], lim: Limits) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow enough shared tokens; full counters allow any."""
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, SKETCH) for i in (4, 5)
        )
        most = np.minimum(left, right).sum(axis=1, dtype=np.int64)
        full = (left == 65535).any(axis=1) & (right == 65535).any(axis=1)
        size = np.asarray(batch.column(2), np.int64) + np.asarray(batch.column(3), np.int64)
        yield pa.RecordBatch.from_arrays(
            [x.filter(pa.array((lim.of * most >= lim.need * size) | full)) for x in batch.columns[:2]], names=["a", "b"]
        )


def block_links(table: pa.Table, lim: Limits) -> pa.Table:
    """Links between two blocks of a family (or inside one): a root and a count per set."""
    table = table.combine_chunks()
    node, weight, part = (table.column(c).to_numpy() for c in ("node", "weight", "part"))
    within = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    lists = table.column("tokens").combine_chunks()
    size = np.asarray(lists.value_lengths(), np.int64)
    row = np.repeat(np.arange(len(node)), size)
    token = np.unique(np.asarray(lists.flatten()), return_inverse=True)[1]
    by = np.argsort(token, kind="stable")
    posting, edge = row[by], np.concatenate(([0], np.cumsum(np.bincount(token))))
    begin = np.cumsum(size) - size
    parent = np.arange(len(node))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = np.zeros(len(node), np.int64)
    for x in range(len(node)):
        own = token[begin[x] : begin[x] + size[x]]
        both = np.bincount(posting[T.spread(edge[own], edge[own + 1] - edge[own])], minlength=len(node))
        linked = (lim.of * both >= lim.need * (size[x] + size)) & (node != node[x])
        if not within:
            linked &= part != part[x]
        found = np.flatnonzero(linked)
        links[x] = weight[found].sum()
        for y in found[found > x].tolist():
            parent[root(y)] = root(x)
    roots = np.array([root(x) for x in range(len(node))], np.int64)
    low = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(low, roots, node)
    some = np.flatnonzero(links > 0)
    return pa.table({"a": node[some], "b": low[roots[some]], "n_links": links[some]})


def families(long_rows: DataFrame) -> DataFrame:
    """Sets that meet in long lists, directly or through others: ``(node, family)``."""
    low = long_rows.groupBy("key").agg(F.min("node").alias("low"))
    stars = long_rows.join(low, "key").select(F.col("node").alias("a"), F.col("low").alias("b"))
    alone = stars.select(F.col("b").alias("node"), F.col("b").alias("label"))
    found = components(stars)
    return stored(found.unionByName(alone).groupBy("node").agg(F.min("label").alias("family")), "families")


def family_links(members: DataFrame, reps: DataFrame, tokens: DataFrame, lim: Limits) -> DataFrame:
    """Links inside families from pairs of blocks, as rows ``LINKED``."""
    own = members.join(reps.select("node", "weight", "n"), "node")
    size = own.groupBy("family").agg(F.ceil(F.sum("n") / F.lit(BLOCK_TOKENS)).cast("int").alias("parts"))
    placed = own.join(size, "family").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    held = placed.join(tokens.select("node", "tokens"), "node").select("family", "node", "weight", "part", "parts", "tokens")
    pairs = held.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "family", F.least("part", "x").alias("i"), F.greatest("part", "x").alias("j"), "node", "weight", "part", "tokens"
    )
    return pairs.groupBy("family", "i", "j").applyInArrow(lambda t: block_links(t, lim), LINKED)


def join(docs: DataFrame, lim: Limits) -> DataFrame:
    """``classes`` without what only tells rows apart: ``doc_id, n_shingles, component_id, n_links``."""
    return classes(docs, lim).select("doc_id", "n_shingles", "component_id", "n_links")


def classes(docs: DataFrame, lim: Limits) -> DataFrame:
    """Class and number of links of every row, with its ``row_hash`` and its class's ``component``.

    A set holds the distinct shingles of ``lim.shingle`` words of a text (A-Z lower-cased; a
    shorter text is one shingle as a whole).  Rows link when the intersection is at least
    ``lim.percent`` per cent of the union.
    ``component_id`` is the smallest doc_id reachable by links, ``n_links`` the number of
    other rows linked directly.

    NULL and empty texts have an empty set and link with nothing.  A NULL doc_id counts as
    the smallest and gives a NULL ``component_id``.  Repeated rows have equal sets and so
    link; rows that share a doc_id but not a text are judged row by row, so two classes may
    have one ``component_id``: ``component`` tells them apart (NULL for an empty set).  Ties
    at the limit link.  Texts of any length are read whole; an empty table gives an empty result.  Only
    ``doc_id`` and ``text`` are used.
    """
    small_batches(docs.sparkSession)
    base = docs.select(doc_order(F.col("doc_id")).alias("doc"), "text")
    text = base.select("doc", "text")

    buckets, least = 1 + docs.count() // COUNTED_DOCS, HOT_LEAST
    counts = text.mapInArrow(lambda it: profile_batches(it, buckets, lim), COUNTS)
    profile = stored(counts.groupBy("bucket").applyInArrow(lambda t: profile_counts(t, least), PROFILE), "profile")
    sizes = {r["value"]: r["n"] for r in profile.filter("kind = 0").toLocalIterator()}
    often = profile.filter("kind = 1")
    most = often.filter(F.col("n") > hot_cut(often)).select("value")  # HOT_MOST rows at most
    hot = np.sort(np.array([r[0] for r in most.toLocalIterator()], np.int64).view(np.uint64))
    light = boundary(sizes, lim)

    sets = text.mapInArrow(lambda it: set_batches(it, hot, light, lim), SETS)
    reps = stored(
        sets.filter("n > 0").groupBy("s1", "s2", "n").agg(
            F.min("doc").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("n_light").alias("n_light"),
            F.first("keys").alias("keys"), F.first("sketch").alias("sketch"),
        ).withColumn("node", F.monotonically_increasing_id()),  # several sets may have one rep
        "sets",
    )
    entries = reps.select("node", "n", "n_light", F.posexplode("keys").alias("at", "key")).select(
        "node", "n", (F.col("at") - F.col("n_light")).alias("at"), "key"
    )
    shared = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k >= 2"), "shared-keys")
    rows = stored(entries.join(shared, "key"), "lists")

    pairs = stored(short_pairs(rows.filter(F.col("k") <= SHORT_LIST), lim), "pairs")
    long_rows = rows.filter(F.col("k") > SHORT_LIST)
    crowded = not long_rows.isEmpty()
    if crowded:
        members = families(long_rows)
        a, b = members.select(F.col("node").alias("a"), F.col("family").alias("fa")), members.select(
            F.col("node").alias("b"), F.col("family").alias("fb")
        )
        pairs = pairs.join(a, "a", "left").join(b, "b", "left").filter(
            "fa IS NULL OR fb IS NULL OR fa <> fb"
        ).select("a", "b")
    s = reps.select("node", "n", "sketch")
    sketched = pairs.join(s.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a").join(
        s.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b"
    ).select("a", "b", "na", "nb", "ka", "kb")
    likely = stored(sketched.mapInArrow(lambda it: sketch_batches(it, lim), "a bigint, b bigint").distinct(), "likely")

    wanted = likely.select(F.col("a").alias("node")).union(likely.select("b"))
    wanted = (wanted.union(members.select("node")) if crowded else wanted).distinct()
    wanted = stored(wanted.join(reps.select("node", F.col("rep").alias("doc"), "s1", "s2"), "node"), "wanted")
    tokens = stored(
        text.join(wanted, "doc", "left_semi").mapInArrow(lambda it: token_batches(it, lim), TOKENS)
        .dropDuplicates(["doc", "s1", "s2"]).join(wanted, ["doc", "s1", "s2"]).select("node", "n", "tokens"),
        "tokens",
    )
    links = stored(checked(likely, reps, tokens, lim), "links")
    if crowded:
        links = stored(links.unionByName(family_links(members, reps, tokens, lim)), "links")

    labels = components(links.select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("n_links").alias("linked"))
    own = (
        reps.select("s1", "s2", "n", "rep", "weight", "node")
        .join(labels, "node", "left")
        .join(counts.withColumnRenamed("a", "node"), "node", "left")
    )
    lowest = labels.join(reps.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("low"))
    sized = own.join(lowest, "label", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    every = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text").mapInArrow(
        lambda it: identity_batches(it, lim), f"doc_id {kind}, row_hash bigint, n int, s1 bigint, s2 bigint"
    )
    first = F.coalesce("low", "rep", doc_order(F.col("doc_id")))
    return every.join(sized, ["s1", "s2", "n"], "left").select(
        "doc_id", "row_hash", F.col("n").cast("long").alias("n_shingles"),
        F.when(first != doc_order(F.lit(None)), first).alias("component_id"),
        (F.coalesce("linked", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"),
        F.coalesce("label", "node").alias("component"),
    )


def identity_batches(batches: Iterator[pa.RecordBatch], lim: Limits) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches, size=CHUNK_BYTES):
        token, first = sets_of(data, offsets, lim.shingle)
        s1, s2 = identity(token, first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(first).astype(np.int32)), pa.array(s1), pa.array(s2)],
            names=["doc_id", "row_hash", "n", "s1", "s2"],
        )


def short_pairs(rows: DataFrame, lim: Limits) -> DataFrame:
    """Pairs of sets in one list that sizes and places allow to link."""
    a = rows.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"))
    b = rows.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"))
    # Before the first shared token of a list none is shared, so the rest bounds the overlap.
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return (
        a.join(b, "key")
        .filter(
            (F.col("a") < F.col("b"))
            & (100 * F.col("na") >= lim.percent * F.col("nb")) & (100 * F.col("nb") >= lim.percent * F.col("na"))
            & ((F.col("pa") < 0) | (lim.of * rest >= lim.need * (F.col("na") + F.col("nb"))))
        )
        .select("a", "b").distinct()
    )


def checked(likely: DataFrame, reps: DataFrame, tokens: DataFrame, lim: Limits) -> DataFrame:
    """Pairs that link by exact count, in both directions with the other's weight."""
    w = reps.select("node", "weight")
    t = tokens
    both = (
        likely.join(t.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")), "a")
        .join(t.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "b")
        .filter(lim.of * F.size(F.array_intersect("ta", "tb")) >= lim.need * (F.col("na") + F.col("nb")))
        .select("a", "b").distinct()
    )
    weighed = both.join(w.select(F.col("node").alias("a"), F.col("weight").alias("wa")), "a").join(
        w.select(F.col("node").alias("b"), F.col("weight").alias("wb")), "b"
    )
    return weighed.select("a", "b", F.col("wb").alias("n_links")).unionByName(
        weighed.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("wa").alias("n_links"))
    )


def op9(docs: DataFrame) -> DataFrame:
    return join(docs, OP9)


SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, w[i : i + 3] AS s FROM (
        SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), component AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
), degree AS (
    SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN sizes USING (doc_id) JOIN component USING (doc_id) LEFT JOIN degree USING (doc_id)
"""
