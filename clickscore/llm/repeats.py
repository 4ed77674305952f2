"""Find repeated windows of units (bytes or words) over all documents.

Every window picks the gram with the lowest hash inside it as its anchor, so equal windows
pick the same anchor at the same place.  Neighbouring windows with one anchor form a
segment.  Segments whose anchor occurs once anywhere hold no repeated window and go first,
by counting anchors.  Equal segments are then collapsed to their first occurrence: all
windows of the later ones are repeats, however many there are, and only first occurrences
travel on to the task that judges an anchor's segments.  Anchors with too many different
segments for one task are cut again with longer grams, at last with whole windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import small_batches, stored

PLACE_BITS = np.uint64(28)
#: Text taken at once; hashes of every byte take many times as much.
CHUNK_BYTES = 512 << 10
NO_ID = -(2**63)
CUT = "key bigint, content bigint, doc bigint, tag int, start int, size int"
SEGMENT = f"{CUT}, body binary"
JUDGED = "key bigint, content bigint, doc bigint, size int, from int, upto int"


@dataclass(frozen=True)
class Kind:
    """What a window is, and how a block of segments is judged."""

    name: str
    window: int
    grams: tuple[int, ...]  # gram length per level; the last is a whole window
    units: Callable  # (data, offsets) -> unit hashes, row of each, first unit of each row, byte ends
    judge: Callable  # (bodies, doc, start) -> per segment: covered (segment, from, upto)
    by_start: bool  # an earlier start in the same document counts as earlier
    heavy: int = 30_000  # different segments of one anchor that one task takes
    block_bytes: int = 6 << 20
    step_bytes: int = 4 << 20  # segments that are compared beside their anchors at once
    chunk_bytes: int = CHUNK_BYTES


def doc_order(doc_id: Column) -> Column:
    """Order of documents; a NULL id comes before all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def text_tag(text: Column) -> Column:
    """Tells rows with one id and different texts apart."""
    return F.hash(text)


def gram_hashes(unit: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` units at each place, and whether they lie in one row."""
    size = len(unit) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return T.mix(span_hash(unit, np.arange(size), n)), row[:size] == row[n - 1 :]


def span_hash(unit: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of ``n`` units from each start, by doubling."""
    have, value, power = 1, unit, T.STEP
    out, done, shift = np.zeros(len(unit), np.uint64), 0, np.uint64(1)
    with np.errstate(over="ignore"):
        while True:
            if n & have:
                moved = np.zeros(len(unit), np.uint64)
                moved[: len(unit) - done] = value[done:]
                out = out + moved * shift
                shift = shift * power
                done += have
            if have * 2 > n:
                break
            longer = value.copy()
            longer[: len(unit) - have] += value[have:] * power
            value, power, have = longer, power * power, have * 2
    return out[start]


def low_window(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of the ``n`` values from each place, by doubling."""
    have = 1
    while have * 2 <= n:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = n - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(unit: np.ndarray, row: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor key, first unit and unit count of every segment."""
    none = np.zeros(0, np.int64)
    hashes, whole = gram_hashes(unit, row, gram)
    n = len(unit) - window + 1
    if n <= 0:
        return none, none, none
    place = np.arange(len(hashes), dtype=np.uint64)
    packed = (hashes & ~((np.uint64(1) << PLACE_BITS) - np.uint64(1))) | place
    packed[~whole] = np.iinfo(np.uint64).max
    low = low_window(packed, window - gram + 1)[:n]
    ok = np.flatnonzero(row[:n] == row[window - 1 :])
    if not len(ok):
        return none, none, none
    at = (low[ok] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    opens = np.concatenate(([True], (at[1:] != at[:-1]) | (ok[1:] != ok[:-1] + 1)))
    first = np.flatnonzero(opens)
    start = ok[first]
    size = np.diff(np.append(first, len(ok))) + window - 1
    return hashes[at[first]].view(np.int64), start, size


_tables: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _tables or len(_tables["power"]) < n:
        step = 0xD6E8FEB86659FD93
        for name, base in (("power", step), ("inverse", pow(step, -1, 1 << 64))):
            values = np.full(n + 1024, np.uint64(base))
            values[0] = 1
            _tables[name] = np.multiply.accumulate(values)
    return _tables["power"][:n], _tables["inverse"][:n]


def content_hash(unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of ranges of different sizes, from prefix sums of units times powers."""
    power, inverse = power_tables(len(unit) + 1)
    total = np.zeros(len(unit) + 1, np.uint64)
    np.cumsum((unit ^ np.uint64(0xA5A5A5A5)) * power[:-1], out=total[1:])
    return T.mix((total[start + size] - total[start]) * inverse[start] + size.astype(np.uint64))


def cut_batches(batches: Iterator[pa.RecordBatch], kind: Kind, gram: int, only_keys: bool) -> Iterator[pa.RecordBatch]:
    """Segments of rows ``(doc, tag, base, body)``; ``base`` is the first unit's number."""
    for batch, data, offsets in T.chunked(batches, "body", kind.chunk_bytes):
        unit, row, first, _, _ = kind.units(data, offsets)
        key, start, size = segments(unit, row, kind.window, gram)
        if only_keys:
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64())], names=["key"])
            continue
        content = content_hash(unit, start, size).view(np.int64)
        of = row[start] if len(start) else start
        doc, tag, base = (np.asarray(batch.column(i)) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key, pa.int64()), pa.array(content, pa.int64()), pa.array(doc[of]), pa.array(tag[of]),
                pa.array((start - first[of] + base[of]).astype(np.int32)), pa.array(size.astype(np.int32)),
            ],
            names=["key", "content", "doc", "tag", "start", "size"],
        )


def bodies_of(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - begin
    flat = data[T.spread(begin, size)]
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def pick_batches(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[pa.RecordBatch]:
    """Bodies of the chosen segments of rows ``(doc, tag, body, wanted)``."""
    for batch, data, offsets in T.chunked(batches, "body", kind.chunk_bytes):
        _, _, first, begin, end = kind.units(data, offsets)
        wanted = batch.column(3)
        row = np.repeat(np.arange(batch.num_rows), np.asarray(wanted.value_lengths()))
        flat = wanted.flatten()
        key, content, start, size = (np.asarray(flat.field(i)) for i in range(4))
        doc, tag, base = np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(4))
        at = first[row] + start - base[row]
        # A text that was cut before comes in pieces, each with some of the segments.
        inside = np.flatnonzero((at >= first[row]) & (at + size <= first[row + 1]))
        row, at, key, content, start, size = (x[inside] for x in (row, at, key, content, start, size))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key), pa.array(content), pa.array(doc[row]), pa.array(tag[row]), pa.array(start),
                pa.array(size), bodies_of(data, begin[at], end[at + size - 1]),
            ],
            names=["key", "content", "doc", "tag", "start", "size", "body"],
        )


def judge_batches(batches: Iterator[pa.RecordBatch], kind: Kind, gram: int) -> Iterator[pa.RecordBatch]:
    """Judge blocks of whole anchors; rows come sorted by anchor."""
    held: list[pa.RecordBatch] = []
    ready: list[pa.Table] = []
    for batch in batches:
        for piece in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
            held.append(piece)
            if sum(x.num_rows for x in held) * kind.window * 2 < kind.step_bytes:
                continue
            table = pa.Table.from_batches(held)
            key = table.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last anchor may go on
            if last:
                ready.append(meeting(table.slice(0, last), kind, gram))
                held = table.slice(last).combine_chunks().to_batches()
            if sum(x.nbytes for x in ready) >= kind.block_bytes:
                yield judge_block(pa.concat_tables(ready), kind)
                ready = []
    if held:
        ready.append(meeting(pa.Table.from_batches(held), kind, gram))
    if ready:
        yield judge_block(pa.concat_tables(ready), kind)


def meeting(table: pa.Table, kind: Kind, gram: int) -> pa.Table:
    """Segments that agree with another of their anchor on half a window beside it.

    A window reaches at least half of what it has besides the anchor to one side of it, so
    segments that agree with no other there cannot share a window.
    """
    table = table.combine_chunks()
    data, offsets = T.buffers(table.column("body").combine_chunks().cast(pa.large_binary()))
    unit, row, first, _, _ = kind.units(data, offsets)
    hashes, whole = gram_hashes(unit, row, gram)
    key = table.column("key").to_numpy()
    hits = np.flatnonzero(whole & (hashes.view(np.int64) == key[row[: len(hashes)]]))
    at = np.full(len(key), -1, np.int64)
    at[row[hits][::-1]] = hits[::-1]  # the first place with the anchor's hash
    side = (kind.window - gram) // 2
    keep = np.zeros(len(key), bool)
    for begin, ok in (
        (at - side, at - side >= first[:-1]), (at, at + gram + side <= first[1:]),
    ):
        own = np.flatnonzero(ok & (at >= 0))
        code = T.mix(content_hash(unit, begin[own], np.full(len(own), gram + side)) ^ key[own].view(np.uint64))
        _, of, count = np.unique(code, return_inverse=True, return_counts=True)
        keep[own[count[of] > 1]] = True
    return table.filter(pa.array(keep))


def judge_block(table: pa.Table, kind: Kind) -> pa.RecordBatch:
    """Covered ranges of a block's segments as a batch of ``JUDGED``."""
    table = table.combine_chunks()
    if table.num_rows:
        bodies = table.column("body").combine_chunks().cast(pa.large_binary())
        doc, start = table.column("doc").to_numpy(), table.column("start").to_numpy()
        which, begin, upto = kind.judge(bodies, doc, start, kind)
    else:
        which, begin, upto = (np.zeros(0, np.int64),) * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(table.column(c).to_numpy()[which], pa.int64()) for c in ("key", "content", "doc")]
        + [pa.array(table.column("size").to_numpy()[which], pa.int32())]
        + [pa.array(begin.astype(np.int32)), pa.array(upto.astype(np.int32))],
        names=["key", "content", "doc", "size", "from", "upto"],
    )


def spans(rows: DataFrame, kind: Kind, level: int = 0) -> DataFrame:
    """Unit ranges ``(doc, tag, begin, upto)`` covered by repeats, of rows ``(doc, tag, base, body)``."""
    gram = kind.grams[level]
    cut = rows.mapInArrow(lambda it: cut_batches(it, kind, gram, False), CUT)
    keys = rows.mapInArrow(lambda it: cut_batches(it, kind, gram, True), "key bigint")
    # Written first, so that both sides of the join are plain exchanges and a hot key is split.
    again = stored(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").select("key"), f"{kind.name}-anchors"
    )
    shared = stored(cut.join(again, "key"), f"{kind.name}-segments")

    same = ["key", "content", "size"]
    order = F.struct("doc", "start", "tag") if kind.by_start else F.struct("doc", "tag", "start")
    first = stored(
        shared.groupBy(*same).agg(F.min(order).alias("f")).select(*same, "f.doc", "f.start", "f.tag"),
        f"{kind.name}-first",
    )
    later = shared.join(first.select(*same, "doc", *["start"] * kind.by_start), [*same, "doc", *["start"] * kind.by_start], "left_anti")
    found = [later.select("doc", "tag", F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("upto"))]

    crowded = first.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > kind.heavy).select("key")
    last = level + 1 == len(kind.grams)
    some = not last and not crowded.isEmpty()
    light = first.join(crowded, "key", "left_anti") if some else first
    bodies = with_bodies(rows, light, kind)
    judged = stored(
        bodies.repartition("key").sortWithinPartitions("key").mapInArrow(lambda it: judge_batches(it, kind, gram), JUDGED),
        f"{kind.name}-judged",
    )
    where = shared.join(judged, [*same, "doc"])
    found.append(
        where.select("doc", "tag", (F.col("start") + F.col("from")).alias("begin"), (F.col("start") + F.col("upto")).alias("upto"))
    )
    if some:
        dense = stored(with_bodies(rows, first.join(crowded, "key", "left_semi"), kind), f"{kind.name}-dense")
        inner = spans(dense.select("doc", "tag", F.col("start").alias("base"), "body"), kind, level + 1)
        # The first occurrence stands for the equal ones of its document.
        if kind.by_start:
            found.append(inner)
        else:
            found.append(copied(inner, dense, shared))
    every = found[0]
    for one in found[1:]:
        every = every.union(one)
    return every


def copied(inner: DataFrame, dense: DataFrame, shared: DataFrame) -> DataFrame:
    """Spans inside first occurrences, at all equal segments of the same document."""
    d, i = dense.drop("body").alias("d"), inner.alias("i")
    rel = d.join(
        i,
        (F.col("d.doc") == F.col("i.doc")) & (F.col("d.tag") == F.col("i.tag"))
        & (F.col("i.begin") >= F.col("d.start")) & (F.col("i.upto") <= F.col("d.start") + F.col("d.size")),
    ).select(
        "d.key", "d.content", "d.size", "d.doc",
        (F.col("i.begin") - F.col("d.start")).alias("from"), (F.col("i.upto") - F.col("d.start")).alias("till"),
    )
    return shared.join(rel, ["key", "content", "size", "doc"]).select(
        "doc", "tag", (F.col("start") + F.col("from")).alias("begin"), (F.col("start") + F.col("till")).alias("upto")
    )


def with_bodies(rows: DataFrame, chosen: DataFrame, kind: Kind) -> DataFrame:
    """The chosen segments with their bytes, fetched once per text."""
    wanted = chosen.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("key", "content", "start", "size")).alias("wanted")
    )
    joined = rows.join(wanted, ["doc", "tag"]).select("doc", "tag", "body", "wanted", "base")
    return joined.mapInArrow(lambda it: pick_batches(it, kind), SEGMENT)


def removed(docs: DataFrame, kind: Kind, finish: Callable, fields: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with what ``finish`` makes of its covered units."""
    small_batches(docs.sparkSession)
    base = docs.select(
        "doc_id", doc_order(F.col("doc_id")).alias("doc"), text_tag(F.col("text")).alias("tag"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"),
    )
    found = spans(base.select("doc", "tag", F.lit(0).alias("base"), "body"), kind)
    per_text = stored(
        found.groupBy("doc", "tag").agg(F.collect_list(F.struct("begin", "upto")).alias("covered")), f"{kind.name}-spans"
    )
    kind_of = docs.schema["doc_id"].dataType.simpleString()
    return base.join(per_text, ["doc", "tag"], "left").select(
        "doc_id", "body", F.coalesce("covered", F.array().cast("array<struct<begin:int,upto:int>>")).alias("covered")
    ).mapInArrow(lambda it: finish_batches(it, kind, finish), f"doc_id {kind_of}, {fields}")


def finish_batches(batches: Iterator[pa.RecordBatch], kind: Kind, finish: Callable) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches, "body", kind.chunk_bytes):
        _, _, first, begin, end = kind.units(data, offsets)
        lists = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
        flat = lists.flatten()
        covered = T.cover(
            int(first[-1]), first[row] + np.asarray(flat.field(0), np.int64), first[row] + np.asarray(flat.field(1), np.int64)
        )
        yield finish(batch.column(0), data, offsets, first, begin, end, covered)
