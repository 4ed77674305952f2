"""License scan: MinHash over overlapping text windows, then exact shingle containment.

A template's five-word shingles are looked for in windows of about twice its length that
overlap by half.  Windows whose MinHash agrees with a template's in any band are candidates;
around a candidate every stretch of a window's length is tried, and the exact share of the
template's shingles that the best one holds decides.  So words put into a notice do not matter
until they double its length, wherever it begins.  Of any such stretch one of the windows holds
half of the matching shingles at least; the number of bands follows from the lowest Jaccard
similarity that such a window can have, so that a match is missed with a probability below
``MISS``.  Texts are read in place, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import small_batches

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4
#: Templates of a table reach every task up to this size.
TEMPLATE_BYTES = 16 << 20
#: Text taken at once; the hashes of so much stay in the processor's cache.
CHUNK_BYTES = 1 << 20

# Wording of common license notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "Apache-2.0": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
}

MATCH = "array<struct<template string, word_start int, word_end int, containment double>>"


@dataclass
class Scale:
    """Templates of similar length and the windows they are looked for in."""

    window: int  # shingles in a window
    stride: int
    seeds: np.ndarray  # one MinHash function per band
    table: np.ndarray  # band x 2**16: may a template have a minimum with these top bits
    minima: list[np.ndarray]  # per band: sorted minima
    owners: list[np.ndarray]  # per band: template of each
    templates: list[tuple[str, np.ndarray, int]]  # name, distinct shingle hashes, words


def bands_needed(similarity: float, miss: float = MISS) -> int:
    """Bands of one row each, so that all of them miss with a probability below ``miss``."""
    return 1 if similarity >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - similarity)))


def least_similarity(size: int, window: int, containment: float = CONTAINMENT) -> float:
    """Jaccard similarity that one window of a match has at least: it holds half of what must match."""
    held = math.ceil(math.ceil(containment * size) / 2) if window > 1 else math.ceil(containment * size)
    return held / (window + size - held)


def shingle_hashes(texts: list[str]) -> list[tuple[np.ndarray, int]]:
    data, offsets = T.buffers(pa.array(texts, type=pa.large_binary()))
    w = T.words(data, offsets, T.LETTERS, T.LOWERED)
    hashes, at = T.shingles(w, SHINGLE)
    rows = w.row[at] if len(at) else at
    return [(np.unique(hashes[rows == i]), int(w.first[i + 1] - w.first[i])) for i in range(len(texts))]


def build_scales(templates: dict[str, str], containment: float = CONTAINMENT) -> list[Scale]:
    made = [(n, h, k) for (n, _), (h, k) in zip(templates.items(), shingle_hashes(list(templates.values()))) if len(h)]
    groups: dict[int, list] = {}
    for name, hashes, words in made:
        groups.setdefault(max(words - SHINGLE, 0).bit_length(), []).append((name, hashes, words))
    rng = np.random.default_rng(11)
    scales = []
    for power, own in sorted(groups.items()):
        stride = 1 << power
        window = 2 * stride if power else 1
        lowest = min(least_similarity(len(h), window, containment) for _, h, _ in own)
        seeds = rng.integers(1, 2**63, bands_needed(lowest), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        table = np.zeros((len(seeds), 1 << 16), bool)
        minima, owners = [], []
        for b, seed in enumerate(seeds):
            low = np.array([scramble(h, seed).min() for _, h, _ in own], dtype=np.uint64)
            order = np.argsort(low, kind="stable")
            minima.append(low[order])
            owners.append(order)
            table[b, (low >> np.uint64(48)).astype(np.int64)] = True
        scales.append(Scale(window, stride, seeds, table, minima, owners, own))
    return scales


def scramble(hashes: np.ndarray, seed: np.uint64) -> np.ndarray:
    """One of the MinHash functions; its high bits depend on all bits of the hash."""
    return hashes * seed


def candidates(scale: Scale, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct (window start, template) pairs that agree in a band, as rows."""
    size = np.diff(first)
    blocks = -(-size // scale.stride)
    row_of = np.repeat(np.arange(len(size)), blocks)
    start = first[row_of] + (np.arange(len(row_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * scale.stride
    if not len(start):
        return np.zeros((0, 2), np.int64)
    last = np.append(row_of[1:] != row_of[:-1], True)
    found = []
    for b, seed in enumerate(scale.seeds):
        low = np.minimum.reduceat(scramble(hashes, seed), start)
        if scale.window > scale.stride:
            after = np.append(low[1:], low[-1:])
            low = np.where(last, low, np.minimum(low, after))
        maybe = np.flatnonzero(scale.table[b][(low >> np.uint64(48)).astype(np.int64)])
        for own, owner in zip(scale.minima[b], scale.owners[b]):
            hit = maybe[low[maybe] == own]
            if len(hit):
                found.append(np.stack([start[hit], np.full(len(hit), owner)], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def best_stretch(places: np.ndarray, values: np.ndarray, window: int) -> tuple[int, int, int]:
    """Most different values within ``window`` places, and where that stretch begins and ends; the first such."""
    best, held, left = (0, 0, 0), {}, 0
    at, what = places.tolist(), values.tolist()
    for right, value in enumerate(what):
        held[value] = held.get(value, 0) + 1
        while at[right] - at[left] >= window or held[what[left]] > 1 and left < right:
            held[what[left]] -= 1
            if not held[what[left]]:
                del held[what[left]]
            left += 1
        if len(held) > best[0]:
            best = (len(held), at[left], at[right] + 1)
    return best


def matches(scales: list[Scale], hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, str, int, int, float]]:
    """Verified (row, template, first shingle, end shingle, containment), best per place."""
    found = []
    for scale in scales:
        for begin, owner in candidates(scale, hashes, first).tolist():
            name, wanted, _ = scale.templates[owner]
            row = int(np.searchsorted(first, begin, side="right")) - 1
            low = max(int(first[row]), begin - scale.window + 1)
            own = hashes[low : min(begin + 2 * scale.window - 1, int(first[row + 1]))]
            here = np.flatnonzero(np.isin(own, wanted))
            n, start, end = best_stretch(here, own[here], scale.window)
            share = n / len(wanted)
            if share >= CONTAINMENT:
                found.append((row, name, low + start - int(first[row]), low + end - int(first[row]), share))
    # Overlapping windows find one occurrence twice: the fuller one stays.
    out: list[tuple[int, str, int, int, float]] = []
    for m in sorted(found, key=lambda m: (m[0], m[1], m[2], -m[4])):
        if out and out[-1][:2] == m[:2] and m[2] < out[-1][3]:
            if m[4] > out[-1][4]:
                out[-1] = m
        else:
            out.append(m)
    return out


def scan_batches(batches: Iterator[pa.RecordBatch], scales: list[Scale]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("template", pa.string()), ("word_start", pa.int32()), ("word_end", pa.int32()), ("containment", pa.float64())])
    )
    for batch, data, offsets in T.chunked(batches, size=CHUNK_BYTES):
        w = T.words(data, offsets, T.LETTERS, T.LOWERED)
        hashes, at = T.shingles(w, SHINGLE)
        first = np.searchsorted(at, w.first)
        out: list[list] = [[] for _ in range(batch.num_rows)]
        for row, name, start, end, share in matches(scales, hashes, first) if len(hashes) else []:
            out[row].append({"template": name, "word_start": start, "word_end": end + SHINGLE - 1, "containment": share})
        for own in out:
            own.sort(key=lambda m: (m["word_start"], m["template"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "matches"])


def template_texts(table: DataFrame, most: int = TEMPLATE_BYTES) -> dict[str, str]:
    """Names and texts of a table of licence templates (``name``, ``text``), bounded by its measured size.

    Of rows that share a name the first text in order counts; NULL names or texts are left out.
    """
    rows = table.filter("name IS NOT NULL AND text IS NOT NULL").groupBy("name").agg(F.min("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    if size > most:
        raise ValueError(f"the templates take {size} bytes, more than {most}: scan with parts of them")
    return {r["name"]: r["text"] for r in rows.orderBy("name").collect()}


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES) -> DataFrame:
    """``doc_id`` and the verified ``matches`` of each row, in text order.

    ``templates`` are names and texts, or a table of them (see ``template_texts``); the default
    are the notices that the module lists.  Words are letters and digits, A-Z lower-cased; a
    match holds at least 0.8 of the template's distinct five-word shingles within some stretch
    of a window's length (one to two times the template's, rounded up to a power of two).
    Templates of fewer than five words have no shingle and never match.  NULL and empty texts have no matches; repeated
    rows get equal results; texts of any length are scanned whole; an empty table gives an
    empty result.  Only ``doc_id`` and ``text`` are read.
    """
    small_batches(docs.sparkSession)
    scales = build_scales(template_texts(templates) if isinstance(templates, DataFrame) else templates)
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: scan_batches(it, scales), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, matches {MATCH}"
    )


def op10(docs: DataFrame) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["template"])))
    return scan(docs).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), F.concat_ws(",", names).alias("licenses"),
        F.transform("matches", lambda m: m["word_start"]).alias("word_starts"),
        F.transform("matches", lambda m: m["word_end"]).alias("word_ends"),
    )
