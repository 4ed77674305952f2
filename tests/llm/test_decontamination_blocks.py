"""A benchmark of several blocks gives what one block gives, row by row."""

import gc
import weakref

import brute
from llm_data import docs, nothing, rows  # noqa: F401
from llm_same import same
from test_dedup import SIX, items_of

from clickscore.llm import decontamination


def test_repeated_rows_in_blocks(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    again = [(9, rows[11][1]), (9, rows[11][1]), (9, rows[12][1]), (None, rows[11][1]), (None, rows[11][1])]
    more = docs.sparkSession.createDataFrame(again, "doc_id bigint, text string")
    table = docs.select("doc_id", "text").union(more)
    items = items_of(rows)
    got = decontamination.op3(table, spark.createDataFrame(items, "item_id bigint, text string"))
    same(got, brute.decontamination(rows + again, items), SIX)


def test_driver_holds_one_block(spark, docs, rows, monkeypatch):
    held = []
    build = decontamination.build_windows

    def watched(block):
        gc.collect()
        assert not any(x() for x in held)
        made = build(block)
        held.extend([weakref.ref(made)] if made else [])
        return made

    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    monkeypatch.setattr(decontamination, "build_windows", watched)
    items = items_of(rows)
    decontamination.occurrences(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert len(held) > 1


def test_windows_are_those_of_the_items():
    items = [("a", "One two  three"), ("b", " ".join(f"w{i % 20}" for i in range(60))), ("c", ""), ("a", "one two three"), ("d", "w3"), ("e", "ß w3 é")]
    win = decontamination.build_windows(items)
    words = [brute.LETTERS.findall(t.translate(brute.LOW)) for _, t in items]
    want = {}
    for i, w in enumerate(words):
        for j in range(max(len(w) - 12, 1)):
            if w:
                want.setdefault(tuple(w[j : j + 13]), set()).add(i)
    got = sorted((int(n), sorted(win.items[a:b].tolist())) for n, a, b in zip(win.lengths, win.item_first, win.item_first[1:]))
    assert got == sorted((len(k), sorted(v)) for k, v in want.items())
