"""The order of tokens: what many sets would list comes last, whatever task its documents are in."""

import random

import brute
import corpus_pipeline
import pytest
from llm_data import sentence
from llm_same import same

from clickscore.llm import jaccard_join

COLUMNS = ["doc_id", "n_shingles", "component_id", "n_links"]


def test_common_phrases_make_no_families(spark, monkeypatch):
    """Unrelated texts share a phrase, one of them in each task: the phrase's shingles are hot, no list is long."""
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 10)
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", 6)
    met = []
    families = jaccard_join.families
    monkeypatch.setattr(jaccard_join, "families", lambda long_rows: (met.append(1), families(long_rows))[1])
    rng = random.Random(5)
    phrase = sentence(rng, 20)
    rows = [(i, f"{sentence(rng, 40)} {phrase} {sentence(rng, 40)}") for i in range(30)]
    rows += [(100, rows[3][1] + " more"), (101, rows[4][1])]
    made = spark.sparkContext.parallelize(rows, len(rows)).toDF("doc_id bigint, text string")
    same(jaccard_join.op9(made), brute.jaccard(rows), COLUMNS)
    assert not met


def test_hot_tokens_are_bounded(spark, monkeypatch):
    """Where too many tokens are frequent, those listed twice as often (and so on) come last."""
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", 4)
    often = spark.createDataFrame([(n,) for n in (5, 8, 8, 9, 16, 17, 17, 33)], "n bigint")
    for most, cut in ((8, 4), (7, 8), (5, 8), (4, 16), (3, 16), (2, 32), (1, 32), (0, 64)):
        monkeypatch.setattr(jaccard_join, "HOT_MOST", most)
        assert jaccard_join.hot_cut(often) == cut, most
        assert sum(r.n > cut for r in often.collect()) <= most


def test_near_copies_of_common_phrases_make_no_families(spark, monkeypatch):
    """The same for the pipeline's stage: five words, 0.8."""
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 10)
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", 6)
    monkeypatch.setattr(jaccard_join, "families", lambda long_rows: pytest.fail("a long list"))
    rng = random.Random(6)
    phrase = sentence(rng, 20)
    rows = [(i, f"{sentence(rng, 40)} {phrase} {sentence(rng, 40)}") for i in range(30)]
    rows.append((100, rows[3][1] + " more"))
    made = spark.sparkContext.parallelize(rows, len(rows)).toDF("doc_id bigint, text string")
    kept = corpus_pipeline.near_copies(spark, made, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(30))
