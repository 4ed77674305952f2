"""The pipeline's near copies: five-word shingles, 0.8 of the union."""

import random
from fractions import Fraction

import brute
import corpus_pipeline
import pytest
from llm_data import docs, nothing, rows, sentence  # noqa: F401

from clickscore.llm import jaccard_join


def shingles(text, k=5):
    w = brute.PLAIN.findall((text or "").translate(brute.LOW))
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def kept_near_copies(rows, limit=Fraction(8, 10)):
    """Rows left when each group of linked rows keeps its smallest ``(doc_id, text)``."""
    rows = list(dict.fromkeys(rows))
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= limit * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        least[g] = min(least.get(g, brute.place(d)), brute.place(d))
    return sorted(((d, t) for (d, t), g in zip(rows, group) if brute.place(d) == least[g]), key=repr)


def edited(rng, n, at):
    words = sentence(rng, n).split()
    return " ".join(words), " ".join("edit" if i in at else w for i, w in enumerate(words))


def stage(spark, docs):
    return sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, "").collect()), key=repr)


@pytest.mark.parametrize("short, block", [(256, 200_000), (3, 2_000)])
def test_stage_links_five_words_at_080(spark, docs, monkeypatch, short, block):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    rng = random.Random(8)
    texts = []
    # Around the limit, from one shingle in a text's few to several edits in a long one.
    for n, at in [(49, [20]), (49, [21]), (48, [20]), (100, [20, 60]), (94, [20, 60]), (93, [20, 60]), (13, [0]), (12, [12]), (14, [0]), (9, [8]), (6, [5])]:
        texts += edited(rng, n, at)
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = kept_near_copies(list(enumerate(texts)))
    assert len(shingles(texts[0]) & shingles(texts[1])) * 10 == len(shingles(texts[0]) | shingles(texts[1])) * 8
    assert want[:1] == [(0, texts[0])] and len(texts) / 2 < len(want) < len(texts)
    assert stage(spark, made) == want


def test_required_overlap_at_080():
    near = corpus_pipeline.NEAR
    for n in range(1, 40):
        for m in range(1, 40):
            for k in range(0, min(n, m) + 1):
                assert (10 * k >= 8 * (n + m - k)) == (k >= jaccard_join.required(n, m, near))
