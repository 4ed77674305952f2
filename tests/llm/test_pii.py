"""Personal data: base rules against plain regular expressions, added spans against planted ones."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import docs, nothing, rows  # noqa: F401

from clickscore.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """Base spans by the rules as they are written down."""
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in QUAD.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d))
        out += [(m.start(), m.end(), 2)] if 12 <= len(d) <= 19 and total % 10 == 0 else []
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1250.@+-_ ()é\n%", max_size=60))
def test_base_rules_of_any_text(text):
    assert P.base_spans(text) == plain(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.d", "_x@", "@y.z", "1.2.3.4", ".5", "300.1.1.1", "4111 1111 1111 1111", "+1 (2", "34) 555-0123", " ", "-"]), max_size=8))
def test_base_rules_of_joined_pieces(parts):
    assert P.base_spans("".join(parts)) == plain("".join(parts))


def card(rng, off=0):
    """Sixteen digits with a valid check digit, or one that is ``off`` by some."""
    d = [rng.randrange(10) for _ in range(15)]
    total = sum(x if i % 2 else sum(divmod(2 * x, 10)) for i, x in enumerate(d))
    return "".join(map(str, d)) + str((-total + off) % 10)


def made(rng, kind, style):
    """A true span (style 0: as the base rules want it), or, style "no", a look-alike."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    if kind == 0:
        local, host = f"{rng.choice('abcdef')}{rng.choice(['nna', 'li', 'ob'])}.{n(2)}", f"mail{n(1)}"
        return [f"{local}@{host}.example.com", f"{local} [at] {host} [dot] example [dot] com", f"{local}(at){host}.example.com"][style]
    if kind == 1:
        q = [str(rng.randrange(1, 250)) for _ in range(4)]
        return [".".join(q), "[.]".join(q), " . ".join(q)][style]
    if kind == 2:
        if style == "no":
            return card(rng, rng.randrange(1, 10))
        c = card(rng)
        return [c, ".".join(c[i : i + 4] for i in (0, 4, 8, 12)), "/".join(c[i : i + 4] for i in (0, 4, 8, 12))][style]
    if style == "no":
        return f"{2000 + rng.randrange(30)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}"
    a, b, c = n(3), n(3), n(4)
    return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}"][style]


def corpus(seed, n, styles):
    """Texts of words with one span each, and where that span is."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("abdegiklmnorstuä") for _ in range(rng.randint(2, 8))) for _ in range(40)]
        kind, style = rng.randrange(4), rng.choice(styles)
        if style == "no":
            kind = rng.choice([2, 3])
        own = made(rng, kind, style)
        before = " ".join(words[:20]) + " "
        out.append((i, before + own + " " + " ".join(words[20:]), (len(before), len(before) + len(own), kind), style))
    return out


@pytest.fixture(scope="module")
def trees(spark):
    rows = [(i, text, "x") for i, text, *_ in corpus(1, 1500, [0, 0, 0, "no"])]
    return P.train(spark.createDataFrame(rows, "doc_id bigint, text string, place string").repartition(3))


def test_the_trees_find_other_spellings_and_leave_look_alikes(spark, trees):
    assert np.isfinite(trees.thresholds).all()
    cases = corpus(2, 600, [1, 2, "no"])
    found = P.added_spans([c[1] for c in cases], trees)
    true = [(c, base + added) for c, (base, added) in zip(cases, found) if c[3] != "no"]
    missed = [(c[1][c[2][0] : c[2][1]], c[2], spans) for c, spans in true if c[2] not in spans]
    assert len(missed) < 0.1 * len(true), missed[:5]
    assert np.mean([bool(a) for c, (_, a) in zip(cases, found) if c[3] == "no"]) < 0.05


def test_base_spans_stay_and_added_ones_do_not_overlap(trees):
    for _, text, span, style in corpus(3, 200, [0, 1, 2]):
        text = text + " " + text
        (base, added), = P.added_spans([text], trees)
        assert base == plain(text)
        spans = sorted(base + added)
        assert all(a in base and b in base or a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_rows_of_odd_texts(spark, docs, rows, trees):
    extra = [(900, "mail a.b@c.de and 1.2.3.4 and +1 (222) 333-4444, 4111 1111 1111 1111 ü 1.2.3.4"), (901, "é🙂 9.9.9.9")]
    more = docs.unionByName(
        docs.sparkSession.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True
    )
    got = sorted(map(tuple, P.find(more, trees).collect()), key=repr)
    want = []
    for d, t in [*rows, *extra]:
        base, added = P.added_spans([t or ""], trees)[0]
        assert base == plain(t or "")
        n = [sum(k == j for *_, k in base) for j in range(4)]
        want.append((d, *n, P.written(base), P.written(base + added), len(added)))
    assert got == sorted(want, key=repr)
    assert (901, 0, 1, 0, 0, "ip:3:10", "ip:3:10", 0) in got


def test_query_columns_and_nothing_to_learn_from(docs, nothing):
    got = P.op12(docs).collect()
    assert len(got) == docs.count()
    assert {(r["base_sha256"], r["spans"]) for r in got} == {(hashlib.sha256(b"").hexdigest(), "")}
    assert P.op12(nothing).count() == 0


def test_redaction(spark, trees):
    text = "mail a.b@c.de or +1 (222) 333-4444"
    df = spark.createDataFrame([(1, text, 7), (2, None, 8), (None, "x", 9)], "doc_id bigint, text string, n bigint")
    got = sorted(map(tuple, P.redacted(df, trees).collect()), key=repr)
    assert got == sorted([(1, "mail [email] or [phone]", 7), (2, None, 8), (None, "x", 9)], key=repr)


def test_thresholds_are_calibrated():
    score = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 9], float)
    label = np.array([0, 0, 1, 0, 1, 1, 1, 1, 1, 1])
    value, share = P.calibrated(score, label)
    assert share.tolist() == [0, 0, 0.5, 0.5, 1, 1, 1, 1, 1, 1]
    assert P.threshold(score, label) == 3.5
    assert P.threshold(score[:6], label[:6]) == np.inf  # too few true spans pass
    assert P.threshold(score[:0], label[:0]) == np.inf


@pytest.mark.parametrize("piece", ["a", "@", "+1(", "1.", "1 ", "1-", "a at ", "[ ", "0:", "a@b.", "é"])
def test_long_texts_take_time_in_proportion(piece):
    text = piece * (200_000 // len(piece))
    t0 = time.time()
    P.base_spans(text)
    P.proposed(text)
    assert time.time() - t0 < 5
