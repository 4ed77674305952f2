"""Personal data: fixed base rules, then candidates judged by gradient-boosted trees.

Base rules find strictly written emails, IP addresses, card numbers and phone numbers.
Generators with high recall propose further spans, which may overlap each other: spelled-out
addresses, dotted and defanged quads, chains of digit groups.  Boosted trees over format and
context features score them, and a span is added when its score passes the kind's threshold:
the lowest score whose calibrated share of true spans on held-out documents is
``MIN_PRECISION`` or more.

There are no labelled spans, so the trees learn from the base rules.  In a bounded sample of
documents every base span is rewritten in place into other spellings of the same thing
(true) and into look-alikes with wrong check digits or sizes (false); what the generators
propose elsewhere is false as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm.frames import small_batches

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: The fit reads at most so many documents (lowest id hashes) and candidate rows.
FIT_DOCS = 20_000
FIT_ROWS = 60_000
MIN_PRECISION = 0.95
#: Held-out true spans that must pass a threshold before it is trusted.
MIN_PASSED = 5
ROUNDS, DEPTH, RATE, SHRINK, BINS = 40, 4, 0.2, 1.0, 32
#: Characters of context on each side.
AROUND = 32
#: Longest local part, domain and digit chain of a candidate (base rules have no such bounds).
LOCAL, DOMAIN, GROUPS = 64, 255, 8

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AFTER_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUADS = re.compile(r"[0-9]+(?:\.[0-9]+)+")
CARDS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONES = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ outwards: one pass over any text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = AFTER_AT.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end(), EMAIL
        # No match reaches back over an @, so none begins before this place.
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_ips(text: str) -> Iterator[Span]:
    """Four parts at a time of each maximal dotted chain."""
    for chain in QUADS.finditer(text):
        parts = list(DIGITS.finditer(text, chain.start(), chain.end()))
        for i in range(0, len(parts) - 3, 4):
            own = [p.group().lstrip("0") for p in parts[i : i + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in own):
                yield parts[i].start(), parts[i + 3].end(), IP


def base_cards(text: str) -> Iterator[Span]:
    for m in CARDS.finditer(text):
        digits = only_digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), CARD


def base_phones(text: str) -> Iterator[Span]:
    for m in PHONES.finditer(text):
        if 9 <= sum(map(len, DIGITS.findall(m.group()))) <= 15:
            yield m.start(), m.end(), PHONE


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules by start, then kind; spans of different kinds may overlap."""
    found = [*base_emails(text), *base_ips(text), *base_cards(text), *base_phones(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


# Generators.  Each looks only at a bounded neighbourhood of what triggers it.
AT = re.compile(r"[\[({<]\s?(?:at|AT|At)\s?[\])}>]|[aA][tT](?<=\s..)(?=\s)|[@＠]")
BEFORE_AT = re.compile(r"([A-Za-z0-9._%+-]+)\s?\Z")
DOT = r"(?:\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s|\s?\.)"
NAMED = re.compile(rf"[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)+")
SPACED_QUAD = re.compile(r"[0-9]{1,4}(?:(?:\s?\.\s?|\s?[\[({]\s?(?:\.|dot)\s?[\])}]\s?)[0-9]{1,4}){3,}")
TWO_HEX = re.compile(r":[0-9A-Fa-f]{1,4}:")
LONG_ADDRESS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Fa-f:])")
CHAINS = re.compile(r"[0-9]+(?:[ ().,/_ ‐‑–-]{1,3}[0-9]+)*")


def proposed_emails(text: str) -> Iterator[Span]:
    for m in AT.finditer(text):
        after = m.end() + text[m.end() : m.end() + 1].isspace()
        right = NAMED.match(text, after, after + DOMAIN)
        left = BEFORE_AT.search(text[max(0, m.start() - LOCAL) : m.start()]) if right else None
        if left:
            yield m.start() - len(left.group()), right.end(), EMAIL


def proposed_ips(text: str) -> Iterator[Span]:
    for m in SPACED_QUAD.finditer(text):
        parts = list(DIGITS.finditer(text, m.start(), m.end()))
        for i in range(0, len(parts) - 3, 4):
            yield parts[i].start(), parts[i + 3].end(), IP
    done = 0
    for near in TWO_HEX.finditer(text):
        if near.start() >= done:
            m = LONG_ADDRESS.search(text, max(done, near.start() - 4), near.start() + 64)
            if m:
                yield m.start(), m.end(), IP
            done = m.end() if m else near.end()


def proposed_numbers(text: str) -> Iterator[Span]:
    """From every group of a digit chain: all runs of groups with the digits of a phone or card."""
    for chain in CHAINS.finditer(text):
        parts = list(DIGITS.finditer(text, chain.start(), chain.end()))
        for i, first in enumerate(parts):
            start, n = first.start(), 0
            for sign in "(+":
                start -= start > 0 and text[start - 1] == sign
            for last in parts[i : i + GROUPS]:
                n += last.end() - last.start()
                if n > 19:
                    break
                if 7 <= n <= 15:
                    yield start, last.end(), PHONE
                if n >= 12:
                    yield start, last.end(), CARD


def proposed(text: str) -> list[Span]:
    return [*proposed_emails(text), *proposed_ips(text), *proposed_numbers(text)]


# Fixed word lists: what tends to stand before personal data, by kind, and before other numbers.
CUES = (
    ("mail", "contact", "write", "reply"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "pay", "debit"),
    ("phone", "tel", "call", "mobile", "fax", "cell", "ring"),
)
OTHER_CUES = ("order", "invoice", "version", "isbn", "ref", "token", "key", "sku", "page", "chapter", "no.", "#", "$", "id")
CLASSES = " .,;:=\"'()[]#/-+"


def _class(c: str) -> float:
    if not c:
        return -1.0
    if c.isdigit():
        return 20.0
    if c.isalpha():
        return 21.0
    return float(CLASSES.find(c)) if c in CLASSES else 22.0


def features(text: str, span: Span, n_proposed: int) -> list[float]:
    """Format of the span, then its context."""
    start, end, kind = span
    own = text[start:end]
    sizes = [len(g) for g in DIGITS.findall(own)] or [0]
    digits = only_digits(own)
    quads = [g.lstrip("0") for g in DIGITS.findall(own)]
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    told = before.lower()
    labels = re.findall(r"[A-Za-z0-9-]+", own) if kind == EMAIL else []
    return [
        *[float(kind == k) for k in range(4)],
        len(own), len(digits), len(sizes), sizes[0], sizes[-1], max(sizes), min(sizes),
        own.startswith("+"), own.startswith("00"), own.startswith("("), own.count("("), own.count("[") + own.count("{"),
        own.count(" "), own.count("-"), own.count("."), own.count("/"), own.count(","), own.count(":"), own.count("_"),
        12 <= len(digits) <= 19 and luhn(digits),
        len(quads) == 4 and all(len(g) <= 3 and int(g or 0) <= 255 for g in quads),
        len(set(digits)) / max(len(digits), 1),
        sum(c.isalpha() for c in own), "@" in own, len(labels), len(labels[-1]) if labels else 0,
        float(bool(labels) and labels[-1].isalpha()),
        _class(before[-1:]), _class(after[:1]), _class(before[-2:-1]), _class(after[1:2]),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        *[any(c in told for c in CUES[k]) for k in range(4)], any(c in told for c in OTHER_CUES),
        min(n_proposed, 64),
    ]


N_FEATURES = len(features("a", (0, 1, EMAIL), 1))


def _overlaps(spans: list[Span], taken: list[Span]) -> list[bool]:
    """Which spans share a character with any of ``taken``."""
    if not taken:
        return [False] * len(spans)
    edges = sorted((s, e) for s, e, _ in taken)
    starts = np.array([s for s, _ in edges])
    reach = np.maximum.accumulate([e for _, e in edges])
    place = np.searchsorted(starts, [e for _, e, _ in spans], side="left") - 1
    return [bool(i >= 0 and reach[i] > s[0]) for i, s in zip(place, spans)]


# Rewritten spans.


def _grouped(digits: str, sizes: tuple[int, ...], sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return sep.join([*[x for x in out if x], *([digits[at:]] if digits[at:] else [])])


def spellings(text: str, kind: int) -> tuple[list[str], list[str]]:
    """Other ways to write a base span (true), and look-alikes (false)."""
    digits = only_digits(text)
    if kind == EMAIL:
        local, _, domain = text.partition("@")
        true = [
            f"{local}{at}{domain.replace('.', dot)}"
            for at, dot in ((" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), ("[at]", "[dot]"), (" @ ", "."))
        ]
        return true, [f"{local} at {domain.split('.')[0]}. {domain.split('.')[-1]}", f"{local}@ {local} . {local}"]
    if kind == IP:
        true = [text.replace(".", dot) for dot in ("[.]", " . ", "(.)", "[dot]")]
        parts = text.split(".")
        return true, [".".join([parts[0], str(256 + int(parts[1][-2:])), *parts[2:]]), " . ".join(["2019", *parts[1:]])]
    wrong = digits[:-1] + str((int(digits[-1]) + 1 + len(text) % 8) % 10)
    if kind == CARD:
        true = [_grouped(digits, (4, 4, 4, 4), sep) for sep in (".", "/", "  ", "_", " ")]
        return true, [wrong, *[_grouped(wrong, (4, 4, 4, 4), sep) for sep in (".", "/", "-", "  ")]]
    national = digits[1:]
    true = [
        f"({national[:3]}) {national[3:6]}-{national[6:]}", f"{national[:3]}-{national[3:6]}-{national[6:]}",
        f"{digits[0]}.{national[:3]}.{national[3:6]}.{national[6:]}", f"00{digits[0]} {national[:3]} {national[3:]}",
        f"+{digits[0]}/{national[:3]}/{national[3:]}",
    ]
    return true, [digits + digits[:6], digits[:8], f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", f"{digits[:5]},{digits[5:8]},{digits[8:]}"]


def examples(text: str, name: str) -> tuple[list[list[float]], list[int], list[int], list[int]]:
    """Feature rows with label, kind and whether a threshold may be set on them (not base spans)."""
    rows, labels, kinds, judged = [], [], [], []

    def add(row: list[float], label: int, kind: int, judge: int) -> None:
        rows.append(row)
        labels.append(label)
        kinds.append(kind)
        judged.append(judge)

    base, found = base_spans(text), proposed(text)
    strict = set(base)
    for span, near in zip(found, _overlaps(found, base)):
        if span in strict or not near:
            add(features(text, span, len(found)), int(span in strict), span[2], int(span not in strict))
    for start, end, kind in base:
        pick = int.from_bytes(hashlib.sha256(f"{name}:{start}:{kind}".encode()).digest()[:4], "little")
        before, after = text[max(0, start - 2 * AROUND) : start], text[end : end + 2 * AROUND]
        elsewhere = sum(s[0] >= end or s[1] <= start for s in found)
        for label, choices in zip((1, 0), spellings(text[start:end], kind)):
            for i in range(2):
                other = choices[(pick + i) % len(choices)]
                view = before + other + after
                mine = (len(before), len(before) + len(other))
                there = [s for s in proposed(view) if s[0] < mine[1] and s[1] > mine[0]]
                for span in there:
                    exact = span == (*mine, kind)
                    add(features(view, span, elsewhere + len(there)), int(exact and label == 1), span[2], 1)
    return rows, labels, kinds, judged


@dataclass
class Trees:
    """Complete binary trees: split feature and cut of inner nodes, values of the leaves."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.full(len(KINDS), np.inf))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss over feature histograms."""
    inner = 2**DEPTH - 1
    share = min(max(y.mean() if len(y) else 0.0, 1e-6), 1 - 1e-6)
    out = Trees(
        np.zeros((ROUNDS, inner), np.int64), np.full((ROUNDS, inner), np.inf), np.zeros((ROUNDS, 2**DEPTH)),
        float(np.log(share / (1 - share))),
    )
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    total = np.full(len(y), out.start)
    for t in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            own = node - first
            best = np.zeros(width)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                at = own * BINS + binned[:, f]
                left_g = np.cumsum(np.bincount(at, g, width * BINS).reshape(width, BINS), axis=1)
                left_h = np.cumsum(np.bincount(at, h, width * BINS).reshape(width, BINS), axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = (
                    left_g**2 / (left_h + SHRINK) + (all_g - left_g) ** 2 / (all_h - left_h + SHRINK)
                    - all_g**2 / (all_h + SHRINK)
                )[:, : len(e)]
                gain[(left_h[:, : len(e)] < 1) | ((all_h - left_h)[:, : len(e)] < 1)] = 0
                where = gain.argmax(axis=1)
                top = gain[np.arange(width), where]
                better = np.flatnonzero(top > best + 1e-9)
                best[better] = top[better]
                out.feature[t, first + better] = f
                out.cut[t, first + better] = e[where[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), out.feature[t, node]] > out.cut[t, node])
        at = node - inner
        out.leaf[t] = -RATE * np.bincount(at, g, 2**DEPTH) / (np.bincount(at, h, 2**DEPTH) + SHRINK)
        total += out.leaf[t, at]
    return out


def calibrated(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic calibration: distinct scores, ascending, and the pooled share of true spans from each on."""
    value, place = np.unique(score, return_inverse=True)
    blocks: list[list[float]] = []
    for total, true in zip(np.bincount(place), np.bincount(place, label)):
        blocks.append([true, total, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            true, total, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + true, blocks[-1][1] + total, blocks[-1][2] + n]
    return value, np.repeat([b[0] / b[1] for b in blocks], [int(b[2]) for b in blocks])


def threshold(score: np.ndarray, label: np.ndarray) -> float:
    """The lowest score whose calibrated share is high enough, moved half way to the next lower one.

    None if too few true spans pass it.
    """
    if not len(score):
        return np.inf
    value, share = calibrated(score, label)
    fit = np.flatnonzero(share >= MIN_PRECISION)
    if not len(fit) or label[score >= value[fit[0]]].sum() < MIN_PASSED:
        return np.inf
    return float((value[fit[0]] + value[max(fit[0] - 1, 0)]) / 2)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    column = batch.column(batch.schema.get_field_index("text"))
    for i in range(batch.num_rows):
        yield column[i].as_py() or ""


def _example_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for place, text in zip(batch.column(0).to_pylist(), _texts(batch)):
            rows, labels, kinds, judged = examples(text, str(place))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([place] * len(rows), pa.int64()), pa.array(labels, pa.int32()), pa.array(kinds, pa.int32()),
                    pa.array(judged, pa.int32()), pa.array([[float(v) for v in r] for r in rows], pa.list_(pa.float32())),
                ],
                names=["place", "label", "kind", "judged", "x"],
            )


def train(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_rows: int = FIT_ROWS) -> Trees:
    """Trees and thresholds from the documents with the ``fit_docs`` lowest id hashes.

    At most ``fit_rows`` candidate rows reach the driver, which hold numbers only.  A quarter
    of the documents sets the thresholds and is not fitted.  Without spans to learn from
    nothing passes the thresholds.
    """
    small_batches(docs.sparkSession)
    ids = (
        docs.select(F.xxhash64("doc_id").alias("place"), F.col("doc_id").alias("own_id")).filter("own_id is not null")
        .distinct().orderBy("place", "own_id").limit(fit_docs)
    )
    own = docs.select("doc_id", "text")
    # At most ``fit_docs`` pairs of numbers, so the texts stay where they are.
    texts = own.join(F.broadcast(ids), F.col("doc_id") == F.col("own_id")).select("place", "text")
    kind = "place long, label int, kind int, judged int, x array<float>"
    sample = texts.mapInArrow(_example_batches, kind).orderBy("place", "kind", "label", "judged", "x").limit(fit_rows).toArrow()
    place, label, of, judged = (np.asarray(sample.column(i)) for i in range(4))
    x = np.asarray(sample.column("x").combine_chunks().flatten(), np.float64).reshape(len(label), N_FEATURES)
    if len(label) == 0 or len(np.unique(label)) < 2:
        return Trees(np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 1)))
    held = (place.view(np.uint64) >> np.uint64(7)) % np.uint64(4) == 0
    trees = fit_trees(x[~held], label[~held].astype(np.float64))
    score = trees.score(x[held])
    for k in range(len(KINDS)):
        own = (of[held] == k) & (judged[held] == 1)
        trees.thresholds[k] = threshold(score[own], label[held][own])
    return trees


def added_spans(texts: list[str], trees: Trees) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of every text; added ones overlap no other, better scores first."""
    bases, spans, rows, owner = [], [], [], []
    for i, text in enumerate(texts):
        base, found = base_spans(text), proposed(text)
        bases.append(base)
        fresh = [s for s, near in zip(found, _overlaps(found, base)) if not near and np.isfinite(trees.thresholds[s[2]])]
        spans += fresh
        owner += [i] * len(fresh)
        rows += [features(text, s, len(found)) for s in fresh]
    out: list[tuple[list[Span], list[Span]]] = [(b, []) for b in bases]
    if not rows:
        return out
    score = trees.score(np.array(rows, np.float32).astype(np.float64)) - trees.thresholds[[s[2] for s in spans]]
    good = [i for i in range(len(spans)) if score[i] >= 0]
    taken: dict[int, set[int]] = {}
    # Better margins first, then longer spans; characters already taken block a span (spans are short).
    for i in sorted(good, key=lambda i: (owner[i], -score[i], spans[i][0] - spans[i][1], spans[i])):
        used = taken.setdefault(owner[i], set())
        start, end, _ = spans[i]
        if used.isdisjoint(range(start, end)):
            used.update(range(start, end))
            out[owner[i]][1].append(spans[i])
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def _span_batches(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            found = added_spans(list(_texts(part)), trees)
            counts = np.array([np.bincount([k for _, _, k in b], minlength=4) for b, _ in found], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), *[pa.array(counts[:, k]) for k in range(4)],
                    pa.array([written(b) for b, _ in found]), pa.array([written(b + a) for b, a in found]),
                    pa.array([len(a) for _, a in found], pa.int64()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans", "n_added"],
            )


def find(docs: DataFrame, trees: Trees) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_added``.

    The counts and ``base`` are those of the base rules, ``spans`` adds what the trees select;
    both list ``kind:start:end`` in code points, end exclusive, by start and kind.

    NULL and empty texts have no spans; rows without ``doc_id`` are searched like others.
    Repeated rows get equal spans.  Texts of any length are read whole, in one pass per rule.
    Ties between overlapping candidates go to the longer, then the earlier one.  Other columns
    are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _span_batches(it, trees), f"doc_id {kind}, {counts}, base string, spans string, n_added long"
    )


def redacted(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with the text's spans replaced by their kind in brackets."""
    place = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(_texts(batch))
            held = batch.column(place).is_valid().to_pylist()
            out = [redact(t, b + a) if ok else None for t, ok, (b, a) in zip(texts, held, added_spans(texts, trees))]
            arrays = [pa.array(out, pa.string()) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(cut, docs.schema)


def redact(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for start, end, kind in sorted(spans):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind]}]"]
        elif end > done:  # overlaps the span before: nothing of it stays
            out.append("")
        done = max(done, end)
    return "".join([*out, text[done:]])


def op12(docs: DataFrame) -> DataFrame:
    found = find(docs, train(docs))
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans", "n_added"
    )
