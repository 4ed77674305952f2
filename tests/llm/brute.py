"""Plain versions of the text operators for small tables: rows are (doc_id, text)."""

from __future__ import annotations

import collections
import hashlib
import re

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def place(doc_id):
    return -(2**63) if doc_id is None else doc_id


def covered(units, window, first_of, rows):
    """Per row the covered units; ``first_of`` maps a window to what comes first."""
    out = []
    for r, own in enumerate(units):
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if first_of(tuple(own[i : i + window]), r, i):
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def suffix_dedup(rows):
    units = [(t or "").encode() for _, t in rows]
    least = {}
    for (d, _), own in zip(rows, units):
        for i in range(len(own) - 99):
            k = tuple(own[i : i + 100])
            least[k] = min(least.get(k, (place(d), i)), (place(d), i))
    gone = covered(units, 100, lambda k, r, i: least[k] < (place(rows[r][0]), i), rows)
    out = []
    for (d, _), own, g in zip(rows, units, gone):
        spans = sum(x and (i == 0 or not g[i - 1]) for i, x in enumerate(g))
        out.append((d, len(own), sum(g), spans, sha(bytes(b for b, x in zip(own, g) if not x))))
    return out


def line_dedup(rows, min_chars=20, min_docs=3):
    lines = [(t or "").split("\n") for _, t in rows]
    key = lambda x: x.strip(" \t\n\v\f\r").translate(LOW)
    held = collections.defaultdict(set)
    for (d, _), own in zip(rows, lines):
        for x in own:
            if len(key(x)) >= min_chars:
                held[key(x)].add(place(d))
    out = []
    for (d, _), own in zip(rows, lines):
        kept = [x for x in own if len(held.get(key(x), ())) < min_docs or place(d) == max(held[key(x)])]
        out.append((d, len(own), len(own) - len(kept), sha("\n".join(kept))))
    return out


def decontamination(rows, items):
    windows = collections.defaultdict(set)
    for name, text in items:
        w = tuple(LETTERS.findall((text or "").translate(LOW)))
        for i in range(max(len(w) - 12, 1)):
            if w:
                windows[w[i : i + 13]].add("" if name is None else str(name))
    out = []
    for d, text in rows:
        w = tuple(LETTERS.findall((text or "").translate(LOW)))
        hit, found = [False] * len(w), set()
        for k, names in windows.items():
            for i in range(len(w) - len(k) + 1):
                if w[i : i + len(k)] == k:
                    hit[i : i + len(k)] = [True] * len(k)
                    found |= names
        n = sum(hit)
        out.append((d, len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)))
    return out


def substring_dedup(rows, window=13):
    units = [PLAIN.findall(t or "") for _, t in rows]
    least = {}
    for (d, _), own in zip(rows, units):
        for i in range(len(own) - window + 1):
            k = tuple(own[i : i + window])
            least[k] = min(least.get(k, place(d)), place(d))
    gone = covered(units, window, lambda k, r, i: least[k] < place(rows[r][0]), rows)
    return [
        (d, len(own), sum(g), sha(" ".join(w for w, x in zip(own, g) if not x)))
        for (d, _), own, g in zip(rows, units, gone)
    ]


def statistics(text):
    text = text or ""
    w = PLAIN.findall(text)
    triples = collections.Counter(zip(w, w[1:], w[2:]))
    again = {j for i in range(len(w) - 2) if triples[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if PLAIN.search(x)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed,
    )


def jaccard(rows):
    sets = []
    for _, t in rows:
        w = PLAIN.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(place(d))
    label = [min(least[root(i)]) for i in range(len(rows))]
    return [(d, len(s), None if c == place(None) else c, n) for (d, _), s, c, n in zip(rows, sets, label, links)]
