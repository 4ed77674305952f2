"""Odd texts that every operator meets, as fixtures."""

import random

import pytest


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeioubcdfgstrn") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """NULL, empty, blank, very long, tied, repeated and hot texts, in odd places."""
    rng = random.Random(3)
    base, passage, line = sentence(rng, 90), sentence(rng, 40), "  A line that MANY texts share, tabs\t"
    near = base.split()
    near[45] = "Changed"
    rows = [
        (1, None), (2, ""), (3, " \t\r\n\v\f "), (4, "\n\n"), (5, base), (5, base), (6, base), (None, base), (None, None),
        (7, " ".join(near)), (8, base.upper()), (9, sentence(rng, 20) + " " + passage + " " + sentence(rng, 30)),
        (10, passage + "\n" + sentence(rng, 60)), (11, sentence(rng, 30000)), (12, "one two three"), (13, "One  two three"),
        (14, "one two"), (15, "ß é 日本語 🙂 " + passage), (16, "ab " * 300), (17, "x" * 5000), (18, "x" * 150),
        (19, "▁ literal\x00mark  and   spaces "), (20, passage + " " + passage),
    ]
    rows += [(100 + i, f"{line}\n{sentence(rng, 15)}\n{line.upper() if i % 2 else line}") for i in range(30)]
    rows += [(200 + i, " ".join(w if rng.random() > 0.01 else "edit" for w in base.split())) for i in range(60)]
    rows += [(300 + i, sentence(rng, 5) + " " + passage) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return odd_rows()


#: Extra columns with names that the operators use inside.
CLASHES = ["row", "doc", "tag", "key", "hash", "body", "n_words", "kept", "dropped_at", "row_hash", "label", "n", "rep"]


@pytest.fixture(scope="session")
def docs(spark, rows):
    made = [(d, t, None if (d or 0) % 7 == 0 else "en", None if (d or 0) % 5 == 0 else "s", None, *["x"] * len(CLASHES)) for d, t in rows]
    extra = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(made, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}").repartition(5)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.filter("doc_id < -5")

