"""Bring an arbitrary upload onto the contract and report every repair.

Columns are addressed by position internally, so an upload whose names differ only
in case, or repeat, never becomes ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.functions import coercion as C

SOURCE = "source_row"

# What the uploader is told.
BY_NAME = "{n} of the columns go by another spelling here, such as '{target}' for your '{source}'."
BY_POSITION = "Names missing: {n}. The columns were taken in their order instead."
#: Fitted spellings in the projection itself; the measured size up to which a table of them is broadcast.
LITERAL_LEVELS = 100
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64

FIRST_ONLY = "The file has {m} columns; those after the {n}th were left out."
NOT_NUMERIC = " cell(s) hold no number; they get the typical value."
NOT_CODE = " cell(s) hold no whole-number code; they count as an unknown one."
RECASED = " cell(s) were read as a known level that is written differently."


@dataclass(frozen=True)
class Alignment:
    """How an upload was matched, and the aligned frame.

    ``frame`` holds the contract features.  ``tracked`` holds them too, next to the
    caller's own row in the struct ``source_row`` (fields ``c0``, ``c1``, ...).
    """

    frame: DataFrame
    tracked: DataFrame
    strategy: str
    mapping: dict[str, str]
    source_names: tuple[str, ...]
    notes: tuple[str, ...] = ()
    trustworthy: bool = True
    repairs: tuple[tuple[str, str, Column], ...] = field(default=(), repr=False)
    _raw: DataFrame | None = field(default=None, repr=False)

    def mapping_table(self) -> DataFrame:
        rows = [(i, k, v) for i, (k, v) in enumerate(self.mapping.items())]
        return self.frame.sparkSession.createDataFrame(
            rows, "position int, read_as string, your_column string"
        )

    def coercion_counts(self) -> DataFrame:
        """One row per column and kind of repair that happened, from one aggregate."""
        sums = [F.count_if(test).alias(f"r{i}") for i, (_, _, test) in enumerate(self.repairs)]
        rows = F.array(
            *[
                F.struct(
                    F.lit(name).alias("column"), F.lit(kind).alias("repair"), F.col(f"r{i}").alias("n")
                )
                for i, (name, kind, _) in enumerate(self.repairs)
            ]
        )
        return self._raw.agg(*sums).select(F.inline(rows)).filter("n > 0")

    def coercion_notes(self) -> DataFrame:
        kind = F.col("repair")
        text = F.when(kind == "not_numeric", NOT_NUMERIC).when(kind == "not_code", NOT_CODE).otherwise(RECASED)
        return self.coercion_counts().select(
            "column", F.concat(F.col("column"), F.lit(": "), F.col("n").cast("string"), text).alias("note")
        )


def normalised_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", str(name).lower())


def recognised(df: DataFrame, contract: Contract = SESSION) -> tuple[int, int]:
    """How many required names are present, and how many there are."""
    return sum(c in df.columns for c in contract.features), len(contract.features)


def require_columns(df: DataFrame, contract: Contract = SESSION) -> None:
    missing = sorted(set(contract.features) - set(df.columns))
    if missing:
        raise ValueError(f"missing {len(missing)} required column(s): {missing}")


def match_columns(
    names: Sequence[str], contract: Contract = SESSION, allow_positional: bool = True
) -> tuple[str, list[int], tuple[str, ...]]:
    """Decide on names alone: (strategy, source position per feature, notes)."""
    required = contract.features
    first: dict[str, int] = {}
    for i, name in enumerate(names):
        first.setdefault(name, i)
    if all(r in first for r in required):
        return "exact", [first[r] for r in required], ()

    loose: dict[str, int] = {}
    for i, name in enumerate(names):
        loose.setdefault(normalised_name(name), i)
    found = {r: loose.get(normalised_name(r)) for r in required}
    unmatched = [r for r in required if found[r] is None]
    if not unmatched:
        spots = [found[r] for r in required]
        moved = [(r, names[i]) for r, i in zip(required, spots) if names[i] != r]
        note = BY_NAME.format(n=len(moved), source=moved[0][1], target=moved[0][0])
        return "normalised", spots, (note,)

    if not allow_positional:
        raise ValueError(f"no column for {len(unmatched)} required field(s): {sorted(unmatched)}")
    if len(names) < len(required):
        raise ValueError(
            f"matching by position needs {len(required)} columns or more, the upload has {len(names)}"
        )
    notes = [BY_POSITION.format(n=len(unmatched))]
    if len(names) > len(required):
        notes.append(FIRST_ONLY.format(n=len(required), m=len(names)))
    return "positional", list(range(len(required))), tuple(notes)


def align(
    df: DataFrame,
    contract: Contract = SESSION,
    allow_positional: bool = True,
    levels: Mapping[str, Sequence[str] | DataFrame] | None = None,
) -> Alignment:
    """Match the columns, coerce them to the contract types, keep the original row.

    ``levels`` gives the fitted spellings of text categories, as a list or as a table with a
    column ``level``.  Up to ``LITERAL_LEVELS`` of them travel in the projection itself, which
    is then narrow: no shuffle, no Python.  More, or a table, are joined: broadcast where their
    measured size allows, else shuffled.
    """
    levels = levels or {}
    names = tuple(df.columns)
    strategy, spots, notes = match_columns(names, contract, allow_positional)
    slots = [f"c{i}" for i in range(len(names))]
    raw = df.toDF(*slots)
    types = [f.dataType for f in df.schema.fields]

    out: list[Column] = []
    repairs: list[tuple[str, str, Column]] = []
    for name, i in zip(contract.features, spots):
        c, dtype = F.col(slots[i]), types[i]
        if name in contract.numeric:
            value = C.to_number(c, dtype)
            repairs.append((name, "not_numeric", _present(c, dtype) & value.isNull()))
        elif name in contract.coded_categorical:
            value = C.to_code(c, dtype)
            repairs.append((name, "not_code", _present(c, dtype) & C.to_number(c, dtype).isNull()))
        elif name in contract.flags:
            value = C.to_flag(c, dtype)
        else:
            text = C.to_text(c)
            given = levels.get(name, ())
            if isinstance(given, DataFrame) or len(given) > LITERAL_LEVELS:
                raw = _with_known(raw, text, given, f"known{i}")
                known = F.col(f"known{i}")
            else:
                known = C.known_level(text, list(given))
            value = F.coalesce(known, text)
            if isinstance(given, DataFrame) or given:
                repairs.append((name, "recased", known.isNotNull() & (known != text)))
        out.append(value.alias(name))
    return Alignment(
        frame=raw.select(*out),
        tracked=raw.select(F.struct(*slots).alias(SOURCE), *out),
        strategy=strategy,
        mapping={n: names[i] for n, i in zip(contract.features, spots)},
        source_names=names,
        notes=notes,
        trustworthy=strategy != "positional",
        repairs=tuple(repairs),
        _raw=raw,
    )


def _with_known(raw: DataFrame, text: Column, levels: Sequence[str] | DataFrame, name: str) -> DataFrame:
    """``raw`` with the fitted spelling of a text, NULL where there is none; one row stays one row."""
    if not isinstance(levels, DataFrame):
        # Of spellings that differ in case only the last counts, as in a literal table.
        last = {str(v).strip().lower(): str(v) for v in levels}
        levels = raw.sparkSession.createDataFrame([(v,) for v in last.values()], "level string")
    spelled = F.lower(F.trim("level"))
    table = levels.filter(F.col("level").isNotNull()).groupBy(spelled.alias(f"{name}_key")).agg(F.max("level").alias(name))
    size = table.agg(F.sum(F.octet_length(name) + F.octet_length(f"{name}_key") + ROW_BYTES)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return raw.join(table, F.lower(F.trim(text)) == F.col(f"{name}_key"), "left").drop(f"{name}_key")


def _present(c: Column, dtype) -> Column:
    """Neither NULL nor NaN, in whatever form the upload spells it."""
    number = C.raw_number(c, dtype)
    return c.isNotNull() & ~F.coalesce(F.isnan(number), F.lit(False))


def restore_source(df: DataFrame, names: Sequence[str], *added: str) -> DataFrame:
    """The caller's own columns under their own names, followed by ``added``."""
    fields = [F.col(f"{SOURCE}.c{i}").alias(f"c{i}") for i in range(len(names))]
    return df.select(*fields, *added).toDF(*names, *added)
