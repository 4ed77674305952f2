"""Bring loosely typed upload columns onto the declared types.

Every function takes the column together with its current type, so typed input
costs a plain cast and only text goes through the parsing rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings, the unknown code and the text of a missing category.
TRUE_WORDS = ["true", "1", "yes", "y", "t"]
FALSE_WORDS = ["false", "0", "no", "n", "f"]
UNKNOWN_CODE = -1
MISSING_TEXT = "nan"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITE = r"^(?i)[+-]?(inf|infinity)$"


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def raw_number(c: Column, dtype: T.DataType) -> Column:
    """Double, NULL where the text is not a number; NaN is kept."""
    if _is_number(dtype):
        return c.cast("double")
    text = F.trim(c.cast("string"))
    return F.when(F.lower(text) == "nan", F.lit(float("nan"))).when(
        text.rlike(_NUMBER) | text.rlike(_INFINITE), text.try_cast("double")
    )


def to_number(c: Column, dtype: T.DataType) -> Column:
    """``raw_number`` without NaN and the infinities: what is not a finite number is NULL."""
    v = raw_number(c, dtype)
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def to_code(c: Column, dtype: T.DataType) -> Column:
    """Nominal integer code; anything that cannot be read is the unknown code."""
    v = F.coalesce(to_number(c, dtype), F.lit(float(UNKNOWN_CODE)))
    return F.coalesce(F.rint(v).try_cast("int"), F.lit(UNKNOWN_CODE))


def to_flag(c: Column, dtype: T.DataType) -> Column:
    """Boolean from words, numbers by value, other non-empty text as true."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    raw = c.cast("string")
    word = F.lower(F.trim(raw))
    number = to_number(c, dtype)
    return (
        F.when(word.isin(TRUE_WORDS), True)
        .when(word.isin(FALSE_WORDS) | raw.isNull() | (word == "nan"), False)
        .when(number.isNotNull(), number != 0)
        .otherwise(F.length(raw) > 0)
    )


def to_text(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(MISSING_TEXT))


def known_level(c: Column, levels: list[str]) -> Column:
    """The fitted spelling that equals the text when case is ignored, else NULL."""
    if not levels:
        return F.lit(None).cast("string")
    spelling: dict[str, str] = {}
    for level in levels:
        spelling[str(level).strip().lower()] = str(level)
    table = F.create_map(*[F.lit(x) for pair in spelling.items() for x in pair])
    return F.try_element_at(table, F.lower(F.trim(c)))
