"""Blank-padded text, numbers in text and message building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    return F.trim(text) == ""


def char_n(text: Column, width: int) -> Column:
    """Fixed-width CHAR(n): cut on the right, padded with blanks."""
    return F.rpad(text, width, " ")


def cut(text: Column, width: int) -> Column:
    """CHAR(n) as stored here: cut on the right, trailing blanks dropped."""
    return F.rtrim(F.substring(text, 1, width))


def to_decimal(text: Column, precision: int, scale: int = 0) -> Column:
    """Number held in text; NULL for blank or malformed input instead of a failed job."""
    return F.trim(text).try_cast(f"decimal({precision},{scale})")


def to_id(text: Column) -> Column:
    """An 11-digit identifier held in text."""
    return to_decimal(text, 11).cast("bigint")


def as_text(value: Column) -> Column:
    return F.trim(value.cast("string"))


def message(*parts: str | Column, width: int | None = 50) -> Column:
    """Join labels and values; a NULL value prints as nothing. Cut to CHAR(width) unless None."""
    pieces = [F.lit(p) if isinstance(p, str) else F.coalesce(as_text(p), F.lit("")) for p in parts]
    text = F.concat(*pieces)
    return text if width is None else cut(text, width)
