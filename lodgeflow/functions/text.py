"""Text clean-up expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeflow.constants import NON_DIGIT_PATTERN, SPECIAL_CHARS_PATTERN


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_special(col: str | Column, pattern: str = SPECIAL_CHARS_PATTERN) -> Column:
    """Drop the punctuation characters ``! @ # $ % ^ & * ( ) . ,`` then trim
    spaces (not tabs) at both ends.  (A compiled character class beats
    ``translate`` on long texts, which boxes every character.)"""
    return F.trim(F.regexp_replace(_c(col), pattern, ""))


def digits_only(col: str | Column) -> Column:
    """Keep the digits of a phone-like text."""
    return F.regexp_replace(_c(col), NON_DIGIT_PATTERN, "")


def upper_text(col: str | Column, trim: bool = False) -> Column:
    c = _c(col)
    return F.upper(F.trim(c) if trim else c)


def title_text(col: str | Column, trim: bool = False) -> Column:
    """Capitalise the first letter of each space-separated word, lower the rest."""
    c = _c(col)
    return F.initcap(F.trim(c) if trim else c)


def lower_trim(col: str | Column) -> Column:
    return F.lower(F.trim(_c(col)))
