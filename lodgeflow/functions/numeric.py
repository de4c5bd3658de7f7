"""Numeric expressions over text that may not be numeric.

ANSI mode stays on, so every conversion of untrusted text uses the ``try_``
form: bad text becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_number(col: str | Column) -> Column:
    """Text -> double; null for anything that is not a number."""
    return _c(col).try_cast("double")


#: Text that a comparison with a whole number reads: a sign, digits, and a
#: fraction that is cut off; no exponent.
_WHOLE = r"^[\x00-\x20\x7F]*([+-]?[0-9]*)(\.[0-9]*)?[\x00-\x20\x7F]*$"
_SOME = r"[0-9.]"


def as_compared(col: str | Column) -> Column:
    """What is compared where text meets a whole number: the text as an int,
    its fraction cut off ('5.9' is 5, '0.9' and '.5' are 0); null for anything
    else ('1e1', 'x', '', out of range).  Columns that are no text are compared
    as they are."""
    c = _c(col)
    text = c.cast("string")
    whole = F.regexp_extract(text, _WHOLE, 1)
    number = F.when(whole.rlike("[0-9]"), whole.try_cast("int")).otherwise(F.lit(0))
    read = F.when(text.rlike(_WHOLE) & text.rlike(_SOME), number)
    return F.when(F.typeof(c) == "string", read.cast("double")).otherwise(c.try_cast("double"))


def as_decimal(col: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal, rounding half up at ``scale``; null for bad text."""
    return _c(col).try_cast(f"decimal({precision},{scale})")


def percent(part: str | Column, total: str | Column, places: int = 2,
            zero_total: float | None = None) -> Column:
    """``round(100 * part / total, places)`` computed exactly, ties to even.

    A tie is an exact half of the last place; rounding a binary float can differ
    where 100 * part / total is a tie that binary floats do not hold exactly
    (1.005, say).  Counts are integers, so the rounding is done in integer arithmetic and only
    the final value becomes a double: the result does not depend on how the
    engine rounds binary floats.  ``total = 0`` gives ``zero_total`` (null by
    default).
    """
    p, t = _c(part).cast("decimal(38,0)"), _c(total).cast("decimal(38,0)")
    scale = 10 ** places
    num = p * F.lit(200 * scale) + t
    den = t * F.lit(2)
    # exact floor division: remove the remainder first, the quotient is whole
    scaled = ((num - F.pmod(num, den)) / den).cast("decimal(38,0)")
    odd_tie = (F.pmod(num, den) == 0) & (F.pmod(scaled, F.lit(2)) == 1)
    scaled = F.when(odd_tie, scaled - 1).otherwise(scaled)
    value = scaled.cast("double") / F.lit(float(scale))
    fallback = F.lit(None).cast("double") if zero_total is None else F.lit(float(zero_total))
    return F.when(t == 0, fallback).otherwise(value)


def percent_of(part: int, total: int, places: int = 2) -> float | None:
    """``percent`` of two counts that are already on the driver."""
    if not total:
        return None
    scale = 10 ** places
    scaled, rest = divmod(100 * scale * part, total)
    up = 2 * rest > total or (2 * rest == total and scaled % 2 == 1)
    return (scaled + up) / scale
