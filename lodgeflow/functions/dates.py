"""Date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(col: str | Column, fmt: str | None = None) -> Column:
    """Text -> date; null for text that is not a date (never raises)."""
    c = F.col(col) if isinstance(col, str) else col
    if fmt:
        return F.try_to_date(c, F.lit(fmt))
    return c.try_cast("date")
