"""Coordinate clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeflow.constants import COORDINATE_PLACES
from lodgeflow.functions.numeric import as_number


def clean_coordinate(col: str | Column, low: float, high: float,
                     places: int = COORDINATE_PLACES) -> Column:
    """Text or number -> double rounded to ``places``; null when outside
    ``[low, high]``, exactly 0 (treated as missing) or not a number."""
    v = as_number(col)
    return F.when(v.between(low, high) & (v != 0), F.round(v, places))
