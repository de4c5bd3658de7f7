"""Ordered top-k and samples (SRT-2, SRT-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.constants import LATEST_N


def latest(df: DataFrame, order_col: str, n: int = LATEST_N,
           tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows; ties broken by ``tie_breakers`` so the result is
    repeatable.  Planned as ``TakeOrderedAndProject`` (per-task top-n, then a
    merge of n rows per task)."""
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).asc() for c in tie_breakers]
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows (a preview)."""
    return df.limit(n)
