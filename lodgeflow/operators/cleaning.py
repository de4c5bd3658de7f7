"""Row-wise standardisation of booking records (SCA-1..9, PRJ-4, PRJ-5).

Every step is a narrow projection; the whole chain collapses into one
``Project`` inside one whole-stage-codegen span, and it works unchanged on a
streaming DataFrame.  Column lists are parameters; a listed column that is
absent is skipped (tolerant pipelines).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame

from lodgeflow import constants as K
from lodgeflow.functions import (clean_coordinate, digits_only, lower_trim, parse_date,
                                 strip_special, title_text, upper_text)


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def map_columns(df: DataFrame, cols: Iterable[str], fn) -> DataFrame:
    """Apply ``fn(col_name) -> Column`` to every listed column that exists, in
    one projection."""
    exprs: dict[str, Column] = {c: fn(c) for c in _present(df, cols)}
    return df.withColumns(exprs) if exprs else df


def strip_special_chars(df: DataFrame, cols: Iterable[str] = K.TEXT_CLEAN_COLUMNS) -> DataFrame:
    return map_columns(df, cols, strip_special)


def keep_digits(df: DataFrame, cols: Iterable[str] = K.PHONE_COLUMNS) -> DataFrame:
    return map_columns(df, cols, digits_only)


def clean_coordinates(df: DataFrame, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Cast to double, keep values inside the bounds and not 0, round to 6."""
    bounds = bounds or K.COORDINATE_BOUNDS
    exprs = {c: clean_coordinate(c, lo, hi) for c, (lo, hi) in bounds.items() if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def format_text(df: DataFrame,
                upper: Iterable[str] = K.UPPER_COLUMNS,
                title: Iterable[str] = K.TITLE_COLUMNS,
                lower_trimmed: Iterable[str] = K.LOWER_TRIM_COLUMNS,
                upper_trimmed: Iterable[str] = K.UPPER_TRIM_COLUMNS,
                title_trimmed: Iterable[str] = K.TITLE_TRIM_COLUMNS) -> DataFrame:
    exprs: dict[str, Column] = {}
    for c in _present(df, upper):
        exprs[c] = upper_text(c)
    for c in _present(df, title):
        exprs[c] = title_text(c)
    for c in _present(df, lower_trimmed):
        exprs[c] = lower_trim(c)
    for c in _present(df, upper_trimmed):
        exprs[c] = upper_text(c, trim=True)
    for c in _present(df, title_trimmed):
        exprs[c] = title_text(c, trim=True)
    return df.withColumns(exprs) if exprs else df


def parse_dates(df: DataFrame, cols: Iterable[str] = K.DATE_COLUMNS, fmt: str | None = None) -> DataFrame:
    return map_columns(df, cols, lambda c: parse_date(c, fmt))
