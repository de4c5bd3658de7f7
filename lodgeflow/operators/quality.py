"""Data-quality checks in one pass (DQ-1..7, FLT-5..9, AGG-4, SNK-4..6).

A check is a name plus an aggregate expression that counts failing rows.  All
checks of a suite go into one ``agg`` (one scan; the uniqueness check adds one
shuffle on the key after map-side pre-aggregation).  Null follows SQL
three-valued logic: a null value fails only a null check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodgeflow import constants as K
from lodgeflow.functions import as_compared, as_number, parse_date, percent
from lodgeflow.operators.metrics import distinct_keys

_TOTAL = "total_records"


@dataclass(frozen=True)
class Check:
    name: str
    failures: Column  # aggregate expression: number of failing rows


def unique(col: str, name: str = K.CHECK_UNIQUE_BOOKING) -> Check:
    """Rows minus distinct values (a null key counts as one value)."""
    return Check(name, F.count(F.lit(1)) - distinct_keys(col))


def not_null(col: str, name: str = K.CHECK_NOT_NULL_HOTEL) -> Check:
    return Check(name, F.count_if(F.col(col).isNull()))


def in_range(col: str | Column, low, high, name: str = K.CHECK_STAR_RANGE) -> Check:
    c = F.col(col) if isinstance(col, str) else col
    return Check(name, F.count_if(~c.between(low, high)))


def coordinates_in_range(lat: str | Column = "latitude", lon: str | Column = "longitude",
                         name: str = K.CHECK_LAT_LONG) -> Check:
    (la, ha), (lo, ho) = K.COORDINATE_BOUNDS["latitude"], K.COORDINATE_BOUNDS["longitude"]
    a = F.col(lat) if isinstance(lat, str) else lat
    b = F.col(lon) if isinstance(lon, str) else lon
    return Check(name, F.count_if(~a.between(la, ha) | ~b.between(lo, ho)))


def not_before(later: str | Column, earlier: str | Column, name: str = K.CHECK_DATE_LOGIC) -> Check:
    """Fails where ``later < earlier``."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return Check(name, F.count_if(a < b))


def matches(df: DataFrame, col: str, pattern: str = K.DIGITS_ONLY_PATTERN,
            name: str = K.CHECK_PHONE_DIGITS) -> Check:
    """Fails where the text does not match; 0 when the column is absent."""
    if col not in df.columns:
        return Check(name, F.lit(0).cast("long"))
    return Check(name, F.count_if(~F.col(col).rlike(pattern)))


def numeric(df: DataFrame, col: str, truncate_numeric: bool = True) -> Column:
    """A text column as the number that a range with whole bounds compares
    (``as_compared``; ``truncate_numeric=False``: as a double); bad text is
    null, never an error under ANSI.  Any other column as is."""
    if isinstance(df.schema[col].dataType, StringType):
        return as_compared(col) if truncate_numeric else as_number(col)
    return F.col(col)


def as_date(df: DataFrame, col: str) -> Column:
    """A text column parsed as a date (ISO text, bad text null)."""
    if isinstance(df.schema[col].dataType, StringType):
        return parse_date(col)
    return F.col(col)


def blocking_suite(df: DataFrame, truncate_numeric: bool = True) -> list[Check]:
    """The four blocking checks of the publish gate."""
    return [unique("booking_id"), not_null("hotel_id"),
            in_range(numeric(df, "star_rating", truncate_numeric), 1, 5),
            coordinates_in_range(numeric(df, "latitude", truncate_numeric),
                                 numeric(df, "longitude", truncate_numeric))]


def extended_suite(df: DataFrame, truncate_numeric: bool = True) -> list[Check]:
    """The six-check variant (adds date order and phone format)."""
    return [unique("booking_id"), not_null("hotel_id"),
            in_range(numeric(df, "star_rating", truncate_numeric), 1, 5),
            not_before(as_date(df, "checkout_date"), as_date(df, "checkin_date")),
            matches(df, "phone"),
            coordinates_in_range(numeric(df, "latitude", truncate_numeric),
                                 numeric(df, "longitude", truncate_numeric))]


def check_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row: ``total_records`` and one failure count per check (by name)."""
    aggs = [F.count(F.lit(1)).alias(_TOTAL)]
    aggs += [c.failures.cast("long").alias(c.name) for c in checks]
    return df.agg(*aggs)


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, failures, total, success %, passed, and the
    suite outcome (every check passed) repeated on each row."""
    wide = check_counts(df, checks)
    names = [c.name for c in checks]
    all_ok = F.lit(True)
    for n in names:
        all_ok = all_ok & (F.col(f"`{n}`") == 0)
    wide = wide.withColumn("suite_success", all_ok)
    long = wide.unpivot([_TOTAL, "suite_success"], [F.col(f"`{n}`") for n in names],
                        "check_name", "fail_count")
    return long.select(
        "check_name", "fail_count", _TOTAL,
        percent(F.col(_TOTAL) - F.col("fail_count"), _TOTAL).alias("success_pct"),
        (F.col("fail_count") == 0).alias("passed"),
        "suite_success")


def evaluate(df: DataFrame, checks: Sequence[Check]) -> dict:
    """Run the suite as one job and return ``{total_records, results, success}``
    (the machine-readable report; one row reaches the driver)."""
    row = check_counts(df, checks).first().asDict()
    results = [{"name": c.name, "fail_count": int(row[c.name])} for c in checks]
    return {"evaluation_parameters": {"total_records": int(row[_TOTAL])},
            "results": results,
            "success": all(r["fail_count"] == 0 for r in results)}


class QualityGateError(Exception):
    """Raised when a blocking suite fails; stops the run order."""
