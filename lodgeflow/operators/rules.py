"""Key and business-rule filters (FLT-1, FLT-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.constants import KEY_COLUMNS
from lodgeflow.functions import as_compared, as_number


def null_key_predicate(keys: Sequence[str] = KEY_COLUMNS) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def drop_null_keys(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    return df.na.drop(subset=list(keys))


def business_rule(price: str = "total_price", adults: str = "adults", star: str = "star_rating",
                  nights: str = "nights", truncate_numeric: bool = True) -> Column:
    """``price > 0 AND adults > 0 AND star BETWEEN 1 AND 5 AND nights > 0`` over
    text columns.  Text is compared as the original compares it with whole
    numbers (``as_compared``: '0.9' is 0, '1e1' is null); ``truncate_numeric=False``
    compares it as a double.  Non-numbers are null, so the row fails
    (three-valued logic)."""
    n = as_compared if truncate_numeric else as_number
    # implied by the comparisons, but this reaches the scan
    there = F.lit(True)
    for c in (price, adults, star, nights):
        there = there & F.col(c).isNotNull()
    return there & (n(price) > 0) & (n(adults) > 0) & n(star).between(1, 5) & (n(nights) > 0)


def apply_business_rules(df: DataFrame, truncate_numeric: bool = True, **cols: str) -> DataFrame:
    return df.filter(business_rule(truncate_numeric=truncate_numeric, **cols))
