"""Report-side queries over the gold tables (JOI-1, AGG-7, AGG-8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def count_by_dimension(fact: DataFrame, dim: DataFrame, key: str = "city",
                       measure: str = "booking_id", out: str = "booking_count",
                       keep_empty: bool = False, unknown: bool = False) -> DataFrame:
    """Non-null ``measure`` count per dimension value, as a map visual asks.

    The fact is aggregated by the key first (map-side combine), so the join
    sees one row per key; the dimension is reduced to its distinct keys, so a
    non-unique dimension key cannot multiply the counts.  Only keys present in
    the dimension are reported, and (like a visual, where a count over no
    values is blank) keys with a zero count are left out unless
    ``keep_empty``.  ``unknown`` adds the row that a report shows without a
    name: everything whose key is null or not in the dimension.  The join's
    strategy is left to the measured sizes of both sides.
    """
    per_key = fact.groupBy(key).agg(F.count(F.col(measure)).alias(out))
    if not keep_empty:
        per_key = per_key.where(F.col(out) > 0)
    keys = dim.select(key).where(F.col(key).isNotNull()).distinct()
    if not unknown:
        return per_key.join(keys, key, "left_semi")
    known = per_key.join(keys.withColumn("__known", F.lit(True)), key, "left")
    return (known.groupBy(F.when(F.col("__known"), F.col(key)).alias(key))
            .agg(F.sum(out).alias(out)))


_AGGS = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "avg": F.avg}


def implicit_totals(df: DataFrame, measures: Mapping[str, str],
                    by: Sequence[str] = ()) -> DataFrame:
    """Default aggregation of each measure column (``{"col": "sum"}``), grouped
    by ``by`` (nothing: one total row).  Sums keep the column's type."""
    aggs = []
    for col, how in measures.items():
        expr = _AGGS[how](F.col(col))
        if how == "sum":
            expr = expr.cast(df.schema[col].dataType)
        aggs.append(expr.alias(col))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
