"""Stage metrics (AGG-1, AGG-3, MET-1..4, SCA-15).

Each report is one aggregate over the data it describes, so a stage costs one
scan instead of one job per number.  Percentages are null on empty input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions import percent
from lodgeflow.operators.rules import null_key_predicate


def distinct_keys(key: str | Sequence[str]) -> Column:
    """Number of distinct keys, a null key counting as one (like ``distinct()``)."""
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1:
        k = F.col(keys[0])
        return F.count_distinct(k) + F.coalesce(F.max(k.isNull().cast("int")), F.lit(0))
    # several keys: a row with any null key is still a distinct tuple
    return F.count_distinct(F.struct(*[F.col(k) for k in keys]))


def ingest_summary(df: DataFrame, source: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count"), F.lit(source).alias("source"))


def dedup_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    r = df.agg(F.count(F.lit(1)).alias("rows_before"), distinct_keys(key).alias("rows_after"))
    return r.select("rows_before", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                    "rows_after",
                    percent(F.col("rows_before") - F.col("rows_after"), "rows_before").alias("removed_pct"))


def lookup_coverage(df: DataFrame, out_col: str) -> DataFrame:
    r = df.agg(F.count(F.lit(1)).alias("total"), F.count(F.col(out_col)).alias("filled"))
    return r.select("total", "filled", (F.col("total") - F.col("filled")).alias("missing"),
                    percent("filled", "total").alias("filled_pct"),
                    percent(F.col("total") - F.col("filled"), "total").alias("missing_pct"))


def filter_report(df: DataFrame, keys: Sequence[str], rule: Column) -> DataFrame:
    """Counts around ``na.drop(keys)`` + ``filter(rule)`` on the unfiltered frame."""
    null_keys = null_key_predicate(keys)
    r = df.agg(F.count(F.lit(1)).alias("rows_before"),
               F.count_if(null_keys).alias("null_key_rows"),
               F.count_if(~null_keys & F.coalesce(rule, F.lit(False))).alias("rows_after"))
    return r.select("rows_before", "null_key_rows",
                    (F.col("rows_before") - F.col("rows_after") - F.col("null_key_rows")).alias("rule_failures"),
                    "rows_after",
                    percent(F.col("rows_before") - F.col("rows_after"), "rows_before").alias("loss_pct"))
