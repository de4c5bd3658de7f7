"""Null profile of a table (PRJ-3, PRJ-7, PRJ-8, AGG-2, SCA-14, SRT-1).

One aggregate computes every column's null (or NaN) count in a single scan;
``unpivot`` turns the one wide row into one row per column without bringing
anything to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lodgeflow.functions import percent

_TOTAL = "__total_rows"


def missing_condition(df: DataFrame, name: str):
    c = F.col(f"`{name}`")
    dtype = df.schema[name].dataType
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(Column_Name, Null_Count, Missing_Percentage)``, most missing first.

    An empty table gives 0 %.
    """
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias(_TOTAL)]
    aggs += [F.count_if(missing_condition(df, c)).alias(c) for c in columns]
    wide = df.agg(*aggs)
    long = wide.unpivot(_TOTAL, [F.col(f"`{c}`") for c in columns], "Column_Name", "Null_Count")
    return (long.select(
                "Column_Name",
                F.col("Null_Count").cast("long").alias("Null_Count"),
                percent("Null_Count", _TOTAL, 2, zero_total=0.0).alias("Missing_Percentage"))
            .orderBy(F.col("Missing_Percentage").desc(), F.col("Column_Name")))
