"""Dictionary look-ups (JOI-2, SCA-8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.constants import LANGUAGE_BY_COUNTRY


def lookup_constant(df: DataFrame, key_col: str, out_col: str,
                    mapping: Mapping[str, str] = LANGUAGE_BY_COUNTRY) -> DataFrame:
    """``out_col = mapping[key_col]`` (null when the key is missing or null).

    A constant dictionary becomes one literal map inside the projection: no
    join, no shuffle, and it works on streams.  Keys are unique because a
    Python mapping is.
    """
    if not mapping:
        return df.withColumn(out_col, F.lit(None).cast("string"))
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return df.withColumn(out_col, F.create_map(*pairs)[F.col(key_col)])


def lookup_table(df: DataFrame, key_col: str, dictionary: DataFrame, dict_key: str,
                 dict_value: str, out_col: str) -> DataFrame:
    """Left look-up against a dictionary held as a table.

    Repeated dictionary keys are reduced to one (the smallest value) so the
    join never multiplies rows; whether it is broadcast is left to its measured
    size (adaptive execution), so no job runs while the query is built.
    """
    d = (dictionary.groupBy(F.col(dict_key).alias("__k"))
         .agg(F.min(dict_value).alias(out_col)))
    out = df.join(d, F.col(key_col) == F.col("__k"), "left").drop("__k")
    return out
