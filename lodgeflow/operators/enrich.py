"""Scalar enrichment from one-row reference tables (JOI-3, SRC-3, SCA-10..12, MET-5).

The rate and temperature tables hold one row per load.  Each is reduced by a
global aggregate (exactly one row, even when the table is empty), read as one
scalar, and placed in the plan as a literal, so the enrichment itself stays a
narrow projection with no join.  A missing table or column, or a null value,
falls back to the constant; the two fall back independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.constants import FALLBACK_EUR_RATE, FALLBACK_TEMPERATURE
from lodgeflow.functions import as_number


def read_scalar(table: DataFrame | None, column: str, latest_by: str | None = None):
    """The value of ``column`` in a one-row table (the newest row by
    ``latest_by`` when several loads are kept); None when unavailable."""
    if table is None or column not in table.columns:
        return None
    if latest_by and latest_by in table.columns:
        agg = F.max_by(F.col(column), F.col(latest_by))
    else:
        agg = F.max(F.col(column))
    return table.agg(agg.alias("v")).first()["v"]


def enrichment_values(rate_table: DataFrame | None = None, rate_col: str = "eur_rate",
                      weather_table: DataFrame | None = None, temp_col: str = "temperature",
                      latest_by: str | None = "ingested_at",
                      default_rate: float = FALLBACK_EUR_RATE,
                      default_temp: float = FALLBACK_TEMPERATURE) -> dict:
    """The rate and temperature to apply, and whether each fell back (MET-5)."""
    rate = read_scalar(rate_table, rate_col, latest_by)
    temp = read_scalar(weather_table, temp_col, latest_by)
    return {"eur_rate": float(default_rate if rate is None else rate), "rate_is_fallback": rate is None,
            "temperature": float(default_temp if temp is None else temp), "temperature_is_fallback": temp is None}


def enrich(df: DataFrame, price_col: str = "total_price",
           rate_table: DataFrame | None = None, rate_col: str = "eur_rate",
           weather_table: DataFrame | None = None, temp_col: str = "temperature",
           latest_by: str | None = "ingested_at",
           default_rate: float = FALLBACK_EUR_RATE, default_temp: float = FALLBACK_TEMPERATURE,
           price_out: str = "total_price_eur", temp_out: str = "ingested_temp",
           processed_at: str | None = "silver_processed_at",
           fallback_flag: str | None = None, values: dict | None = None) -> DataFrame:
    """Add the converted price, the temperature and the processing time.

    ``values`` (from ``enrichment_values``) skips re-reading the reference
    tables; ``fallback_flag`` names an optional column recording whether the
    rate fell back."""
    v = values or enrichment_values(rate_table, rate_col, weather_table, temp_col, latest_by,
                                    default_rate, default_temp)
    cols = {
        price_out: F.round(as_number(price_col) * F.lit(v["eur_rate"]), 2),
        temp_out: F.lit(v["temperature"]),
    }
    if fallback_flag:
        cols[fallback_flag] = F.lit(v["rate_is_fallback"])
    if processed_at:
        cols[processed_at] = F.current_timestamp()
    return df.withColumns(cols)
