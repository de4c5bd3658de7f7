"""Landed API payloads (SRC-4, SRC-5).

The HTTP calls themselves are outside the engine; their JSON bodies are
landed as files and read here with an explicit schema, so any number of loads
is read in parallel and a malformed body yields nulls, not a failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType

from lodgeflow.constants import BASE_CURRENCY, CURRENCY_CODES

WEATHER_SCHEMA = StructType([
    StructField("current_weather", StructType([
        StructField("time", StringType()),
        StructField("interval", LongType()),
        StructField("temperature", DoubleType()),
        StructField("windspeed", DoubleType()),
        StructField("winddirection", LongType()),
        StructField("is_day", LongType()),
        StructField("weathercode", LongType()),
    ])),
])

CURRENCY_SCHEMA = StructType([
    StructField("base", StringType()),
    StructField("date", StringType()),
    StructField("rates", MapType(StringType(), DoubleType())),
])


def weather_rows(payloads: DataFrame) -> DataFrame:
    """One row per payload: the fields of ``current_weather`` + load time."""
    return payloads.select("current_weather.*").withColumn("ingested_at", F.current_timestamp())


def currency_rows(payloads: DataFrame, codes: Sequence[str] = CURRENCY_CODES,
                  base: str = BASE_CURRENCY) -> DataFrame:
    """``base_currency``, one ``<code>_rate`` column per code (null when the
    payload lacks it), ``update_date`` and load time."""
    cols = [F.lit(base).alias("base_currency")]
    cols += [F.col("rates")[c].alias(f"{c.lower()}_rate") for c in codes]
    cols += [F.col("date").alias("update_date"), F.current_timestamp().alias("ingested_at")]
    return payloads.select(*cols)


def read_payloads(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
