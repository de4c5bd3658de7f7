"""Gold layer build and validation (JOB-4, JOB-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgeflow.operators.gold import create_gold_views, register_gold_views, validate_gold_views
from lodgeflow.session import is_path


def build_gold(spark: SparkSession, validated: DataFrame, price_col: str = "total_price") -> dict[str, DataFrame]:
    return register_gold_views(spark, validated, price_col)


def refresh_gold(spark: SparkSession, validated: DataFrame | str, price_col: str = "total_price",
                 database: str | None = None) -> DataFrame:
    """Define the three gold views over the validated table and check them.

    For a table of the catalog (by name) they are views of the catalog, in
    ``database`` (default: the table's own); over a DataFrame or a folder they
    are temporary views."""
    if isinstance(validated, str) and not is_path(validated):
        home = database or (validated.rpartition(".")[0] or spark.catalog.currentDatabase())
        return validate_gold_views(spark, create_gold_views(spark, validated, home, price_col))
    if isinstance(validated, str):
        validated = spark.read.parquet(validated)
    build_gold(spark, validated, price_col)
    return validate_gold_views(spark)
