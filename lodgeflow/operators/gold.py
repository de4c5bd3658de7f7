"""Gold layer: booking facts, city dimension and revenue per hotel
(PRJ-2, PRJ-6, SCA-13, AGG-5, AGG-6, SNK-8, FLT-11, SRT-4, JOB-4, JOB-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow import constants as K
from lodgeflow.functions import as_decimal


def fact_booking(validated: DataFrame, price_col: str = "total_price",
                 columns: Sequence[str] = K.FACT_COLUMNS,
                 price_out: str = "total_price_eur") -> DataFrame:
    """Projection of the validated table plus the price as decimal(18,2).

    The original casts the unconverted ``total_price`` under the EUR name;
    pass ``price_col="total_price_eur"`` to use the converted value instead.
    """
    return validated.select(*[F.col(c) for c in columns],
                            as_decimal(price_col, 18, 2).alias(price_out))


def dim_city(validated: DataFrame, columns: Sequence[str] = K.DIM_CITY_COLUMNS) -> DataFrame:
    """Distinct (city, country, latitude, longitude); ``city`` is not unique."""
    return validated.select(*columns).distinct()


def kpi_revenue(fact: DataFrame, by: str = "hotel_name", amount: str = "total_price_eur",
                key: str = "booking_id") -> DataFrame:
    """Revenue (decimal(38,2)) and non-null bookings per hotel name.

    Partial aggregation runs before the shuffle, so a hotel holding a third of
    all bookings sends one row per task, not a third of the rows.
    """
    return fact.groupBy(by).agg(
        F.sum(F.col(amount)).cast("decimal(38,2)").alias("total_revenue"),
        F.count(F.col(key)).alias("total_bookings"))


def gold_view_sql(validated: str, database: str, price_col: str = "total_price") -> dict[str, str]:
    """The three gold views over the table ``validated`` as statements, in the
    order in which they build on each other (the revenue reads the fact)."""
    price = "total_price_eur"
    name = {v: f"{database}.{v}" for v in (K.GOLD_FACT_VIEW, K.GOLD_DIM_VIEW, K.GOLD_KPI_VIEW)}
    bodies = {
        K.GOLD_FACT_VIEW: f"SELECT {', '.join(K.FACT_COLUMNS)}, "
                          f"TRY_CAST({price_col} AS DECIMAL(18, 2)) AS {price} FROM {validated}",
        K.GOLD_DIM_VIEW: f"SELECT DISTINCT {', '.join(K.DIM_CITY_COLUMNS)} FROM {validated}",
        K.GOLD_KPI_VIEW: f"SELECT hotel_name, CAST(SUM({price}) AS DECIMAL(38, 2)) AS total_revenue, "
                         f"COUNT(booking_id) AS total_bookings FROM {name[K.GOLD_FACT_VIEW]} GROUP BY hotel_name",
    }
    return {name[v]: f"CREATE OR REPLACE VIEW {name[v]} AS {body}" for v, body in bodies.items()}


def create_gold_views(spark: SparkSession, validated: str, database: str,
                      price_col: str = "total_price") -> list[str]:
    """Define the gold views in the catalog (SNK-8), so that they are there for
    every other session as well; ``validated`` is a table of the catalog.
    Returns the views' names."""
    statements = gold_view_sql(validated, database, price_col)
    for statement in statements.values():
        spark.sql(statement)
    return list(statements)


def register_gold_views(spark: SparkSession, validated: DataFrame,
                        price_col: str = "total_price") -> dict[str, DataFrame]:
    """The same three as temporary views of this session, over a DataFrame
    (a folder, say, which the catalog doesn't know)."""
    fact = fact_booking(validated, price_col)
    views = {K.GOLD_FACT_VIEW: fact, K.GOLD_DIM_VIEW: dim_city(validated),
             K.GOLD_KPI_VIEW: kpi_revenue(fact)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


class GoldViewsMissing(Exception):
    pass


def validate_gold_views(spark: SparkSession,
                        names: Sequence[str] = (K.GOLD_FACT_VIEW, K.GOLD_DIM_VIEW, K.GOLD_KPI_VIEW)
                        ) -> DataFrame:
    """Existence test for every view, then a one-row probe of each.

    Returns ``(view_name, view_exists, probe_rows)``; each probe takes one row
    of its view (``LIMIT 1``) with all its columns, so a view that cannot be
    evaluated fails the check.  Raises when a view is missing.
    """
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise GoldViewsMissing(f"Gold layer views are missing: {', '.join(missing)}")
    # the row itself is gathered: a mere count would read no column
    probes = [spark.table(n).limit(1).agg(F.size(F.collect_list(F.struct("*"))).cast("long").alias("probe_rows"))
              .select(F.lit(n).alias("view_name"), F.lit(True).alias("view_exists"), "probe_rows")
              for n in names]
    out = probes[0]
    for p in probes[1:]:
        out = out.unionByName(p)
    return out
