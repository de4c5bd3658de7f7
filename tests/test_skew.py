"""One key holding a third of all rows: results stay whole and exact, and the
plans pre-aggregate (or pre-limit) before every shuffle on that key."""

from pyspark.sql import functions as F

from lodgeflow.operators import gold, quality
from lodgeflow.operators.dedup import dedup_by_key
from lodgeflow.plans.silver import silver_metrics

N = 30_000


def skewed(spark):
    # ids 0..N-1; a third of the rows share booking_id "HOT" and hotel "Hot Inn"
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("booking_id"),
        F.when(F.col("id") % 3 == 0, F.lit("h0")).otherwise(F.concat(F.lit("h"), (F.col("id") % 50).cast("string"))).alias("hotel_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot Inn")).otherwise(F.lit("Cold Inn")).alias("hotel_name"),
        (F.col("id") % 7 + 1).cast("string").alias("star_rating"),
        F.lit("2").alias("adults"), F.lit("1").alias("nights"),
        (F.col("id") % 1000 + 1).cast("string").alias("total_price"),
        F.col("id").alias("seq"))
    return df.repartition(8)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_hot_key(spark):
    df = skewed(spark)
    out = dedup_by_key(df, "booking_id", [F.col("seq")])
    rows = out.where("booking_id = 'HOT'").collect()
    assert len(rows) == 1 and rows[0]["seq"] == 0
    assert out.count() == N - N // 3 + 1
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p  # partial limit runs before the exchange


def test_kpi_hot_hotel(spark):
    df = skewed(spark)
    fact = gold.fact_booking(df.withColumn("city", F.lit("x")).withColumn("checkin_date", F.lit("d"))
                             .withColumn("checkout_date", F.lit("d")))
    kpi = {r["hotel_name"]: r["total_bookings"] for r in gold.kpi_revenue(fact).collect()}
    assert kpi == {"Hot Inn": N // 3, "Cold Inn": N - N // 3}
    p = executed(gold.kpi_revenue(fact))
    assert p.count("HashAggregate") >= 2  # partial + final around the exchange


def test_unique_check_hot_key(spark):
    df = skewed(spark)
    ev = quality.evaluate(df, [quality.unique("booking_id")])
    assert ev["results"][0]["fail_count"] == N // 3 - 1


def test_stage_metrics_hot_key(spark):
    df = skewed(spark).drop("seq")
    m = silver_metrics(df).first()
    assert m["rows_before"] == N and m["rows_after_dedup"] == N - N // 3 + 1
    assert m["duplicates_removed"] == N // 3 - 1
