import pytest
from pyspark.sql import functions as F

from lodgeflow.operators import bi, gold


def validated(spark):
    return spark.createDataFrame(
        [("B1", "H1", "Grand", "Rome", "ITALY", 1.0, 2.0, "2024-01-01", "2024-01-02", "1", "2.675"),
         ("B2", "H2", "Grand", "Rome", "ITALY", 1.5, 2.0, "2024-01-01", "2024-01-03", "2", "10"),
         ("B3", "H3", "Sea", "Nice", "FRANCE", 3.0, 4.0, "2024-01-01", "2024-01-02", "1", "bad"),
         (None, "H4", "Sea", "Paris", "FRANCE", 5.0, 6.0, "2024-01-01", "2024-01-02", "1", "1")],
        "booking_id string, hotel_id string, hotel_name string, city string, country string, "
        "latitude double, longitude double, checkin_date string, checkout_date string, nights string, "
        "total_price string")


def test_fact_dim_kpi(spark):
    v = validated(spark)
    fact = gold.fact_booking(v)
    assert dict(fact.dtypes)["total_price_eur"] == "decimal(18,2)"
    assert [r[0] for r in fact.orderBy("hotel_id").select("total_price_eur").collect()][0].__str__() == "2.68"
    assert gold.dim_city(v).count() == 4  # Rome twice: city is not unique
    kpi = {r["hotel_name"]: (str(r["total_revenue"]), r["total_bookings"])
           for r in gold.kpi_revenue(fact).collect()}
    assert kpi == {"Grand": ("12.68", 2), "Sea": ("1.00", 1)}
    assert dict(gold.kpi_revenue(fact).dtypes)["total_revenue"] == "decimal(38,2)"


def test_count_by_dimension_does_not_multiply(spark):
    v = validated(spark)
    got = {r["city"]: r["booking_count"] for r in bi.count_by_dimension(v, gold.dim_city(v)).collect()}
    assert got == {"Rome": 2, "Nice": 1}
    got = {r["city"]: r["booking_count"]
           for r in bi.count_by_dimension(v, gold.dim_city(v), keep_empty=True).collect()}
    assert got == {"Rome": 2, "Nice": 1, "Paris": 0}


def test_implicit_totals(spark):
    kpi = gold.kpi_revenue(gold.fact_booking(validated(spark)))
    r = bi.implicit_totals(kpi, {"total_revenue": "sum", "total_bookings": "sum"}).first()
    assert str(r["total_revenue"]) == "13.68" and r["total_bookings"] == 3


def test_views_and_validation(spark):
    gold.register_gold_views(spark, validated(spark))
    got = {r["view_name"]: r["probe_rows"] for r in gold.validate_gold_views(spark).collect()}
    assert got == {"fact_booking": 1, "dim_city": 1, "kpi_revenue": 1}
    spark.range(3).selectExpr("id", "raise_error('broken') AS city").createOrReplaceTempView("dim_city")
    with pytest.raises(Exception, match="broken"):
        gold.validate_gold_views(spark).collect()
    spark.catalog.dropTempView("dim_city")
    with pytest.raises(gold.GoldViewsMissing):
        gold.validate_gold_views(spark)


def test_empty_input_through_the_chain(spark, tmp_dir, bookings):
    import os
    from lodgeflow.plans.quality import validate_and_publish
    from lodgeflow.plans.silver import bronze_to_silver, silver_metrics, write_silver
    raw = bookings([])
    silver = bronze_to_silver(raw)
    assert silver.count() == 0
    m = silver_metrics(raw).first()
    assert (m["rows_before"], m["rows_after_dedup"], m["dedup_removed_pct"]) == (0, 0, None)
    write_silver(silver, os.path.join(tmp_dir, "s"))
    s = spark.read.parquet(os.path.join(tmp_dir, "s"))
    rep = validate_and_publish(spark, s, os.path.join(tmp_dir, "v"))
    assert rep["success"] and rep["evaluation_parameters"]["total_records"] == 0
    views = gold.register_gold_views(spark, spark.read.parquet(os.path.join(tmp_dir, "v")))
    assert views["kpi_revenue"].count() == 0
    got = {r["view_name"]: r["probe_rows"] for r in gold.validate_gold_views(spark).collect()}
    assert got == {"fact_booking": 0, "dim_city": 0, "kpi_revenue": 0}
    assert bi.implicit_totals(views["kpi_revenue"], {"total_revenue": "sum"}).first()["total_revenue"] is None


def test_replace_drops_and_recreates_with_new_schema(spark):
    from lodgeflow.sinks.tables import replace
    name = "replace_schema_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    replace(spark, spark.createDataFrame([(1, "a")], "id int, v string"), name)
    replace(spark, spark.createDataFrame([(2, 3.5, True)], "id int, price double, ok boolean"), name)
    t = spark.table(name)
    assert t.columns == ["id", "price", "ok"] and [tuple(r) for r in t.collect()] == [(2, 3.5, True)]
    spark.sql(f"DROP TABLE {name}")
