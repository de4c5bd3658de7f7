from pyspark.sql import functions as F

from lodgeflow.operators.cleaning import format_text, strip_special_chars
from lodgeflow.operators.dedup import dedup_by_key
from lodgeflow.operators.lookup import lookup_constant, lookup_table
from lodgeflow.operators.rules import apply_business_rules, drop_null_keys
from lodgeflow.operators.enrich import enrich
from lodgeflow.plans.silver import standardize

from conftest import booking_row


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(" a! ",)], "hotel_name string")
    out = strip_special_chars(df, ["hotel_name", "not_there"])
    assert out.columns == ["hotel_name"] and out.first()[0] == "a"


def test_standardize_examples(spark, bookings):
    df = bookings([booking_row(hotel_name=" GRAND!! hotel. ", country_customer="u.s.a.",
                               latitude="0", longitude="41.12345678", booking_date="31/12/2024"),
                   booking_row(booking_id="B2", country_customer="ATLANTIS", latitude="91", longitude="abc")])
    rows = {r["booking_id"]: r for r in standardize(df).collect()}
    b1, b2 = rows["B1"], rows["B2"]
    assert b1["hotel_name"] == "Grand Hotel"
    assert b1["country_customer"] == "USA" and b1["language_preference"] == "English"
    assert b1["latitude"] is None and b1["longitude"] == 41.123457
    assert b1["booking_date"] is None
    assert b1["phone"] == "9021255501"
    assert b1["email"] == "ada@x.com" and b1["room_type"] == "DELUXE" and b1["trip_type"] == "Leisure"
    assert b2["language_preference"] is None and b2["latitude"] is None and b2["longitude"] is None


def test_dedup_keeps_first_in_total_order(spark):
    df = spark.createDataFrame([("B1", "200"), ("B1", "100"), ("B2", None), ("B2", "5")],
                               "booking_id string, total_price string")
    got = sorted((r[0], r[1]) for r in dedup_by_key(df, "booking_id").collect())
    assert got == [("B1", "100"), ("B2", None)]


def test_dedup_explicit_order(spark):
    df = spark.createDataFrame([("B1", 1, "a"), ("B1", 2, "b")], "k string, ts int, v string")
    assert dedup_by_key(df, "k", [F.col("ts").desc()]).first()["v"] == "b"


def test_rule_bounds(spark, bookings):
    rows = [booking_row(booking_id=f"S{s}", star_rating=s) for s in ["0", "1", "5", "6"]]
    rows += [booking_row(booking_id="P0", total_price="0"), booking_row(booking_id="AN", adults=None)]
    rows += [booking_row(booking_id="NULLH", hotel_id=None)]
    out = apply_business_rules(drop_null_keys(bookings(rows)))
    assert sorted(r[0] for r in out.select("booking_id").collect()) == ["S1", "S5"]


def test_fractional_text_rules(spark, bookings):
    df = bookings([booking_row(booking_id="STAR", star_rating="5.9"),
                   booking_row(booking_id="PRICE", total_price="0.9")])
    default = sorted(r[0] for r in apply_business_rules(df).select("booking_id").collect())
    doubles = sorted(r[0] for r in apply_business_rules(df, truncate_numeric=False).select("booking_id").collect())
    assert default == ["STAR"]      # 5.9 is compared as 5, 0.9 as 0
    assert doubles == ["PRICE"]


def test_lookup_constant_missing_and_null(spark):
    df = spark.createDataFrame([("TURKEY",), ("ATLANTIS",), (None,)], "c string")
    got = [r[1] for r in lookup_constant(df, "c", "lang").collect()]
    assert got == ["Turkish", None, None]


def test_lookup_table_repeated_keys_do_not_multiply(spark):
    df = spark.createDataFrame([("A",), ("B",)], "c string")
    d = spark.createDataFrame([("A", "x"), ("A", "y")], "k string, v string")
    got = sorted(lookup_table(df, "c", d, "k", "v", "out").collect())
    assert [tuple(r) for r in got] == [("A", "x"), ("B", None)]


def test_enrich_fallbacks_and_live_rate(spark):
    df = spark.createDataFrame([("100.555",)], "total_price string")
    r = enrich(df, fallback_flag="rate_is_fallback").first()
    assert r["total_price_eur"] == 108.6 and r["ingested_temp"] == 20.0 and r["rate_is_fallback"] is True
    assert "rate_is_fallback" not in enrich(df).columns  # silver keeps the original schema
    rates = spark.createDataFrame([(1.1,)], "eur_rate double")
    weather = spark.createDataFrame([(None,)], "temperature double")
    r = enrich(df, rate_table=rates, weather_table=weather, fallback_flag="rate_is_fallback").first()
    assert r["total_price_eur"] == 110.61 and r["ingested_temp"] == 20.0 and r["rate_is_fallback"] is False


def test_format_text_lists(spark):
    df = spark.createDataFrame([("tr", " suite ", "x@Y.com ")], "country string, room_type string, email string")
    r = format_text(df).first()
    assert (r["country"], r["room_type"], r["email"]) == ("TR", "SUITE", "x@y.com")


def test_keep_language_option(spark, bookings):
    from lodgeflow.plans.silver import bronze_to_silver
    df = bookings([booking_row(booking_id="B1", language_preference="Klingon"),
                   booking_row(booking_id="B2", language_preference=None)])
    default = {r[0]: r[1] for r in bronze_to_silver(df).select("booking_id", "language_preference").collect()}
    kept = {r[0]: r[1] for r in bronze_to_silver(df, keep_language=True)
            .select("booking_id", "language_preference").collect()}
    assert default == {"B1": "Turkish", "B2": "Turkish"}  # the dictionary overwrites
    assert kept == {"B1": "Klingon", "B2": "Turkish"}


def test_lookup_table_leaves_the_strategy_to_measured_sizes(spark):
    df = spark.createDataFrame([("A",), ("B",)], "c string")
    d = spark.createDataFrame([("A", "x"), ("B", "y"), ("B", "z")], "k string, v string")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = lookup_table(df, "c", d, "k", "v", "out")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs  # no job while it is built
    assert "strategy=broadcast" not in out._jdf.queryExecution().analyzed().toString()
    assert sorted(tuple(r) for r in out.collect()) == [("A", "x"), ("B", "y")]


def test_read_scalar_takes_latest_load(spark):
    from lodgeflow.operators.enrich import read_scalar
    t = spark.createDataFrame([(1.1, "2024-01-01"), (1.2, "2024-01-02")], "eur_rate double, ingested_at string")
    assert read_scalar(t, "eur_rate", "ingested_at") == 1.2
    assert read_scalar(t, "missing") is None and read_scalar(None, "eur_rate") is None
    assert read_scalar(t.limit(0), "eur_rate") is None


def test_read_table_if_exists(spark, tmp_dir):
    from lodgeflow.sources.files import read_table_if_exists
    assert read_table_if_exists(spark, "no_such_table_here") is None
    assert read_table_if_exists(spark, tmp_dir + "/missing") is None
    spark.createDataFrame([(1,)], "a int").write.parquet(tmp_dir + "/t")
    assert read_table_if_exists(spark, tmp_dir + "/t").count() == 1
