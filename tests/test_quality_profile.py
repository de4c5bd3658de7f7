import os

import pytest
from pyspark.sql import functions as F

from lodgeflow.operators import quality as Q
from lodgeflow.operators.metrics import dedup_report, filter_report, lookup_coverage
from lodgeflow.operators.profile import null_profile
from lodgeflow.operators.rules import business_rule
from lodgeflow.plans.quality import validate_and_publish


def silver_rows(spark, rows):
    return spark.createDataFrame(rows, "booking_id string, hotel_id string, star_rating int, "
                                       "latitude double, longitude double, checkin_date date, "
                                       "checkout_date date, phone string")


def test_null_is_not_a_range_failure(spark):
    df = silver_rows(spark, [("B1", "h", None, None, None, None, None, None)])
    ev = Q.evaluate(df, Q.extended_suite(df))
    assert ev["success"] is True and ev["evaluation_parameters"]["total_records"] == 1


def test_each_check_fails_once(spark):
    import datetime as dt
    d = dt.date(2024, 1, 5)
    rows = [("B1", "h", 3, 10.0, 10.0, d, d, "123"),
            ("B1", None, 6, 95.0, 10.0, d, dt.date(2024, 1, 4), "12a")]
    df = silver_rows(spark, rows)
    ev = Q.evaluate(df, Q.extended_suite(df))
    assert {r["name"]: r["fail_count"] for r in ev["results"]} == {
        "Unique Booking ID": 1, "NotNull Hotel ID": 1, "Star Rating Range (1-5)": 1,
        "Date Logic (Checkout >= Checkin)": 1, "Phone Format (Digits Only)": 1, "Lat/Long Range Check": 1}
    assert ev["success"] is False


def test_unique_counts_null_key_once(spark):
    df = silver_rows(spark, [(None, "h", 1, 1.0, 1.0, None, None, "1")] * 3)
    ev = Q.evaluate(df, [Q.unique("booking_id")])
    assert ev["results"][0]["fail_count"] == 2


def test_phone_check_absent_column_is_zero(spark):
    df = spark.createDataFrame([("B1",)], "booking_id string")
    ev = Q.evaluate(df, [Q.matches(df, "phone")])
    assert ev["results"][0]["fail_count"] == 0


def test_empty_input_reports(spark):
    df = silver_rows(spark, [])
    rep = Q.quality_report(df, Q.blocking_suite(df)).collect()
    assert len(rep) == 4 and all(r["fail_count"] == 0 and r["success_pct"] is None for r in rep)
    assert null_profile(df).where("Missing_Percentage <> 0").count() == 0
    assert dedup_report(df, "booking_id").first()["removed_pct"] is None


def test_gate_raises_and_warns(spark, tmp_dir):
    bad = silver_rows(spark, [("B1", None, 3, 10.0, 10.0, None, None, "1")])
    with pytest.raises(Q.QualityGateError):
        validate_and_publish(spark, bad, os.path.join(tmp_dir, "v1"))
    assert not os.path.exists(os.path.join(tmp_dir, "v1"))
    with pytest.warns(UserWarning):
        rep = validate_and_publish(spark, bad, os.path.join(tmp_dir, "v2"), on_fail="warn")
    assert rep["success"] is False and not os.path.exists(os.path.join(tmp_dir, "v2"))
    good = silver_rows(spark, [("B1", "h", 3, 10.0, 10.0, None, None, "1")])
    rep = validate_and_publish(spark, good, os.path.join(tmp_dir, "v3"),
                               report_path=os.path.join(tmp_dir, "report"))
    assert rep["success"] and spark.read.parquet(os.path.join(tmp_dir, "v3")).count() == 1
    assert '"success": true' in spark.read.text(os.path.join(tmp_dir, "report")).first()[0]


def test_profile_counts_nan_for_floats_only(spark):
    df = spark.createDataFrame([(float("nan"), "NaN"), (None, None), (1.0, "x")], "d double, s string")
    got = {r["Column_Name"]: (r["Null_Count"], r["Missing_Percentage"]) for r in null_profile(df).collect()}
    assert got == {"d": (2, 66.67), "s": (1, 33.33)}


def test_stage_reports(spark):
    df = spark.createDataFrame([("B1", "h", "1", "1", "3", "1"), ("B1", "h", "1", "1", "3", "1"),
                                ("B2", None, "1", "1", "3", "1"), ("B3", "h", "0", "1", "3", "1")],
                               "booking_id string, hotel_id string, total_price string, adults string, "
                               "star_rating string, nights string")
    d = dedup_report(df, "booking_id").first()
    assert (d["rows_before"], d["rows_removed"], d["rows_after"], d["removed_pct"]) == (4, 1, 3, 25.0)
    f = filter_report(df, ["hotel_id", "booking_id"], business_rule()).first()
    assert (f["rows_before"], f["null_key_rows"], f["rule_failures"], f["rows_after"]) == (4, 1, 1, 2)
    c = lookup_coverage(df, "hotel_id").first()
    assert (c["total"], c["filled"], c["missing"], c["filled_pct"]) == (4, 3, 1, 75.0)


def test_text_columns_never_raise_under_ansi(spark):
    df = spark.createDataFrame(
        [("B1", "h", "4.5", "41.0", "12.0", "2024-01-02", "2024-01-01", "1"),
         ("B2", "h", "x", "bad", "12.0", "not a date", "2024-01-01", "2"),
         ("B3", "h", "5.9", "95", "12.0", "2024-01-05", "2024-01-01", "3")],
        "booking_id string, hotel_id string, star_rating string, latitude string, longitude string, "
        "checkout_date string, checkin_date string, phone string")
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    fails = {r["name"]: r["fail_count"] for r in Q.evaluate(df, Q.extended_suite(df))["results"]}
    assert fails["Star Rating Range (1-5)"] == 0           # 5.9 is compared as 5; 'x' is null, not a failure
    assert fails["Lat/Long Range Check"] == 1               # 95
    assert fails["Date Logic (Checkout >= Checkin)"] == 0
    doubles = {r["name"]: r["fail_count"] for r in Q.evaluate(df, Q.extended_suite(df, truncate_numeric=False))["results"]}
    assert doubles["Star Rating Range (1-5)"] == 1         # 5.9
