"""Tables and views of the catalog: streaming sink and source, upsert by SQL on
the micro-batch, gold views for other sessions, the run order run again."""

import json
import os
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodgeflow.operators import gold
from lodgeflow.operators.bi import count_by_dimension
from lodgeflow.operators.dedup import dedup_by_key
from lodgeflow.plans.gold import refresh_gold
from lodgeflow.plans.quality import read_report, validate_and_publish
from lodgeflow.plans.run_order import run_all_stages
from lodgeflow.plans.silver import run_bronze_to_silver, silver_metrics, stream_to_silver, write_silver
from lodgeflow.session import checkpoint_root
from lodgeflow.sources.files import RAW_BOOKING_SCHEMA, read_table
from lodgeflow.streaming.ingest import ingest_events, read_table_stream
from lodgeflow.streaming.upsert import LOAD_COL, insert_new_rows, read_target, run_upsert, unmatched_sql

from conftest import BOOKING_COLS, booking_row

SCHEMA = "k string, price int, ts int"


@pytest.fixture
def db(spark, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_dir}/{name}.db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def land(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def rows_of(spark, table):
    return sorted(tuple(r) for r in spark.read.table(table).drop(LOAD_COL).collect())


def test_streaming_append_to_a_named_table(spark, tmp_dir, db, monkeypatch):
    monkeypatch.chdir(tmp_dir)
    src, table = os.path.join(tmp_dir, "src"), f"{db}.raw_tbl"
    df = spark.createDataFrame([tuple(booking_row(booking_id=f"B{i}")[c] for c in BOOKING_COLS) for i in range(5)],
                               ", ".join(f"{c} string" for c in BOOKING_COLS))
    df.repartition(3).write.json(src)
    before = set(os.listdir(tmp_dir))
    ingest_events(spark, src, table, os.path.join(tmp_dir, "ck"))
    ingest_events(spark, src, table, os.path.join(tmp_dir, "ck"))  # again: nothing is added
    assert spark.catalog.tableExists(table)
    assert set(os.listdir(tmp_dir)) - before <= {"ck"}             # no folder by the table's name
    assert read_table(spark, table).count() == 5
    assert read_table(spark, f"spark_catalog.{table}").columns == RAW_BOOKING_SCHEMA.names
    df.limit(1).withColumn("booking_id", F.lit("NEW")).write.mode("append").json(src)
    ingest_events(spark, src, table, os.path.join(tmp_dir, "ck"))
    assert read_table(spark, table).count() == 6


def test_named_table_is_streamed_in_bounded_batches(spark, tmp_dir, db):
    table = f"{db}.raw_tbl"
    for i in range(6):
        spark.createDataFrame([(f"k{i}", i, i)], SCHEMA).coalesce(1).write.mode("append").saveAsTable(table)
    seen = []
    q = (read_table_stream(spark, table, max_files_per_trigger=2).writeStream
         .foreachBatch(lambda b, n: seen.append(b.count())).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [n for n in seen if n] == [2, 2, 2]


def test_rows_are_inserted_from_the_micro_batch_view(spark, tmp_dir, db):
    target, src = f"{db}.silver", os.path.join(tmp_dir, "src")
    write_silver(spark.createDataFrame([("a", 1, 0)], SCHEMA), target, keys="k")
    land(spark, [("a", 99, 1), ("b", 5, 2), ("b", 6, 1), (None, 7, 3)], src)
    land(spark, [("b", 8, 9), ("c", 3, 4)], src)
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").json(src)
    double = lambda batch: batch.withColumn("price", F.col("price") * 2)
    sql = unmatched_sql(target, "k") + " WHERE u.k IS NOT NULL"
    run_upsert(stream(), target, os.path.join(tmp_dir, "ck"), "k", double, [F.col("ts")], batch_sql=sql)
    got = rows_of(spark, target)
    assert [r[0] for r in got] == ["a", "b", "c"] and got[0] == ("a", 1, 0) and got[2] == ("c", 6, 4)
    assert got[1] in {("b", 12, 1), ("b", 16, 9)}       # whichever file came first; enriched by the transform
    run_upsert(stream(), target, os.path.join(tmp_dir, "ck2"), "k", double, [F.col("ts")], batch_sql=sql)
    assert rows_of(spark, target) == got                 # a replay inserts nothing


def test_retried_load_of_a_named_table_replaces_itself(spark, db):
    target = f"{db}.silver"
    conf = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "static")                       # the load must not depend on the session's mode
    try:
        write_silver(spark.createDataFrame([("a", 1, 0)], SCHEMA), target, keys="k")
        batch = spark.createDataFrame([("x", 1, 0), ("y", 2, 0)], SCHEMA)
        for _ in range(2):
            batch.createOrReplaceTempView("updates")
            fresh = spark.sql(unmatched_sql(target, "k"), args={"load_id": "s-1"})
            assert fresh.count() == 2                    # its own earlier attempt doesn't hide them
            insert_new_rows(fresh, target, "k", "s-1")
        assert rows_of(spark, target) == [("a", 1, 0), ("x", 1, 0), ("y", 2, 0)]
        assert spark.conf.get(conf) == "static"
    finally:
        spark.conf.set(conf, before)


def test_stream_job_enriches_each_batch_with_live_values(spark, tmp_dir, db, bookings):
    raw, silver = f"{db}.raw", f"{db}.silver"
    run_bronze_to_silver(bookings([booking_row(booking_id="B1", total_price="10")]), silver)
    bookings([booking_row(booking_id="B1", total_price="99"), booking_row(booking_id="B2", hotel_id=" h!2 "),
              booking_row(booking_id="B3", star_rating="0.9")]).write.saveAsTable(raw)
    rates = spark.createDataFrame([(2.0, "2024-01-01"), (3.0, "2024-01-02")], "eur_rate double, ingested_at string")
    weather = spark.createDataFrame([(11.5, "2024-01-01")], "temperature double, ingested_at string")
    stream_to_silver(read_table_stream(spark, raw), silver, os.path.join(tmp_dir, "ck"),
                     rate_table_loader=lambda: rates, weather_table_loader=lambda: weather,
                     batch_sql=unmatched_sql(silver, "booking_id"))
    got = {r["booking_id"]: (r["hotel_id"], r["total_price_eur"], r["ingested_temp"])
           for r in read_target(spark, silver).collect()}
    assert got == {"B1": ("H1", 10.8, 20.0), "B2": ("H2", 300.0, 11.5)}


VALIDATED = ("booking_id string, hotel_id string, hotel_name string, city string, country string, latitude double, "
             "longitude double, checkin_date string, checkout_date string, nights string, total_price string")


def test_gold_views_outlive_the_session(spark, db):
    rows = [("B1", "H1", "Grand", "Rome", "IT", 1.0, 2.0, "2024-01-01", "2024-01-02", "1", "10.005"),
            ("B2", "H1", "Grand", "Rome", "IT", 1.0, 2.0, "2024-01-01", "2024-01-02", "1", "n/a")]
    spark.createDataFrame(rows, VALIDATED).write.saveAsTable(f"{db}.validated")
    status = refresh_gold(spark, f"spark_catalog.{db}.validated")
    assert {r["view_name"].split(".")[-1]: r["probe_rows"] for r in status.collect()} == {
        "fact_booking": 1, "dim_city": 1, "kpi_revenue": 1}
    other = spark.newSession()
    assert [str(x) for x in other.table(f"{db}.kpi_revenue").first()] == ["Grand", "10.01", "2"]
    assert other.table(f"spark_catalog.{db}.kpi_revenue").count() == 1
    assert other.table(f"{db}.dim_city").count() == 1
    # the view follows its table, and defining it again is fine
    spark.createDataFrame([("B3", *rows[0][1:])], VALIDATED).write.insertInto(f"{db}.validated")
    gold.create_gold_views(spark, f"{db}.validated", db)
    other = spark.newSession()  # an open session keeps the file list that it has read
    assert [str(x) for x in other.table(f"{db}.kpi_revenue").first()] == ["Grand", "20.02", "3"]
    assert dict(other.table(f"{db}.kpi_revenue").dtypes) == {
        "hotel_name": "string", "total_revenue": "decimal(38,2)", "total_bookings": "bigint"}
    with pytest.raises(gold.GoldViewsMissing):
        gold.validate_gold_views(spark, [f"{db}.fact_booking", f"{db}.no_such_view"])
    with pytest.raises(AnalysisException):
        gold.create_gold_views(spark, f"{db}.no_such_table", db)


CSV = """booking_id,hotel_id,hotel_name,city,country,latitude,longitude,total_price,adults,star_rating,nights,country_customer,checkin_date,checkout_date
B1,h1,grand hotel,rome,italy,41.9,12.5,100.5,2,4,2,ITALY,2024-01-01,2024-01-03
B2,h2,sea view,nice,france,43.7,7.2,50,1,5,1,FRANCE,2024-02-01,2024-02-02
"""


@pytest.mark.parametrize("named", [True, False])
def test_run_order_keeps_streamed_rows_when_run_again(spark, tmp_dir, db, bookings, named):
    csv, events, root = (os.path.join(tmp_dir, x) for x in ("batch", "events", "root"))
    os.makedirs(csv)
    with open(os.path.join(csv, "b.csv"), "w") as f:
        f.write(CSV)
    with open(os.path.join(tmp_dir, "w.json"), "w") as f:
        f.write(json.dumps({"current_weather": {"temperature": 17.5}}) + "\n")
    stream = [booking_row(booking_id="B2", hotel_name="stream copy"), booking_row(booking_id="S1", hotel_name="new one")]
    bookings(stream).write.json(events)
    where = (lambda t: f"{db}.{t}") if named else (lambda t: os.path.join(root, t))

    def run(events_path):
        run_all_stages(spark, csv, os.path.join(tmp_dir, "w.json"), None, events_path, root, db if named else None,
                       max_files_per_trigger=1).collect()
        rows = read_table(spark, where("silver_hotel_bookings_validated")).collect()
        return {r["booking_id"]: (r["hotel_name"], r["ingested_temp"]) for r in rows}

    want = {"B1": ("Grand Hotel", 17.5), "B2": ("Sea View", 17.5), "S1": ("New One", 17.5)}
    assert run(events) == want
    assert run(events) == want
    bookings([booking_row(booking_id="S2", hotel_name="later one")]).write.mode("append").json(events)
    assert run(events) == want | {"S2": ("Later One", 17.5)}
    assert run(None) == want | {"S2": ("Later One", 17.5)}  # no new events: the raw stream table is still read
    assert read_table(spark, where("hotel_raw_stream")).count() == 3
    if named:
        assert spark.newSession().table(f"{db}.kpi_revenue").count() == 4


def test_report_is_written_and_read_back(spark, tmp_dir):
    df = spark.createDataFrame([("B1", None, "9", 95.0, 0.0), ("B1", "h", "5.9", 1.0, 1.0)],
                               "booking_id string, hotel_id string, star_rating string, latitude double, longitude double")
    path = os.path.join(tmp_dir, "report")
    with pytest.warns(UserWarning, match="QUALITY FAILED"):
        written = validate_and_publish(spark, df, os.path.join(tmp_dir, "out"), on_fail="warn", report_path=path)
    assert not os.path.exists(os.path.join(tmp_dir, "out"))
    read = read_report(spark, path).collect()
    assert [(r["check_name"], r["fail_count"]) for r in read] == [(x["name"], x["fail_count"]) for x in written["results"]]
    assert [r["fail_count"] for r in read] == [1, 1, 1, 1] and not any(r["success"] for r in read)
    assert {r["total_records"] for r in read} == {2}


def test_unknown_cities_on_request(spark):
    fact = spark.createDataFrame([("Rome", 1), ("Rome", None), ("Oslo", 2), (None, 3), ("Nice", None)],
                                 "city string, booking_id int")
    dim = spark.createDataFrame([("Rome",), ("Rome",), ("Nice",), (None,)], "city string")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(count_by_dimension(fact, dim)) == [("Rome", 1)]
    assert rows(count_by_dimension(fact, dim, unknown=True)) == [("Rome", 1), (None, 2)]
    assert rows(count_by_dimension(fact, dim, keep_empty=True, unknown=True)) == [("Nice", 0), ("Rome", 1), (None, 2)]


def test_silver_metrics_plan_and_numbers(spark, bookings):
    raw = bookings([booking_row(booking_id="B1"), booking_row(booking_id="B1", hotel_name="x"),
                    booking_row(booking_id="B2", hotel_id=None), booking_row(booking_id="B3", nights="0.9")])
    report = silver_metrics(raw)
    assert report.first().asDict() == {
        "rows_before": 4, "duplicates_removed": 1, "rows_after_dedup": 3, "dedup_removed_pct": 25.0, "null_key_rows": 1,
        "rule_failures": 1, "rows_after_filter": 1, "filter_loss_pct": 66.67}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan and "CartesianProduct" not in plan
    assert silver_metrics(raw.limit(0)).first()["rows_before"] == 0


def test_dedup_orders_by_map_columns_too(spark):
    rows = [("a", {"x": 2}), ("a", {"x": 1, "y": 0}), ("a", {"y": 5, "x": 1})]
    df = spark.createDataFrame(rows, "k string, m map<string,int>")
    assert dedup_by_key(df, "k").first()["m"] == {"x": 1, "y": 0}


def test_no_private_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda k, d=None: d)})())

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        checkpoint_root(Session())
