import json
import os

from pyspark.sql import functions as F

from lodgeflow.plans.run_order import run_all_stages
from lodgeflow.sources.files import CSV_OPTIONS, read_csv
from lodgeflow.streaming.ingest import dedup_within_watermark, read_table_stream

from conftest import BOOKING_COLS, booking_row

CSV = '''booking_id,hotel_id,hotel_name,city,country,latitude,longitude,total_price,adults,star_rating,nights,country_customer,phone,checkin_date,checkout_date,hotel_description
B1,h1, "grand hotel" ,rome,italy,41.9,12.5,100.555,2,4,2,ITALY,+39 (06) 1,2024-01-01,2024-01-03,"big, ""nice""
hotel"
B1,h1,zz dup,rome,italy,41.9,12.5,1,2,4,2,ITALY,1,2024-01-01,2024-01-03,
B2,h2,sea view,nice,france,43.7,7.2,50,1,5,1,FRANCE,2,2024-02-01,2024-02-02,
B3,h3,bad star,nice,france,43.7,7.2,50,1,6,1,FRANCE,3,2024-02-01,2024-02-02,
'''


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_reader_semantics(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in", "b.csv")
    write(p, CSV)
    rows = {r["hotel_name"]: r for r in read_csv(spark, p).collect()}
    assert set(rows) == {"grand hotel", "zz dup", "sea view", "bad star"}
    assert rows["grand hotel"]["hotel_description"] == 'big, "nice"\nhotel'
    assert rows["zz dup"]["hotel_description"] is None
    assert all(t == "string" for _, t in read_csv(spark, p).dtypes)
    assert CSV_OPTIONS["multiLine"] == "true"


def test_whole_run(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "landing", "batch", "b.csv")
    write(csv, CSV)
    weather = os.path.join(tmp_dir, "landing", "weather", "w.json")
    write(weather, json.dumps({"current_weather": {"time": "2024-01-01T10:00", "temperature": 17.5}}) + "\n")
    currency = os.path.join(tmp_dir, "landing", "currency", "c.json")
    write(currency, json.dumps({"base": "EUR", "date": "2024-01-01", "rates": {"USD": 1.1, "TRY": 35.0}}) + "\n")
    events = os.path.join(tmp_dir, "landing", "events")
    rows = [booking_row(booking_id="B2", hotel_name="stream copy"),   # key exists: ignored
            booking_row(booking_id="B9", hotel_name="new one", total_price="10")]
    spark.createDataFrame([tuple(r[c] for c in BOOKING_COLS) for r in rows],
                          ", ".join(f"{c} string" for c in BOOKING_COLS)).write.json(events)
    root = os.path.join(tmp_dir, "lake")
    status = run_all_stages(spark, csv, weather, currency, events, root)
    assert {r["view_name"] for r in status.collect()} == {"fact_booking", "dim_city", "kpi_revenue"}
    silver = spark.read.parquet(os.path.join(root, "silver_hotel_bookings_validated"))
    got = {r["booking_id"]: r for r in silver.collect()}
    assert set(got) == {"B1", "B2", "B9"}
    assert got["B1"]["hotel_name"] == "Grand Hotel" and got["B1"]["total_price_eur"] == 108.6
    assert got["B1"]["ingested_temp"] == 17.5           # weather read, rate column absent -> 1.08
    assert got["B2"]["hotel_name"] == "Sea View"        # batch row kept, stream copy ignored
    assert got["B9"]["hotel_name"] == "New One"
    kpi = {r["hotel_name"]: r["total_bookings"] for r in spark.table("kpi_revenue").collect()}
    assert kpi == {"Grand Hotel": 1, "Sea View": 1, "New One": 1}
    cur = spark.read.parquet(os.path.join(root, "raw_currency_api")).first()
    assert (cur["base_currency"], cur["usd_rate"], cur["gbp_rate"], cur["update_date"]) == ("EUR", 1.1, None, "2024-01-01")


def test_table_stream_and_watermark_dedup(spark, tmp_dir):
    src = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:00:01")],
                          "k int, ts string").select("k", F.col("ts").cast("timestamp_ntz").alias("ts")) \
        .write.parquet(src)
    s = dedup_within_watermark(read_table_stream(spark, src), "k", "ts", "1 hour")
    q = s.writeStream.format("memory").queryName("wm_dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.table("wm_dedup").collect()) == [1, 2]


def test_command_line(spark, tmp_dir, capsys):
    from lodgeflow.__main__ import main
    t = os.path.join(tmp_dir, "silver")
    spark.createDataFrame([("B1", "h", "4", 41.0, 12.0), ("B1", None, "9", 95.0, 12.0)],
                          "booking_id string, hotel_id string, star_rating string, latitude double, "
                          "longitude double").write.parquet(t)
    assert main(["quality", "--table", t], spark=spark) == 0
    rows = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    fails = {r["check_name"]: r["fail_count"] for r in rows}
    assert fails == {"Unique Booking ID": 1, "NotNull Hotel ID": 1, "Star Rating Range (1-5)": 1,
                     "Lat/Long Range Check": 1}
    assert main(["profile", "--table", t], spark=spark) == 0
    prof = {r["Column_Name"]: r["Null_Count"] for r in map(json.loads, capsys.readouterr().out.splitlines())}
    assert prof["hotel_id"] == 1 and prof["booking_id"] == 0


def test_csv_split_options(spark, tmp_dir):
    from lodgeflow.sources.files import read_csv
    p = os.path.join(tmp_dir, "flat")
    spark.range(0, 50_000).selectExpr("cast(id as string) as booking_id", "'x, y' as note") \
        .coalesce(1).write.option("header", "true").csv(p)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        multi = read_csv(spark, p)
        flat = read_csv(spark, p, multi_line=False)
        spread = read_csv(spark, p, spread_to=4)
        assert multi.rdd.getNumPartitions() == 1        # one file, not splittable
        assert flat.rdd.getNumPartitions() > 1          # split into blocks
        assert spread.rdd.getNumPartitions() == 4
        for df in (multi, flat, spread):
            assert df.count() == 50_000 and df.where("note = 'x, y'").count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_command_line_gold(spark, tmp_dir, capsys):
    from lodgeflow.__main__ import main
    t = os.path.join(tmp_dir, "validated")
    spark.createDataFrame([("B1", "H1", "Grand", "Rome", "IT", 1.0, 2.0, "2024-01-01", "2024-01-02", "1", "10")],
                          "booking_id string, hotel_id string, hotel_name string, city string, country string, "
                          "latitude double, longitude double, checkin_date string, checkout_date string, "
                          "nights string, total_price string").write.parquet(t)
    assert main(["gold", "--table", t], spark=spark) == 0
    rows = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert {r["view_name"]: r["probe_rows"] for r in rows} == {"fact_booking": 1, "dim_city": 1, "kpi_revenue": 1}
