"""Registered queries over the driver's test tables.

Each query maps the booking roles onto the TPC-H-like tables (booking ->
``orders``/``lineitem``, hotel -> ``part``, city/country -> ``nation``,
customer -> ``customer``, stream -> ``events``, free text -> ``documents``) and
runs the library operators on the whole tables.  Bad text and nulls, which
the test tables lack, are injected by fixed rules that the SQL oracles repeat.
Every callable takes ``(spark, sf_dir)`` and returns a DataFrame.
"""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow import constants as K
from lodgeflow.operators import bi, gold, quality
from lodgeflow.operators.cleaning import (clean_coordinates, format_text, keep_digits, parse_dates,
                                          strip_special_chars)
from lodgeflow.operators.dedup import dedup_any, dedup_by_key
from lodgeflow.operators.enrich import enrich
from lodgeflow.operators.lookup import lookup_constant, lookup_table
from lodgeflow.operators.metrics import dedup_report, filter_report, ingest_summary, lookup_coverage
from lodgeflow.operators.profile import null_profile
from lodgeflow.operators.rules import apply_business_rules, business_rule, drop_null_keys
from lodgeflow.operators.topk import latest, sample_rows
from lodgeflow.operators.quality import QualityGateError
from lodgeflow.plans.quality import read_report, validate_and_publish
from lodgeflow.plans.run_order import run_all_stages
from lodgeflow.plans.silver import (bronze_to_silver, filter_valid, run_bronze_to_silver, silver_metrics, standardize,
                                    stream_to_silver, write_silver)
from lodgeflow.session import drop_shuffles, shared_database, shared_dir, small_methods
from lodgeflow.sinks.tables import overwrite
from lodgeflow.sources.api import (CURRENCY_SCHEMA, WEATHER_SCHEMA, currency_rows, read_payloads,
                                   weather_rows)
from lodgeflow.functions import percent
from lodgeflow.sources.files import add_load_metadata, read_csv, read_path_if_exists, read_table
from lodgeflow.streaming.ingest import JSON_TIMESTAMP_OPTIONS, ingest_events, read_event_stream, read_table_stream
from lodgeflow.streaming.upsert import LOAD_COL, run_upsert, unmatched_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- role mapping

def lineitem_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (all-text) bookings from line items, hotel = part: one per order
    (``booking_id`` = order key), the order's first line in the total order.

    De-duplication runs on the typed scan (key ``l_orderkey``, every other
    column as the total order), i.e. on the keys as read.
    """
    li = dedup_by_key(table(spark, sf_dir, "lineitem"), "l_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    j = li.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")
    ship = F.col("l_shipdate").cast("date")
    return j.select(
        F.col("l_orderkey").cast("string").alias("booking_id"),
        F.col("l_partkey").cast("string").alias("hotel_id"),
        F.col("p_name").alias("hotel_name"),
        F.col("p_brand").alias("city"),
        F.col("l_returnflag").alias("country"),
        F.col("l_quantity").cast("string").alias("latitude"),
        (F.col("l_extendedprice") / 1000).cast("string").alias("longitude"),
        ship.cast("string").alias("checkin_date"),
        F.date_add(ship, F.col("l_linenumber")).cast("string").alias("checkout_date"),
        F.col("l_linenumber").cast("string").alias("star_rating"),
        F.round(F.col("l_discount") * 100).cast("long").cast("string").alias("nights"),
        (F.col("l_quantity").cast("long") - 3).cast("string").alias("adults"),
        F.col("l_extendedprice").cast("string").alias("total_price"))


def lineitem_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_valid(standardize(lineitem_bookings(spark, sf_dir)))


def order_bookings(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Raw (all-text) bookings: one per order, customer and nation joined.

    ``parts`` deals them by ``booking_id`` to as many partitions, before the
    text is made, so that the narrow columns of the tables are shuffled."""
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    cn = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    j = orders.join(cn, F.col("o_custkey") == F.col("c_custkey"), "inner")
    okey = F.col("o_orderkey")
    s = lambda c: F.col(c).cast("string")
    if parts:
        j = j.repartition(parts, s("o_orderkey"))
    return j.select(
        s("o_orderkey").alias("booking_id"),
        F.when(okey % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" h-"), (F.col("o_custkey") % 100).cast("string"), F.lit("!")))
         .alias("hotel_id"),
        F.concat(F.col("c_mktsegment"), F.lit(".")).alias("hotel_name"),
        F.col("n_name").alias("country"),
        F.concat(F.lower("n_name"), F.lit(", "), F.col("c_mktsegment")).alias("city"),
        F.col("c_name").alias("full_name"),
        F.lower("c_mktsegment").alias("city_customer"),
        F.col("n_name").alias("country_customer"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" (hq)")).alias("address"),
        F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(" ")).alias("room_type"),
        F.concat(F.lit("+90 ("), s("c_nationkey"), F.lit(") "), s("c_custkey")).alias("phone"),
        s("c_acctbal").alias("latitude"),
        (F.col("o_totalprice") / 1000).cast("string").alias("longitude"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Mail.COM ")).alias("email"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("trip_type"),
        F.when(okey % 23 == 0, F.lit("31/12/2024"))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("booking_date"),
        s("o_totalprice").alias("total_price"),
        (F.col("o_custkey") % 4).cast("string").alias("adults"),
        (F.col("n_nationkey") % 7).cast("string").alias("star_rating"),
        (F.length("o_orderpriority") - 5).cast("string").alias("nights"))


#: Star ratings as text that a comparison with whole numbers reads in its own
#: way, by the remainder of the key: cut off, with an exponent, padded, no number.
TEXT_STARS = {0: "x", 1: "0.9", 2: "5.9", 3: "4.5", 4: "1e1", 5: " 3 ", 6: "", 7: "6.0"}


def text_star(key, plain):
    out = F
    for k, v in TEXT_STARS.items():
        out = out.when(key % 19 == k, F.lit(v))
    return out.otherwise(plain)


def dirty_bookings(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """``order_bookings`` with such star ratings, and prices below 1."""
    raw, key = order_bookings(spark, sf_dir, parts), F.col("booking_id").cast("long")
    return raw.withColumns({"star_rating": text_star(key, F.col("star_rating")),
                            "total_price": F.when(key % 31 == 0, F.lit("0.99")).otherwise(F.col("total_price"))})


def live_values(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rate and weather tables with a row per event; the newest row counts."""
    e = _events(spark, sf_dir)
    return (e.select((F.col("value") / 100).alias("eur_rate"), F.col("ts").alias("ingested_at")),
            e.select((F.col("value") - 5).alias("temperature"), F.col("ts").alias("ingested_at")))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# ---------------------------------------------------------------- sources

def q_bronze_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land ``part`` as CSV (quoted multi-line field, padding, empty field),
    read it back as text with the header, add load metadata, overwrite the raw
    table, return it (load time left out)."""
    base = shared_dir(spark, "bronze_csv")
    part = table(spark, sf_dir, "part")
    landed = part.select(
        "p_partkey", "p_name", "p_brand",
        F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")).alias("p_type"),
        "p_size", "p_retailprice",
        F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"\n'), F.col("p_type")).alias("p_notes"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("p_type_opt"))
    (landed.write.mode("overwrite").option("header", "true").option("quote", '"')
     .option("escape", '"').csv(f"{base}/landing"))
    overwrite(add_load_metadata(read_csv(spark, f"{base}/landing")), f"{base}/hotel_raw_batch")
    return spark.read.parquet(f"{base}/hotel_raw_batch").drop("ingestion_timestamp")


def _land_payloads(spark: SparkSession, sf_dir: str, name: str, body) -> str:
    path = f"{shared_dir(spark, name)}/landing"
    _events(spark, sf_dir).select(F.to_json(body).alias("value")).write.mode("overwrite").text(path)
    return path


def q_bronze_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currency-style payloads (``{"base","date","rates":{...}}``) with the rates
    of the six currencies, built from each event's value; each event lacks some
    of them, which are null then, and has one that nobody asks for."""
    key = F.col("event_id")
    pair = lambda code, rate: F.struct(F.lit(code).alias("code"), rate.alias("rate"))
    rates = [F.when(key % (i + 2) != 0, pair(code, F.col("value") * (i + 1)))
             for i, code in enumerate(K.CURRENCY_CODES)]
    rates = F.map_from_entries(F.array_compact(F.array(*rates, pair("ZZZ", F.col("value")))))
    body = F.struct(F.lit("EUR").alias("base"), F.col("ts").cast("date").cast("string").alias("date"),
                    rates.alias("rates"))
    path = _land_payloads(spark, sf_dir, "currency_payloads", body)
    return currency_rows(read_payloads(spark, path, CURRENCY_SCHEMA)).drop("ingested_at")


def q_bronze_json_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-style payloads (``{"current_weather": {...}}``) from events;
    the nested object becomes the row."""
    body = F.struct(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("value").alias("temperature"),
        F.col("user_id").alias("weathercode")).alias("current_weather"))
    path = _land_payloads(spark, sf_dir, "weather_payloads", body)
    return weather_rows(read_payloads(spark, path, WEATHER_SCHEMA)).drop("ingested_at")


def q_bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land events as JSON files, stream them (explicit schema, available-now
    trigger, checkpoint) into a raw parquet table, return the table."""
    base = shared_dir(spark, "bronze_stream")
    events = _events(spark, sf_dir)
    events.repartition(8).write.mode("overwrite").options(**JSON_TIMESTAMP_OPTIONS).json(f"{base}/landing")
    ingest_events(spark, f"{base}/landing", f"{base}/hotel_raw_stream", f"{base}/_ckpt",
                  schema=events.schema, max_files_per_trigger=3)
    return spark.read.parquet(f"{base}/hotel_raw_stream")


# ---------------------------------------------------------------- profile, cleaning

def q_profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    injected = o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 11 == 0, F.lit(float("nan"))).when(k % 13 == 0, F.lit(None))
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"))
    return null_profile(injected)


def q_dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_key(table(spark, sf_dir, "lineitem"), "l_orderkey")


def q_dedup_any_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arbitrary survivor per key: the surviving rows differ run to run, the
    keys and their count do not.  Each survivor is looked up among the input's
    rows by all its columns, so one put together from several rows is missed."""
    li = table(spark, sf_dir, "lineitem")
    kept = dedup_any(li, "l_orderkey")
    return kept.join(li.distinct(), li.columns, "left_semi").select("l_orderkey")


def q_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "lineitem"), "l_orderkey")


_PASSTHROUGH = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


def _lineitem_rule_frame(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Line items as text booking fields for the key and rule filters: every
    17th order has no hotel id, star ratings are partly text that is compared in
    its own way, nights are fractions."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(*(keep or []), *_rule_fields(k))


def _rule_fields(k) -> list:
    return [k.cast("string").alias("booking_id"),
            F.when(k % 17 != 0, F.col("l_partkey").cast("string")).alias("hotel_id"),
            F.col("l_extendedprice").cast("string").alias("total_price"),
            (F.col("l_quantity") - 5).cast("string").alias("adults"),
            text_star(k, F.col("l_linenumber").cast("string")).alias("star_rating"),
            (F.round(F.col("l_discount") * 100) / 4).cast("string").alias("nights")]


def q_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_report(_lineitem_rule_frame(spark, sf_dir), ["hotel_id", "booking_id"], business_rule())


def q_clean_special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    # "hotel_name" is absent: listed columns that do not exist are skipped
    return strip_special_chars(docs, ["text", "lang", "source", "hotel_name"])


def q_digits_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    df = c.select("c_custkey", F.col("c_name").alias("phone"),
                  F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit(" ("),
                           F.col("c_custkey").cast("string"), F.lit(") 555-01")).alias("phone2"))
    return keep_digits(df, ["phone", "phone2"])


def q_geo_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    k = F.col("event_id")
    text = (F.when(k % 7 == 0, F.lit("bad")).when(k % 11 == 0, F.lit("0"))
            .otherwise(F.col("value").cast("string")))
    df = e.select("event_id", text.alias("latitude"),
                  (F.col("value") - 245).cast("string").alias("longitude"))
    return clean_coordinates(df)


def q_format_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    df = p.select("p_partkey",
                  F.col("p_brand").alias("hotel_id"),
                  F.col("p_name").alias("hotel_name"),
                  F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")).alias("room_type"),
                  F.concat(F.lit(" "), F.lower("p_type")).alias("trip_type"),
                  F.concat(F.lit(" "), F.col("p_brand"), F.lit("@Example.COM ")).alias("email"),
                  F.upper("p_name").alias("city"))
    return format_text(df)


SEGMENT_GROUPS = {"HOUSEHOLD": "Home", "MACHINERY": "Industry", "AUTOMOBILE": "Industry"}


def q_dictionary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    out = lookup_constant(c, "c_mktsegment", "segment_group", SEGMENT_GROUPS)
    out = lookup_table(out, "c_nationkey", nation, "n_nationkey", "n_name", "nation_name")
    out = lookup_constant(out.withColumn("country_customer", F.upper("nation_name")),
                          "country_customer", "language_preference")
    return out.drop("country_customer")


def q_lookup_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return lookup_coverage(lookup_constant(c, "c_mktsegment", "segment_group", SEGMENT_GROUPS),
                           "segment_group")


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    df = o.select("o_orderkey",
                  F.when(k % 13 == 0, F.lit("31/12/2024")).when(k % 17 == 0, F.lit("n/a"))
                   .otherwise(d.cast("string")).alias("booking_date"),
                  F.when(k % 5 == 0, F.lit("")).otherwise(F.date_sub(d, 9000).cast("string")).alias("birth_date"),
                  F.date_add(d, 3).cast("string").alias("stay_date"))
    return parse_dates(df)


def q_logical_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_business_rules(drop_null_keys(_lineitem_rule_frame(spark, sf_dir, _PASSTHROUGH)))
    return out.select(*_PASSTHROUGH, "booking_id", "hotel_id", "star_rating")


def q_enrich_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate table without an ``eur_rate`` column (fallback 1.08); weather
    table = latest event value as temperature."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("total_price"))
    e = _events(spark, sf_dir)
    rates = e.select(F.col("value").alias("usd_rate"), F.col("ts").alias("ingested_at"))
    weather = e.select(F.col("value").alias("temperature"), F.col("ts").alias("ingested_at"))
    out = enrich(o, rate_table=rates, weather_table=weather, processed_at=None,
                 fallback_flag="rate_is_fallback")
    return out.drop("total_price")


def q_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplication and filter-loss report of the line-item bookings, one
    aggregate over the raw scan."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    k = F.col("l_orderkey")

    def to_booking(s: DataFrame) -> DataFrame:
        return s.select(*_rule_fields(k))

    return silver_metrics(li, key="l_orderkey", to_booking=to_booking)


def q_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_summary(add_load_metadata(table(spark, sf_dir, "part")), K.BATCH_SOURCE_NAME)


# ---------------------------------------------------------------- silver

def q_silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "silver_batch")
    silver = bronze_to_silver(order_bookings(spark, sf_dir))
    write_silver(silver, f"{base}/silver_hotel_bookings")
    return spark.read.parquet(f"{base}/silver_hotel_bookings").drop("silver_processed_at", LOAD_COL)


def q_silver_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed the target with the first half of the month (batch), then stream
    every event through the insert-only upsert keyed on (user, day): keys
    already present stay as they are (the seed's values differ from the
    stream's by 1000, so an overwritten row would show), new keys are inserted
    once."""
    base = shared_dir(spark, "silver_stream")
    target = f"{base}/silver_events"
    e = _events(spark, sf_dir).withColumn("day", F.col("ts").cast("date").cast("string"))
    keys, order = ["user_id", "day"], [F.col("ts").asc(), F.col("event_id").asc()]
    seed = dedup_by_key(e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")), keys, order)
    write_silver(seed.withColumn("value", F.col("value") + 1000), target, keys=keys)
    # one file per day, so every key's rows arrive in one micro-batch
    e.repartition("day").write.mode("overwrite").options(**JSON_TIMESTAMP_OPTIONS).json(f"{base}/landing")
    stream = read_event_stream(spark, f"{base}/landing", e.schema, max_files_per_trigger=4)
    run_upsert(stream, target, f"{base}/_ckpt", keys, order_by=order)
    return spark.read.parquet(target).drop(LOAD_COL)


def q_stream_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream job on tables of the catalog: JSON events (each twice, dirty
    text) are appended to a raw table, streamed from it through the clean-up
    chain and the rules, enriched with a live rate and temperature, and inserted
    from the micro-batch's view by SQL where their key is new.  Silver already
    holds the batch job's rows of one order status, with the fallback values."""
    db, base = shared_database(spark, "stream_job"), shared_dir(spark, "stream_job")
    raw = dirty_bookings(spark, sf_dir)
    silver, stream = f"{db}.silver_hotel_bookings", f"{db}.hotel_raw_stream"
    run_bronze_to_silver(raw.where(F.trim("room_type") == "F"), silver)
    rates, weather = live_values(spark, sf_dir)
    overwrite(rates, f"{db}.raw_currency_api")
    overwrite(weather, f"{db}.raw_weather_api")
    with small_methods(spark), drop_shuffles(spark):
        for half in ("a", "b"):
            # most of the job's disk: as plain text six times the bytes
            dirty_bookings(spark, sf_dir, parts=4).write.option("compression", "lz4").json(f"{base}/landing/{half}")
    ingest_events(spark, f"{base}/landing/*", stream, f"{base}/_ckpt_raw", schema=raw.schema, max_files_per_trigger=3)
    stream_to_silver(read_table_stream(spark, stream, max_files_per_trigger=3), silver, f"{base}/_ckpt",
                     rate_table_loader=lambda: spark.read.table(f"{db}.raw_currency_api"),
                     weather_table_loader=lambda: spark.read.table(f"{db}.raw_weather_api"),
                     batch_sql=unmatched_sql(silver, "booking_id"))
    return spark.read.table(silver).drop("silver_processed_at", LOAD_COL)


def q_run_order_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on tables of the catalog, from CSV files to the gold
    views, and once more over the same landing folders.  Orders of status P
    come by the stream only; another session reads the revenue view."""
    db, base = shared_database(spark, "run_order"), shared_dir(spark, "run_order")
    raw = dirty_bookings(spark, sf_dir).withColumns({"checkin_date": F.col("booking_date"),
                                                     "checkout_date": F.col("booking_date")})
    with small_methods(spark):
        raw.where(F.trim("room_type") != "P").write.option("header", "true").option("escape", '"').csv(f"{base}/batch")
        raw.write.json(f"{base}/events")
    e = _events(spark, sf_dir).agg(F.max_by("value", "ts").alias("value"))
    e.select(F.struct(F.col("value").alias("temperature")).alias("current_weather")).write.json(f"{base}/weather")
    e.select(F.lit("EUR").alias("base"), F.create_map(F.lit("USD"), F.col("value")).alias("rates")).write.json(
        f"{base}/currency")
    for _ in range(2):
        run_all_stages(spark, f"{base}/batch", f"{base}/weather", f"{base}/currency", f"{base}/events",
                       f"{base}/root", database=db)
    return spark.newSession().table(f"{db}.{K.GOLD_KPI_VIEW}")


def q_silver_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job that writes silver and reports on itself: its numbers, a
    row each, and the rows that are in the table."""
    path = f"{shared_dir(spark, 'silver_metrics')}/silver"
    raw = dirty_bookings(spark, sf_dir)
    rates, weather = live_values(spark, sf_dir)
    report = run_bronze_to_silver(raw.unionByName(raw), path, rate_table=rates, weather_table=weather)
    numbers = [(f"{part}.{name}", float(v)) for part, own in report.items() for name, v in own.items()]
    return spark.createDataFrame(numbers, "metric string, value double").unionByName(
        spark.read.parquet(path).select(F.lit("written.rows").alias("metric"), F.lit(1.0).alias("value"))
        .groupBy("metric").agg(F.sum("value").alias("value")))


def q_percent_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of segments in blocks of 32 customers: odd counts of 32 lie
    half-way between two hundredths."""
    c = table(spark, sf_dir, "customer").withColumn("block", F.floor(F.col("c_custkey") / 32))
    counts = c.groupBy("block", "c_mktsegment").agg(F.count("*").alias("part"))
    totals = c.groupBy("block").agg(F.count("*").alias("total"))
    return counts.join(totals, "block").select("block", "c_mktsegment", "part", "total",
                                               percent("part", "total").alias("share_pct"))


# ---------------------------------------------------------------- quality

def _quality_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate").cast("date")
    return li.select(
        F.col("l_orderkey").alias("booking_id"), F.col("l_partkey").alias("hotel_id"),
        F.col("l_linenumber").alias("star_rating"),
        ship.alias("checkin_date"), F.date_add(ship, F.col("l_linenumber") - 3).alias("checkout_date"),
        F.col("l_returnflag").alias("phone"),
        (F.col("l_quantity") - 45).alias("latitude"), (F.col("l_extendedprice") / 100).alias("longitude"))


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _quality_frame(spark, sf_dir)
    return quality.quality_report(df, quality.extended_suite(df))


def q_quality_blocking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four blocking checks on customers seen as bookings."""
    c = table(spark, sf_dir, "customer")
    df = c.select(F.col("c_custkey").alias("booking_id"),
                  F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("hotel_id"),
                  (F.col("c_nationkey") % 7).alias("star_rating"),
                  (F.col("c_acctbal") / 100).alias("latitude"), (F.col("c_acctbal") / 50).alias("longitude"))
    return quality.quality_report(df, quality.blocking_suite(df))


def q_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking suite on the orders; they pass, so they are published."""
    base = shared_dir(spark, "quality_gate")
    o = table(spark, sf_dir, "orders")
    silver = o.withColumns({
        "booking_id": F.col("o_orderkey"), "hotel_id": F.col("o_custkey"),
        "star_rating": F.length("o_orderstatus"),
        "latitude": F.col("o_totalprice") / 10000, "longitude": F.col("o_totalprice") / 10000})
    validate_and_publish(spark, silver, f"{base}/validated", report_path=f"{base}/report")
    return spark.read.parquet(f"{base}/validated")


def q_quality_text_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocking suite over text: star ratings and coordinates compared
    with whole bounds."""
    df = _lineitem_rule_frame(spark, sf_dir, ["l_quantity", "l_extendedprice"]).select(
        "booking_id", "hotel_id", "star_rating", (F.col("l_quantity") * 1.85).cast("string").alias("latitude"),
        (F.col("l_extendedprice") / 250).cast("string").alias("longitude"))
    return quality.quality_report(df, quality.blocking_suite(df))


def q_quality_gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate does with customers that fail: each way of reporting (raise
    and warn), and orders that pass; the JSON reports are read back, and the
    published tables are looked for."""
    base = shared_dir(spark, "quality_outcomes")
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    failing = c.select((F.col("c_custkey") % 1000).alias("booking_id"),
                       F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("hotel_id"),
                       (F.col("c_nationkey") % 7).cast("string").alias("star_rating"),
                       (F.col("c_acctbal") / 100).alias("latitude"), (F.col("c_acctbal") / 50).alias("longitude"))
    passing = o.select(F.col("o_orderkey").alias("booking_id"), F.col("o_custkey").alias("hotel_id"),
                       F.lit("4.5").alias("star_rating"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
    out = None
    for name, df, on_fail in (("raise", failing, "raise"), ("warn", failing, "warn"), ("pass", passing, "raise")):
        raised = False
        with warnings.catch_warnings(record=True) as warned:
            warnings.simplefilter("always")
            try:
                validate_and_publish(spark, df, f"{base}/{name}/table", on_fail=on_fail,
                                     report_path=f"{base}/{name}/report")
            except QualityGateError:
                raised = True
        published = read_path_if_exists(spark, f"{base}/{name}/table")
        rows = 0 if published is None else published.count()
        own = read_report(spark, f"{base}/{name}/report").select(
            F.lit(name).alias("run"), "check_name", "fail_count", "total_records", "success",
            F.lit(raised).alias("raised"),
            F.lit(any("QUALITY FAILED" in str(w.message) for w in warned)).alias("warned"),
            F.lit(rows).cast("long").alias("published_rows"))
        out = own if out is None else out.unionByName(own)
    return out


# ---------------------------------------------------------------- gold and BI

def q_gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_booking(lineitem_silver(spark, sf_dir))


def q_gold_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    v = j.select(F.initcap(F.lower("c_mktsegment")).alias("city"), F.col("n_name").alias("country"),
                 (F.col("n_regionkey") * 10).cast("double").alias("latitude"),
                 F.col("c_nationkey").cast("double").alias("longitude"))
    return gold.dim_city(v)


def q_gold_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.kpi_revenue(q_gold_fact(spark, sf_dir))


def q_gold_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views over the stored validated table, then the existence test and a
    one-row probe of each view (the chain itself runs once, for the write)."""
    path = f"{shared_dir(spark, 'gold_validate')}/validated"
    overwrite(lineitem_silver(spark, sf_dir), path)
    gold.register_gold_views(spark, spark.read.parquet(path))
    return gold.validate_gold_views(spark)


def q_gold_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold views of the catalog over a table by its three-part name, read by
    another session: the fact joined with its city's dimension rows and the
    hotel's revenue."""
    db = f"spark_catalog.{shared_database(spark, 'gold_views')}"
    validated = f"{db}.silver_hotel_bookings_validated"
    overwrite(lineitem_silver(spark, sf_dir), validated)
    gold.validate_gold_views(spark, gold.create_gold_views(spark, validated, db))
    fact, dim, kpi = (read_table(spark.newSession(), f"{db}.{v}")
                      for v in (K.GOLD_FACT_VIEW, K.GOLD_DIM_VIEW, K.GOLD_KPI_VIEW))
    cities = dim.groupBy("city").agg(F.count("*").alias("city_rows"))
    return fact.join(cities, "city").join(kpi, "hotel_name")


def _orders_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    j = o.join(cn, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("booking_id"),
                    F.col("n_name").alias("city"))


def q_bi_count_by_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings (non-null ids) per city of the city dimension; the dimension
    holds the cities where suppliers are."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    dim = gold.dim_city(s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
                        .select(F.col("n_name").alias("city"), F.col("n_name").alias("country"),
                                F.col("n_regionkey").cast("double").alias("latitude"),
                                F.col("n_nationkey").cast("double").alias("longitude")))
    return bi.count_by_dimension(_orders_by_city(spark, sf_dir), dim)


def q_bi_count_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the row that a report shows for cities it doesn't know;
    the dimension holds the nations of the first three regions."""
    n = table(spark, sf_dir, "nation").where("n_regionkey < 3")
    dim = n.select(F.col("n_name").alias("city"), F.col("n_regionkey").alias("country"))
    return bi.count_by_dimension(_orders_by_city(spark, sf_dir), dim, unknown=True)


def q_bi_implicit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.implicit_totals(q_gold_kpi(spark, sf_dir),
                              {"total_revenue": "sum", "total_bookings": "sum"})


def q_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(_events(spark, sf_dir), "ts", K.LATEST_N, tie_breakers=["event_id"])


def q_sample_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unordered preview of ten rows.  The rows are arbitrary, so the check
    is that ten different ones come back and that all of them, looked up by
    every column, are rows of the table."""
    e = _events(spark, sf_dir)
    found = sample_rows(e, 10).join(e.withColumn("found", F.lit(1)), e.columns, "left")
    return found.agg(F.count(F.lit(1)).alias("preview_rows"), F.count_distinct("event_id").alias("different_rows"),
                     F.count("found").alias("found_rows"))


QUERIES = {
    "bronze_csv_ingest": q_bronze_csv_ingest,
    "bronze_json_payload": q_bronze_json_payload,
    "bronze_json_weather": q_bronze_json_weather,
    "bronze_stream_ingest": q_bronze_stream_ingest,
    "ingest_summary": q_ingest_summary,
    "profile_nulls": q_profile_nulls,
    "dedup_by_key": q_dedup_by_key,
    "dedup_any_keys": q_dedup_any_keys,
    "dedup_report": q_dedup_report,
    "filter_report": q_filter_report,
    "clean_special_chars": q_clean_special_chars,
    "digits_only": q_digits_only,
    "geo_clean": q_geo_clean,
    "format_text": q_format_text,
    "dictionary_lookup": q_dictionary_lookup,
    "lookup_coverage": q_lookup_coverage,
    "parse_dates": q_parse_dates,
    "logical_filter": q_logical_filter,
    "enrich_constants": q_enrich_constants,
    "stage_metrics": q_stage_metrics,
    "silver_batch": q_silver_batch,
    "silver_stream_upsert": q_silver_stream_upsert,
    "stream_job": q_stream_job,
    "run_order_twice": q_run_order_twice,
    "silver_batch_metrics": q_silver_batch_metrics,
    "percent_ties": q_percent_ties,
    "quality_report": q_quality_report,
    "quality_blocking": q_quality_blocking,
    "quality_gate": q_quality_gate,
    "quality_text_stars": q_quality_text_stars,
    "quality_gate_outcomes": q_quality_gate_outcomes,
    "gold_fact": q_gold_fact,
    "gold_dim_distinct": q_gold_dim_distinct,
    "gold_kpi": q_gold_kpi,
    "gold_validate": q_gold_validate,
    "gold_views": q_gold_views,
    "bi_count_by_dim": q_bi_count_by_dim,
    "bi_count_unknown": q_bi_count_unknown,
    "bi_implicit_totals": q_bi_implicit_totals,
    "latest_n": q_latest_n,
    "sample_preview": q_sample_preview,
}
