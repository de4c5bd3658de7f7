"""The whole run, in order (JOB-6): raw CSV ingest -> API payloads -> batch
silver -> stream silver -> validate and publish -> gold.  A stage starts only
after the previous one finished; a failed stage raises and stops the run.
Profiling is a separate, on-demand report (not part of the run).

Tables are folders under one root, or tables of the catalog when a database is
named; then the gold views belong to the catalog too and outlive the session.

The batch job drops and recreates silver, streamed bookings included.  So each
run gives the stream job a checkpoint of its own: it reads the raw stream table
from the start, as a new stream, and inserts what the rebuilt table lacks.  Any
number of runs therefore end with the same bookings.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lodgeflow.plans.gold import refresh_gold
from lodgeflow.plans.quality import validate_and_publish
from lodgeflow.plans.silver import run_bronze_to_silver, stream_to_silver
from lodgeflow.sinks.tables import overwrite
from lodgeflow.sources.api import (CURRENCY_SCHEMA, WEATHER_SCHEMA, currency_rows, read_payloads,
                                   weather_rows)
from lodgeflow.sources.files import add_load_metadata, read_csv, read_table, read_table_if_exists
from lodgeflow.streaming.ingest import ingest_events, read_table_stream
from lodgeflow.streaming.upsert import unmatched_sql


@dataclass
class Layout:
    """Where things live: tables in ``database`` of the catalog, if named, else
    in folders under ``root``; checkpoints and reports under ``root``."""
    root: str
    database: str | None = None

    def table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else os.path.join(self.root, name)

    def folder(self, name: str) -> str:
        return os.path.join(self.root, name)


def run_all_stages(spark: SparkSession, csv_path: str, weather_json: str | None,
                   currency_json: str | None, events_json: str | None, root: str,
                   database: str | None = None, max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Run every stage in order; returns the gold view check.  A failing
    quality gate raises and stops the run.  ``max_files_per_trigger`` bounds
    the stream's micro-batches."""
    at = Layout(root, database)
    raw_batch, silver, stream = map(at.table, ("hotel_raw_batch", "silver_hotel_bookings", "hotel_raw_stream"))
    weather, currency = at.table("raw_weather_api"), at.table("raw_currency_api")
    validated = at.table("silver_hotel_bookings_validated")
    # 1. raw batch (parsed rows spread over the cluster when the landing
    #    folder holds fewer files than there are cores)
    try:
        parallelism = spark.sparkContext.defaultParallelism
    except Exception:  # remote session
        parallelism = None
    overwrite(add_load_metadata(read_csv(spark, csv_path, spread_to=parallelism)), raw_batch)
    # 2. landed API payloads
    if weather_json:
        overwrite(weather_rows(read_payloads(spark, weather_json, WEATHER_SCHEMA)), weather)
    if currency_json:
        overwrite(currency_rows(read_payloads(spark, currency_json, CURRENCY_SCHEMA)), currency)

    def load(name):  # an absent reference table makes the enrichment fall back
        return read_table_if_exists(spark, name)

    # 3. batch silver
    run_bronze_to_silver(read_table(spark, raw_batch), silver, rate_table=load(currency), weather_table=load(weather))
    # 4. stream silver: the whole raw stream table, as silver was rebuilt
    if events_json:
        ingest_events(spark, events_json, stream, at.folder("ckpt_raw_stream"),
                      max_files_per_trigger=max_files_per_trigger)
    if events_json or load(stream) is not None:
        stream_to_silver(read_table_stream(spark, stream, max_files_per_trigger=max_files_per_trigger), silver,
                         at.folder(f"ckpt_silver_upsert/{uuid.uuid4().hex}"),
                         rate_table_loader=lambda: load(currency), weather_table_loader=lambda: load(weather),
                         batch_sql=unmatched_sql(silver, "booking_id") if database else None)
    # 5. validate and publish
    validate_and_publish(spark, read_table(spark, silver), validated, report_path=at.folder("silver_quality_report"))
    # 6. gold
    return refresh_gold(spark, validated)
