"""Bronze -> silver (JOB-1 batch, JOB-2 stream).

The chain is: de-duplicate on the key (first, on keys as read) -> strip
punctuation -> phone digits -> coordinates -> text format -> language look-up
-> dates -> drop null keys -> business rules -> enrichment.  Everything after
the de-duplication is narrow, so the job is one shuffle (on the key) plus one
write; the stream reuses the same row-wise steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodgeflow import constants as K
from lodgeflow.operators import cleaning
from lodgeflow.operators.dedup import dedup_by_key
from lodgeflow.operators.enrich import enrich, enrichment_values
from lodgeflow.functions import percent, percent_of
from lodgeflow.operators.lookup import lookup_constant
from lodgeflow.operators.rules import (apply_business_rules, business_rule, drop_null_keys,
                                       null_key_predicate)
from lodgeflow.session import drop_shuffles, is_path, small_methods
from lodgeflow.sinks.tables import key_bloom_options, overwrite
from lodgeflow.streaming.upsert import LOAD_COL, read_target, run_upsert

_NULL_KEY, _HOLDS = "__lodgeflow_null_key", "__lodgeflow_holds"


def standardize(df: DataFrame, language_map: Mapping[str, str] = K.LANGUAGE_BY_COUNTRY,
                keep_language: bool = False) -> DataFrame:
    """Row-wise clean-up (SCA-1..9, JOI-2); works on batch and stream.

    The look-up overwrites ``language_preference`` as the original does;
    ``keep_language=True`` keeps a non-null incoming value instead."""
    df = cleaning.strip_special_chars(df)
    df = cleaning.keep_digits(df)
    df = cleaning.clean_coordinates(df)
    df = cleaning.format_text(df)
    if "country_customer" in df.columns:
        keep = keep_language and "language_preference" in df.columns
        if keep:
            df = df.withColumnRenamed("language_preference", "__lang_in")
        df = lookup_constant(df, "country_customer", "language_preference", language_map)
        if keep:
            df = df.withColumn("language_preference",
                               F.coalesce(F.col("__lang_in"), F.col("language_preference"))).drop("__lang_in")
    return cleaning.parse_dates(df)


def filter_valid(df: DataFrame, truncate_numeric: bool = True) -> DataFrame:
    """Drop rows without ids, then rows breaking the business rules (FLT-1, FLT-2)."""
    return apply_business_rules(drop_null_keys(df), truncate_numeric)


def bronze_to_silver(raw: DataFrame, key: str = K.BOOKING_KEY,
                     dedup_order: Sequence[Column] | None = None,
                     rate_table: DataFrame | None = None, weather_table: DataFrame | None = None,
                     rate_col: str = "eur_rate", truncate_numeric: bool = True,
                     language_map: Mapping[str, str] = K.LANGUAGE_BY_COUNTRY,
                     keep_language: bool = False) -> DataFrame:
    """The silver rows of a raw booking table (JOB-1 without the write):
    dedup on ``key`` -> row-wise clean-up -> key and rule filters ->
    enrichment.  One shuffle (the dedup); everything else is narrow."""
    df = standardize(dedup_by_key(raw, key, dedup_order), language_map, keep_language)
    df = filter_valid(df, truncate_numeric)
    return enrich(df, rate_table=rate_table, rate_col=rate_col, weather_table=weather_table)


def silver_metrics(raw: DataFrame, key: str = K.BOOKING_KEY,
                   id_cols: Sequence[str] = K.KEY_COLUMNS, truncate_numeric: bool = True,
                   rule_cols: Mapping[str, str] | None = None,
                   to_booking: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """MET-1 and MET-3 as one report.

    The survivors come from ``dedup_by_key`` (each map task forwards at most
    one row per key); the raw rows are counted by a scan of no column, and
    both end in one aggregate.  Rules see the survivors after ``standardize``
    (ids are rewritten before the null test in the original chain).
    ``to_booking`` maps survivor rows to booking columns first.
    """
    survivors = dedup_by_key(raw, key)
    if to_booking is not None:
        survivors = to_booking(survivors)
    survivors = standardize(survivors)
    nk = null_key_predicate(list(id_cols))
    rule = business_rule(truncate_numeric=truncate_numeric, **(rule_cols or {}))
    kept = ~nk & F.coalesce(rule, F.lit(False))
    facts = survivors.select(F.lit(False).alias("raw"), nk.alias("null_key"), kept.alias("kept")).unionByName(
        raw.select(F.lit(True).alias("raw"), F.lit(False).alias("null_key"), F.lit(False).alias("kept")))
    r = facts.agg(F.count_if("raw").alias("rows_before"), F.count_if(~F.col("raw")).alias("rows_after_dedup"),
                  F.count_if("null_key").alias("null_key_rows"), F.count_if("kept").alias("rows_after_filter"))
    return r.select(
        "rows_before", (F.col("rows_before") - F.col("rows_after_dedup")).alias("duplicates_removed"),
        "rows_after_dedup",
        percent(F.col("rows_before") - F.col("rows_after_dedup"), "rows_before").alias("dedup_removed_pct"),
        "null_key_rows",
        (F.col("rows_after_dedup") - F.col("rows_after_filter") - F.col("null_key_rows")).alias("rule_failures"),
        "rows_after_filter",
        percent(F.col("rows_after_dedup") - F.col("rows_after_filter"), "rows_after_dedup").alias("filter_loss_pct"))


def write_silver(df: DataFrame, target: str, load_id: str = "batch",
                 keys: Sequence[str] | str | None = K.BOOKING_KEY) -> None:
    """Drop-and-recreate (SNK-2): every partition, stream inserts included, is
    replaced, as a full batch rebuild of the original does.  Rows are sorted
    by key inside each file (no extra shuffle) and every row group carries a
    bloom filter on the key, so the upsert's key-range and key-list filters
    skip row groups."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    out = df.withColumn(LOAD_COL, F.lit(load_id))
    present = [k for k in keys if k in df.columns]
    if present:
        out = out.sortWithinPartitions(LOAD_COL, *present)
    overwrite(out, target, partition_by=[LOAD_COL],
              options=key_bloom_options(present[0]) if present else None)
    if is_path(target) and read_target(df.sparkSession, target) is None:
        # no rows: a partitioned write leaves no file, so keep the schema
        # readable with an empty file in this load's partition folder
        df.limit(0).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{LOAD_COL}={load_id}")


def run_bronze_to_silver(raw: DataFrame, target: str, key: str = K.BOOKING_KEY,
                         id_cols: Sequence[str] = K.KEY_COLUMNS,
                         dedup_order: Sequence[Column] | None = None,
                         rate_table: DataFrame | None = None, weather_table: DataFrame | None = None,
                         rate_col: str = "eur_rate", truncate_numeric: bool = True,
                         language_map: Mapping[str, str] = K.LANGUAGE_BY_COUNTRY,
                         keep_language: bool = False) -> dict:
    """JOB-1 as one job: build and write silver, and return the stage metrics
    (MET-1 de-duplication, MET-2 look-up coverage, MET-3 filter loss, MET-5
    enrichment status)
    collected by ``observe`` while the rows stream through the write: no
    extra scan or shuffle.  The key and rule tests are columns, computed once
    per row in the projection; the observed counts, which are interpreted row
    by row, and the filter only read them.  (Observed counts come from successful task
    attempts, so a retried task counts once; only a finished stage that is
    recomputed after its shuffle output was lost could count twice, so
    ``silver_metrics`` is the exact, separate report.)"""
    o_raw, o_clean = Observation("raw"), Observation("clean")
    df = raw.observe(o_raw, F.count(F.lit(1)).alias("rows"))
    # row by row after the de-duplication: its rows are counted with the rest
    df = standardize(dedup_by_key(df, key, dedup_order), language_map, keep_language)
    df = df.withColumns({_NULL_KEY: null_key_predicate(list(id_cols)),
                         _HOLDS: F.coalesce(business_rule(truncate_numeric=truncate_numeric), F.lit(False))})
    lang = (F.count(F.col("language_preference")) if "language_preference" in df.columns
            else F.lit(0).cast("long"))
    df = df.observe(o_clean, F.count(F.lit(1)).alias("rows"), lang.alias("filled"),
                    F.count_if(_NULL_KEY).alias("null_keys"),
                    F.count_if(~F.col(_NULL_KEY) & F.col(_HOLDS)).alias("kept"))
    df = drop_null_keys(df).filter(_HOLDS).drop(_NULL_KEY, _HOLDS)
    values = enrichment_values(rate_table, rate_col, weather_table)
    with small_methods(df.sparkSession), drop_shuffles(df.sparkSession):
        write_silver(enrich(df, values=values), target, keys=[key])
    c = o_clean.get
    before, after = o_raw.get["rows"], c["rows"]
    return {
        "dedup": {"rows_before": before, "rows_removed": before - after, "rows_after": after,
                  "removed_pct": percent_of(before - after, before)},
        "lookup": {"total": c["rows"], "filled": c["filled"], "missing": c["rows"] - c["filled"],
                   "filled_pct": percent_of(c["filled"], c["rows"]),
                   "missing_pct": percent_of(c["rows"] - c["filled"], c["rows"])},
        "filter": {"rows_before": c["rows"], "null_key_rows": c["null_keys"],
                   "rule_failures": c["rows"] - c["kept"] - c["null_keys"], "rows_after": c["kept"],
                   "loss_pct": percent_of(c["rows"] - c["kept"], c["rows"])},
        "enrichment": values,
    }


def stream_to_silver(stream: DataFrame, target: str, checkpoint: str, key: str = K.BOOKING_KEY,
                     rate_table_loader=None, weather_table_loader=None,
                     truncate_numeric: bool = True, dedup_order: Sequence[Column] | None = None,
                     language_map: Mapping[str, str] = K.LANGUAGE_BY_COUNTRY,
                     keep_language: bool = False, batch_sql: str | None = None) -> None:
    """JOB-2: the same row-wise chain on the stream, then per micro-batch the
    enrichment (reference tables re-read every batch) and the insert-only
    upsert.  Waits until everything available is processed.

    ``batch_sql`` selects what is inserted from the enriched micro-batch's
    view ``updates`` (``streaming.upsert.unmatched_sql`` for example)."""
    cleaned = filter_valid(standardize(stream, language_map, keep_language), truncate_numeric)

    def per_batch(batch: DataFrame) -> DataFrame:
        rates = rate_table_loader() if rate_table_loader else None
        weather = weather_table_loader() if weather_table_loader else None
        return enrich(batch, rate_table=rates, weather_table=weather)

    with small_methods(stream.sparkSession), drop_shuffles(stream.sparkSession):
        run_upsert(cleaned, target, checkpoint, key, per_batch, dedup_order, batch_sql=batch_sql)
