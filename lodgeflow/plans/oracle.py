"""Independent SQL (DuckDB dialect) for every registered query.

The oracles restate each query's semantics directly in SQL over the same
parquet tables; they do not reuse the Spark code.  Column names match the
Spark results.
"""

from __future__ import annotations

from lodgeflow import constants as K


def strip(x: str) -> str:
    return f"trim(regexp_replace({x}, '[!@#$%^&*().,]', '', 'g'))"


def initcap(x: str) -> str:
    # DuckDB has no initcap: lower everything, upper the first letter of each
    # space-separated word
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def pct(part: str, total: str, zero: str = "NULL") -> str:
    """round(100 * part / total, 2), ties to even, in exact integer arithmetic."""
    num, den = f"(20000 * CAST(({part}) AS HUGEINT) + ({total}))", f"(2 * CAST(({total}) AS HUGEINT))"
    odd_tie = f"CASE WHEN {num} % {den} = 0 AND ({num} // {den}) % 2 = 1 THEN 1 ELSE 0 END"
    return f"CASE WHEN ({total}) = 0 THEN {zero} ELSE CAST({num} // {den} - {odd_tie} AS DOUBLE) / 100.0 END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


LANG_VALUES = "(VALUES " + ", ".join(f"({_q(k)}, {_q(v)})" for k, v in K.LANGUAGE_BY_COUNTRY.items()) + ") AS lang(k, v)"

LINEITEM_ORDER = ", ".join(f"{c} NULLS FIRST" for c in [
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate"])

LINEITEM_DEDUP = f"""SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINEITEM_ORDER}) = 1"""

# the line-item bookings chain: dedup -> join part -> clean/format -> rules -> fact
LINEITEM_FACT_CTES = f"""
li AS ({LINEITEM_DEDUP}),
raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS booking_id, CAST(l_partkey AS VARCHAR) AS hotel_id,
         p_name AS hotel_name, p_brand AS city, l_returnflag AS country,
         l_quantity AS lat_n, l_extendedprice / 1000 AS lon_n,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS checkin_date,
         CAST(CAST(l_shipdate AS DATE) + l_linenumber AS VARCHAR) AS checkout_date,
         CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) AS nights,
         CAST(l_quantity AS BIGINT) - 3 AS adults_n, l_extendedprice AS price_n,
         l_linenumber AS star_n, round(l_discount * 100) AS nights_n
  FROM li JOIN part ON l_partkey = p_partkey),
silver AS (
  SELECT booking_id, upper({strip('hotel_id')}) AS hotel_id, {initcap(strip('hotel_name'))} AS hotel_name,
         {initcap(strip('city'))} AS city, upper({strip('country')}) AS country,
         CASE WHEN lat_n BETWEEN -90 AND 90 AND lat_n <> 0 THEN round(lat_n, 6) END AS latitude,
         CASE WHEN lon_n BETWEEN -180 AND 180 AND lon_n <> 0 THEN round(lon_n, 6) END AS longitude,
         checkin_date, checkout_date, nights, price_n
  FROM raw
  WHERE booking_id IS NOT NULL AND hotel_id IS NOT NULL
    AND price_n > 0 AND adults_n > 0 AND star_n BETWEEN 1 AND 5 AND nights_n > 0),
fact AS (
  SELECT booking_id, hotel_id, hotel_name, city, checkin_date, checkout_date, nights,
         CAST(price_n AS DECIMAL(18,2)) AS total_price_eur
  FROM silver),
kpi AS (
  SELECT hotel_name, CAST(SUM(total_price_eur) AS DECIMAL(38,2)) AS total_revenue,
         COUNT(booking_id) AS total_bookings
  FROM fact GROUP BY hotel_name)"""


def whole(x: str) -> str:
    """Text as a comparison with a whole number reads it: cut off at the point,
    null where it has an exponent or is no number."""
    return (f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)\\s*$') "
            f"THEN trunc(TRY_CAST({x} AS DOUBLE)) END")


def text_star(key: str, plain: str) -> str:
    return (f"CASE {key} % 19 WHEN 0 THEN 'x' WHEN 1 THEN '0.9' WHEN 2 THEN '5.9' WHEN 3 THEN '4.5' WHEN 4 THEN '1e1' "
            f"WHEN 5 THEN ' 3 ' WHEN 6 THEN '' WHEN 7 THEN '6.0' ELSE {plain} END")


_LI_STAR = text_star("l_orderkey", "CAST(l_linenumber AS VARCHAR)")
_LI_RULE = (f"l_orderkey % 17 <> 0 AND trunc(l_extendedprice) > 0 AND trunc(l_quantity - 5) > 0 "
            f"AND coalesce(({whole(_LI_STAR)}) BETWEEN 1 AND 5, false) AND trunc(round(l_discount * 100) / 4) > 0")

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["bronze_csv_ingest"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice,
       p_name || ', "' || p_brand || '"' || chr(10) || p_type AS p_notes,
       CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS p_type_opt,
       '{K.BATCH_SOURCE_NAME}' AS source_bron
FROM part"""

ORACLE_SQL["bronze_json_payload"] = "SELECT 'EUR' AS base_currency, " + ", ".join(
    f"CASE WHEN event_id % {i + 2} <> 0 THEN value * {i + 1} END AS {c.lower()}_rate"
    for i, c in enumerate(K.CURRENCY_CODES)) + ", CAST(CAST(ts AS DATE) AS VARCHAR) AS update_date FROM events"

ORACLE_SQL["bronze_json_weather"] = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS "time", CAST(NULL AS BIGINT) AS "interval",
       value AS temperature, CAST(NULL AS DOUBLE) AS windspeed, CAST(NULL AS BIGINT) AS winddirection,
       CAST(NULL AS BIGINT) AS is_day, user_id AS weathercode
FROM events"""

ORACLE_SQL["bronze_stream_ingest"] = "SELECT * FROM events"

ORACLE_SQL["ingest_summary"] = f"""
SELECT count(*) AS row_count, 8 AS column_count, '{K.BATCH_SOURCE_NAME}' AS source FROM part"""

_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORACLE_SQL["profile_nulls"] = f"""
WITH o AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority
  FROM orders),
c AS (
  SELECT count(*) AS t,
         count(*) FILTER (WHERE o_orderkey IS NULL) AS n0, count(*) FILTER (WHERE o_custkey IS NULL) AS n1,
         count(*) FILTER (WHERE o_orderstatus IS NULL) AS n2, count(*) FILTER (WHERE o_totalprice IS NULL OR isnan(o_totalprice)) AS n3,
         count(*) FILTER (WHERE o_orderdate IS NULL) AS n4, count(*) FILTER (WHERE o_orderpriority IS NULL) AS n5
  FROM o)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS Column_Name, n{i} AS Null_Count, {pct(f'n{i}', 't', '0.0')} AS Missing_Percentage FROM c"
    for i, c in enumerate(_PROFILE_COLS))

ORACLE_SQL["dedup_by_key"] = LINEITEM_DEDUP

ORACLE_SQL["dedup_any_keys"] = "SELECT DISTINCT l_orderkey FROM lineitem"

ORACLE_SQL["dedup_report"] = f"""
WITH a AS (
  SELECT count(*) AS rows_before,
         count(DISTINCT l_orderkey) + coalesce(max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END), 0) AS rows_after
  FROM lineitem)
SELECT rows_before, rows_before - rows_after AS rows_removed, rows_after,
       {pct('rows_before - rows_after', 'rows_before')} AS removed_pct
FROM a"""

ORACLE_SQL["filter_report"] = f"""
WITH a AS (
  SELECT count(*) AS rows_before, count(*) FILTER (WHERE l_orderkey % 17 = 0) AS null_key_rows,
         count(*) FILTER (WHERE {_LI_RULE}) AS rows_after
  FROM lineitem)
SELECT rows_before, null_key_rows, rows_before - rows_after - null_key_rows AS rule_failures, rows_after,
       {pct('rows_before - rows_after', 'rows_before')} AS loss_pct
FROM a"""

ORACLE_SQL["clean_special_chars"] = f"""
SELECT doc_id, {strip('text')} AS text, {strip('lang')} AS lang, {strip('source')} AS source
FROM documents"""

ORACLE_SQL["digits_only"] = """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS phone,
       regexp_replace('+' || CAST(c_nationkey AS VARCHAR) || ' (' || CAST(c_custkey AS VARCHAR) || ') 555-01',
                      '[^0-9]', '', 'g') AS phone2
FROM customer"""

ORACLE_SQL["geo_clean"] = """
WITH t AS (
  SELECT event_id,
         TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'bad' WHEN event_id % 11 = 0 THEN '0'
                       ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS la,
         TRY_CAST(CAST(value - 245 AS VARCHAR) AS DOUBLE) AS lo
  FROM events)
SELECT event_id,
       CASE WHEN la BETWEEN -90 AND 90 AND la <> 0 THEN round(la, 6) END AS latitude,
       CASE WHEN lo BETWEEN -180 AND 180 AND lo <> 0 THEN round(lo, 6) END AS longitude
FROM t"""

ORACLE_SQL["format_text"] = f"""
SELECT p_partkey, upper(p_brand) AS hotel_id, {initcap('p_name')} AS hotel_name,
       upper(trim('  ' || p_type || ' ')) AS room_type, {initcap("trim(' ' || lower(p_type))")} AS trip_type,
       lower(trim(' ' || p_brand || '@Example.COM ')) AS email, {initcap('upper(p_name)')} AS city
FROM part"""

_SEGMENTS = "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Home' WHEN 'MACHINERY' THEN 'Industry' WHEN 'AUTOMOBILE' THEN 'Industry' END"

ORACLE_SQL["dictionary_lookup"] = f"""
SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, {_SEGMENTS} AS segment_group,
       n.n_name AS nation_name, lang.v AS language_preference
FROM customer c
LEFT JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation GROUP BY n_nationkey) n
       ON c.c_nationkey = n.n_nationkey
LEFT JOIN {LANG_VALUES} ON upper(n.n_name) = lang.k"""

ORACLE_SQL["lookup_coverage"] = f"""
WITH l AS (SELECT {_SEGMENTS} AS g FROM customer),
c AS (SELECT count(*) AS total, count(g) AS filled FROM l)
SELECT total, filled, total - filled AS missing, {pct('filled', 'total')} AS filled_pct,
       {pct('total - filled', 'total')} AS missing_pct
FROM c"""

ORACLE_SQL["parse_dates"] = """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderkey % 13 = 0 THEN '31/12/2024' WHEN o_orderkey % 17 = 0 THEN 'n/a'
                     ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATE) AS booking_date,
       TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN ''
                     ELSE CAST(CAST(o_orderdate AS DATE) - 9000 AS VARCHAR) END AS DATE) AS birth_date,
       CAST(o_orderdate AS DATE) + 3 AS stay_date
FROM orders"""

ORACLE_SQL["logical_filter"] = f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       CAST(l_orderkey AS VARCHAR) AS booking_id, CAST(l_partkey AS VARCHAR) AS hotel_id,
       {_LI_STAR} AS star_rating
FROM lineitem
WHERE {_LI_RULE}"""

ORACLE_SQL["enrich_constants"] = """
SELECT o_orderkey, round(o_totalprice * CAST(1.08 AS DOUBLE), 2) AS total_price_eur,
       (SELECT arg_max(value, ts) FROM events) AS ingested_temp, true AS rate_is_fallback
FROM orders"""

ORACLE_SQL["stage_metrics"] = f"""
WITH d AS ({LINEITEM_DEDUP}),
a AS (
  SELECT (SELECT count(*) FROM lineitem) AS rows_before, count(*) AS rows_after_dedup,
         count(*) FILTER (WHERE l_orderkey % 17 = 0) AS null_key_rows,
         count(*) FILTER (WHERE {_LI_RULE}) AS rows_after_filter
  FROM d)
SELECT rows_before, rows_before - rows_after_dedup AS duplicates_removed, rows_after_dedup,
       {pct('rows_before - rows_after_dedup', 'rows_before')} AS dedup_removed_pct,
       null_key_rows, rows_after_dedup - rows_after_filter - null_key_rows AS rule_failures,
       rows_after_filter,
       {pct('rows_after_dedup - rows_after_filter', 'rows_after_dedup')} AS filter_loss_pct
FROM a"""

_STAR, _PRICE = "CAST(n_nationkey % 7 AS VARCHAR)", "CAST(o_totalprice AS VARCHAR)"
_DIRTY_STAR = text_star("o_orderkey", _STAR)
_DIRTY_PRICE = f"CASE WHEN o_orderkey % 31 = 0 THEN '0.99' ELSE {_PRICE} END"


def order_ctes(star: str = _STAR, price: str = _PRICE) -> str:
    """raw: order bookings as text; s: after the clean-up, with the language
    and whether the row keeps its ids (has_ids) and holds the rules (valid)."""
    return f"""raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS booking_id,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE ' h-' || CAST(o_custkey % 100 AS VARCHAR) || '!' END AS hotel_id,
         c_mktsegment || '.' AS hotel_name, n_name AS country, lower(n_name) || ', ' || c_mktsegment AS city,
         c_name AS full_name, lower(c_mktsegment) AS city_customer, n_name AS country_customer,
         '  ' || c_name || ' (hq)' AS address, ' ' || o_orderstatus || ' ' AS room_type,
         '+90 (' || CAST(c_nationkey AS VARCHAR) || ') ' || CAST(c_custkey AS VARCHAR) AS phone,
         c_acctbal AS lat_n, o_totalprice / 1000 AS lon_n,
         ' ' || c_name || '@Mail.COM ' AS email, ' ' || o_orderpriority AS trip_type,
         CASE WHEN o_orderkey % 23 = 0 THEN '31/12/2024' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS booking_date,
         {price} AS total_price, CAST(o_custkey % 4 AS VARCHAR) AS adults,
         {star} AS star_rating, CAST(length(o_orderpriority) - 5 AS VARCHAR) AS nights
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
s AS (
  SELECT booking_id, upper({strip('hotel_id')}) AS hotel_id, {initcap(strip('hotel_name'))} AS hotel_name,
         upper({strip('country')}) AS country, {initcap(strip('city'))} AS city,
         {initcap(strip('full_name'))} AS full_name, {initcap(strip('city_customer'))} AS city_customer,
         upper({strip('country_customer')}) AS country_customer, {strip('address')} AS address,
         upper(trim({strip('room_type')})) AS room_type,
         regexp_replace(phone, '[^0-9]', '', 'g') AS phone,
         CASE WHEN lat_n BETWEEN -90 AND 90 AND lat_n <> 0 THEN round(lat_n, 6) END AS latitude,
         CASE WHEN lon_n BETWEEN -180 AND 180 AND lon_n <> 0 THEN round(lon_n, 6) END AS longitude,
         lower(trim(email)) AS email, {initcap('trim(trip_type)')} AS trip_type,
         TRY_CAST(booking_date AS DATE) AS booking_date, booking_date AS booking_text,
         total_price, adults, star_rating, nights, lang.v AS language_preference,
         hotel_id IS NOT NULL AND booking_id IS NOT NULL AS has_ids,
         coalesce(({whole('total_price')}) > 0 AND ({whole('adults')}) > 0 AND ({whole('star_rating')}) BETWEEN 1 AND 5
                  AND ({whole('nights')}) > 0, false) AS valid
  FROM raw LEFT JOIN {LANG_VALUES} ON upper({strip('country_customer')}) = lang.k)"""


_SILVER_COLUMNS = """booking_id, hotel_id, hotel_name, country, city, full_name, city_customer, country_customer,
       address, room_type, phone, latitude, longitude, email, trip_type, booking_date,
       total_price, adults, star_rating, nights, language_preference"""
_LIVE_RATE = "(SELECT arg_max(value, ts) / 100 FROM events)"
_LIVE_TEMP = "(SELECT arg_max(value, ts) - 5 FROM events)"

ORACLE_SQL["silver_batch"] = f"""
WITH {order_ctes()}
SELECT {_SILVER_COLUMNS}, round(CAST(total_price AS DOUBLE) * CAST(1.08 AS DOUBLE), 2) AS total_price_eur,
       CAST(20.0 AS DOUBLE) AS ingested_temp
FROM s WHERE has_ids AND valid"""

ORACLE_SQL["stream_job"] = f"""
WITH {order_ctes(_DIRTY_STAR, _DIRTY_PRICE)}
SELECT {_SILVER_COLUMNS},
       round(CAST(total_price AS DOUBLE) * CASE WHEN room_type = 'F' THEN CAST(1.08 AS DOUBLE) ELSE {_LIVE_RATE} END, 2)
         AS total_price_eur,
       CASE WHEN room_type = 'F' THEN CAST(20.0 AS DOUBLE) ELSE {_LIVE_TEMP} END AS ingested_temp
FROM s WHERE has_ids AND valid"""

ORACLE_SQL["run_order_twice"] = f"""
WITH {order_ctes(_DIRTY_STAR, _DIRTY_PRICE)}
SELECT hotel_name, CAST(SUM(CAST(total_price AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       count(booking_id) AS total_bookings
FROM s WHERE has_ids AND valid GROUP BY hotel_name"""

ORACLE_SQL["silver_batch_metrics"] = f"""
WITH {order_ctes(_DIRTY_STAR, _DIRTY_PRICE)},
c AS (
  SELECT count(*) AS n, count(language_preference) AS filled, count(*) FILTER (WHERE NOT has_ids) AS no_ids,
         count(*) FILTER (WHERE has_ids AND valid) AS kept
  FROM s)
SELECT unnest([
  {{'metric': 'dedup.rows_before', 'value': CAST(2 * n AS DOUBLE)}},
  {{'metric': 'dedup.rows_removed', 'value': CAST(n AS DOUBLE)}},
  {{'metric': 'dedup.rows_after', 'value': CAST(n AS DOUBLE)}},
  {{'metric': 'dedup.removed_pct', 'value': 50.0::DOUBLE}},
  {{'metric': 'lookup.total', 'value': CAST(n AS DOUBLE)}},
  {{'metric': 'lookup.filled', 'value': CAST(filled AS DOUBLE)}},
  {{'metric': 'lookup.missing', 'value': CAST(n - filled AS DOUBLE)}},
  {{'metric': 'lookup.filled_pct', 'value': {pct('filled', 'n')}}},
  {{'metric': 'lookup.missing_pct', 'value': {pct('n - filled', 'n')}}},
  {{'metric': 'filter.rows_before', 'value': CAST(n AS DOUBLE)}},
  {{'metric': 'filter.null_key_rows', 'value': CAST(no_ids AS DOUBLE)}},
  {{'metric': 'filter.rule_failures', 'value': CAST(n - kept - no_ids AS DOUBLE)}},
  {{'metric': 'filter.rows_after', 'value': CAST(kept AS DOUBLE)}},
  {{'metric': 'filter.loss_pct', 'value': {pct('n - kept', 'n')}}},
  {{'metric': 'enrichment.eur_rate', 'value': {_LIVE_RATE}}},
  {{'metric': 'enrichment.rate_is_fallback', 'value': 0.0::DOUBLE}},
  {{'metric': 'enrichment.temperature', 'value': {_LIVE_TEMP}}},
  {{'metric': 'enrichment.temperature_is_fallback', 'value': 0.0::DOUBLE}},
  {{'metric': 'written.rows', 'value': CAST(kept AS DOUBLE)}}], recursive := true)
FROM c"""

ORACLE_SQL["percent_ties"] = f"""
WITH p AS (
  SELECT c_custkey // 32 AS block, c_mktsegment, count(*) AS part FROM customer GROUP BY ALL),
t AS (SELECT *, CAST(sum(part) OVER (PARTITION BY block) AS BIGINT) AS total FROM p)
SELECT block, c_mktsegment, part, total, {pct('part', 'total')} AS share_pct FROM t"""

ORACLE_SQL["silver_stream_upsert"] = """
SELECT event_id, ts, user_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value + 1000 ELSE value END AS value,
       props, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1"""

_CHECKS = [K.CHECK_UNIQUE_BOOKING, K.CHECK_NOT_NULL_HOTEL, K.CHECK_STAR_RANGE, K.CHECK_DATE_LOGIC,
           K.CHECK_PHONE_DIGITS, K.CHECK_LAT_LONG]
ORACLE_SQL["quality_report"] = f"""
WITH f AS (
  SELECT l_orderkey AS booking_id, l_partkey AS hotel_id, l_linenumber AS star_rating,
         CAST(l_shipdate AS DATE) AS checkin_date, CAST(l_shipdate AS DATE) + (l_linenumber - 3) AS checkout_date,
         l_returnflag AS phone, l_quantity - 45 AS latitude, l_extendedprice / 100 AS longitude
  FROM lineitem),
c AS (
  SELECT count(*) AS total_records,
         count(*) - (count(DISTINCT booking_id) + coalesce(max(CASE WHEN booking_id IS NULL THEN 1 ELSE 0 END), 0)) AS c0,
         count(*) FILTER (WHERE hotel_id IS NULL) AS c1,
         count(*) FILTER (WHERE NOT (star_rating BETWEEN 1 AND 5)) AS c2,
         count(*) FILTER (WHERE checkout_date < checkin_date) AS c3,
         count(*) FILTER (WHERE NOT regexp_matches(phone, '^\\d+$')) AS c4,
         count(*) FILTER (WHERE NOT (latitude BETWEEN -90 AND 90) OR NOT (longitude BETWEEN -180 AND 180)) AS c5
  FROM f),
s AS (SELECT *, (c0 = 0 AND c1 = 0 AND c2 = 0 AND c3 = 0 AND c4 = 0 AND c5 = 0) AS suite_success FROM c)
""" + "\nUNION ALL\n".join(
    f"SELECT {_q(n)} AS check_name, c{i} AS fail_count, total_records, "
    f"{pct(f'total_records - c{i}', 'total_records')} AS success_pct, c{i} = 0 AS passed, suite_success FROM s"
    for i, n in enumerate(_CHECKS))

_BLOCKING = [K.CHECK_UNIQUE_BOOKING, K.CHECK_NOT_NULL_HOTEL, K.CHECK_STAR_RANGE, K.CHECK_LAT_LONG]
ORACLE_SQL["quality_blocking"] = f"""
WITH f AS (
  SELECT c_custkey AS booking_id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS hotel_id,
         c_nationkey % 7 AS star_rating, c_acctbal / 100 AS latitude, c_acctbal / 50 AS longitude
  FROM customer),
c AS (
  SELECT count(*) AS total_records,
         count(*) - (count(DISTINCT booking_id) + coalesce(max(CASE WHEN booking_id IS NULL THEN 1 ELSE 0 END), 0)) AS c0,
         count(*) FILTER (WHERE hotel_id IS NULL) AS c1,
         count(*) FILTER (WHERE NOT (star_rating BETWEEN 1 AND 5)) AS c2,
         count(*) FILTER (WHERE NOT (latitude BETWEEN -90 AND 90) OR NOT (longitude BETWEEN -180 AND 180)) AS c3
  FROM f),
s AS (SELECT *, (c0 = 0 AND c1 = 0 AND c2 = 0 AND c3 = 0) AS suite_success FROM c)
""" + "\nUNION ALL\n".join(
    f"SELECT {_q(n)} AS check_name, c{i} AS fail_count, total_records, "
    f"{pct(f'total_records - c{i}', 'total_records')} AS success_pct, c{i} = 0 AS passed, suite_success FROM s"
    for i, n in enumerate(_BLOCKING))


def blocking_sql(fields: str, extra: str = "") -> str:
    """CTEs f (fields), c (total_records and the failures of the blocking
    checks as c0 to c3) and s (with the suite's outcome)."""
    return f"""WITH {extra}f AS ({fields}),
c AS (
  SELECT count(*) AS total_records,
         count(*) - (count(DISTINCT booking_id) + coalesce(max(CASE WHEN booking_id IS NULL THEN 1 ELSE 0 END), 0)) AS c0,
         count(*) FILTER (WHERE hotel_id IS NULL) AS c1,
         count(*) FILTER (WHERE NOT (star_rating BETWEEN 1 AND 5)) AS c2,
         count(*) FILTER (WHERE NOT (latitude BETWEEN -90 AND 90) OR NOT (longitude BETWEEN -180 AND 180)) AS c3
  FROM f),
s AS (SELECT *, (c0 = 0 AND c1 = 0 AND c2 = 0 AND c3 = 0) AS suite_success FROM c)
"""


ORACLE_SQL["quality_text_stars"] = blocking_sql(f"""
  SELECT l_orderkey AS booking_id, CASE WHEN l_orderkey % 17 <> 0 THEN l_partkey END AS hotel_id,
         {whole(_LI_STAR)} AS star_rating, trunc(l_quantity * 1.85::DOUBLE) AS latitude,
         trunc(l_extendedprice / 250) AS longitude
  FROM lineitem""") + "\nUNION ALL\n".join(
    f"SELECT {_q(n)} AS check_name, c{i} AS fail_count, total_records, "
    f"{pct(f'total_records - c{i}', 'total_records')} AS success_pct, c{i} = 0 AS passed, suite_success FROM s"
    for i, n in enumerate(_BLOCKING))

ORACLE_SQL["quality_gate_outcomes"] = blocking_sql("""
  SELECT c_custkey % 1000 AS booking_id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS hotel_id,
         c_nationkey % 7 AS star_rating, c_acctbal / 100 AS latitude, c_acctbal / 50 AS longitude
  FROM customer""") + "\nUNION ALL\n".join(
    f"SELECT {_q(run)} AS run, {_q(n)} AS check_name, c{i} AS fail_count, total_records, suite_success AS success, "
    f"{raised} AS raised, {warned} AS warned, CAST(0 AS BIGINT) AS published_rows FROM s"
    for run, raised, warned in (("raise", "true", "false"), ("warn", "false", "true"))
    for i, n in enumerate(_BLOCKING)) + "\nUNION ALL\n" + "\nUNION ALL\n".join(
    f"SELECT 'pass', {_q(n)}, CAST(0 AS BIGINT), count(*), true, false, false, count(*) FROM orders" for n in _BLOCKING)

ORACLE_SQL["quality_gate"] = """
SELECT *, o_orderkey AS booking_id, o_custkey AS hotel_id, CAST(length(o_orderstatus) AS INTEGER) AS star_rating,
       o_totalprice / 10000 AS latitude, o_totalprice / 10000 AS longitude
FROM orders"""

ORACLE_SQL["gold_fact"] = f"WITH {LINEITEM_FACT_CTES}\nSELECT * FROM fact"

ORACLE_SQL["gold_dim_distinct"] = f"""
SELECT DISTINCT {initcap('lower(c_mktsegment)')} AS city, n_name AS country,
       CAST(n_regionkey * 10 AS DOUBLE) AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

ORACLE_SQL["gold_kpi"] = f"WITH {LINEITEM_FACT_CTES}\nSELECT * FROM kpi"

ORACLE_SQL["gold_validate"] = f"""WITH {LINEITEM_FACT_CTES},
dim AS (SELECT DISTINCT city, country, latitude, longitude FROM silver)
SELECT 'fact_booking' AS view_name, true AS view_exists, (SELECT count(*) FROM (SELECT 1 FROM fact LIMIT 1)) AS probe_rows
UNION ALL
SELECT 'dim_city', true, (SELECT count(*) FROM (SELECT 1 FROM dim LIMIT 1))
UNION ALL
SELECT 'kpi_revenue', true, (SELECT count(*) FROM (SELECT 1 FROM kpi LIMIT 1))"""

ORACLE_SQL["bi_count_by_dim"] = """
WITH f AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS booking_id, n_name AS city
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
d AS (SELECT DISTINCT n_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT city, count(booking_id) AS booking_count
FROM f WHERE city IN (SELECT city FROM d WHERE city IS NOT NULL)
GROUP BY city
HAVING count(booking_id) > 0"""

ORACLE_SQL["gold_views"] = f"""WITH {LINEITEM_FACT_CTES},
dim AS (SELECT DISTINCT city, country, latitude, longitude FROM silver),
cities AS (SELECT city, count(*) AS city_rows FROM dim GROUP BY city)
SELECT * FROM fact JOIN cities USING (city) JOIN kpi USING (hotel_name)"""

ORACLE_SQL["bi_count_unknown"] = """
WITH f AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS booking_id, n_name,
         CASE WHEN n_regionkey < 3 THEN n_name END AS city
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT city, count(booking_id) AS booking_count
FROM f GROUP BY city
HAVING count(booking_id) > 0"""

ORACLE_SQL["bi_implicit_totals"] = f"""WITH {LINEITEM_FACT_CTES}
SELECT CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(SUM(total_bookings) AS BIGINT) AS total_bookings
FROM kpi"""

ORACLE_SQL["latest_n"] = "SELECT * FROM events ORDER BY ts DESC NULLS LAST, event_id LIMIT 15"

ORACLE_SQL["sample_preview"] = """
SELECT count(*) AS preview_rows, count(*) AS different_rows, count(*) AS found_rows FROM (SELECT 1 FROM events LIMIT 10)"""
