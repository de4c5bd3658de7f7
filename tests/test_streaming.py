import os

from pyspark.sql import functions as F

from lodgeflow.plans.silver import bronze_to_silver, stream_to_silver, write_silver
from lodgeflow.sources.files import RAW_BOOKING_SCHEMA
from lodgeflow.streaming.ingest import JSON_TIMESTAMP_OPTIONS, ingest_events, read_event_stream
from lodgeflow.streaming.upsert import LOAD_COL, insert_new_rows, run_upsert

from conftest import BOOKING_COLS, booking_row

SCHEMA = "k string, price int, ts int"


def land(spark, rows, path, schema=SCHEMA, parts=1):
    spark.createDataFrame(rows, schema).coalesce(parts).write.mode("append").json(path)


def target_rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).drop(LOAD_COL).collect())


def test_insert_only_and_batch_dedup(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    seed = spark.createDataFrame([("a", 1, 0)], SCHEMA)
    write_silver(seed, target)
    src = os.path.join(tmp_dir, "src")
    land(spark, [("a", 99, 1), ("b", 5, 2), ("b", 6, 1), ("c", 7, 3)], src)
    stream = read_event_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    run_upsert(stream, target, os.path.join(tmp_dir, "ck"), "k", order_by=[F.col("ts")])
    # a stays untouched, b inserted once (earliest ts), c inserted
    assert target_rows(spark, target) == [("a", 1, 0), ("b", 6, 1), ("c", 7, 3)]


def test_restart_and_replay_add_nothing(spark, tmp_dir):
    target, src = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "src")
    for i in range(3):
        land(spark, [(f"k{j}", j, i) for j in range(i, i + 5)], src)
    schema = spark.createDataFrame([], SCHEMA).schema
    ck = os.path.join(tmp_dir, "ck")
    run_upsert(read_event_stream(spark, src, schema, max_files_per_trigger=1), target, ck, "k",
               order_by=[F.col("ts")])
    first = target_rows(spark, target)
    assert len(first) == 7 and len({r[0] for r in first}) == 7
    # same checkpoint: nothing new to read
    run_upsert(read_event_stream(spark, src, schema), target, ck, "k", order_by=[F.col("ts")])
    assert target_rows(spark, target) == first
    # fresh checkpoint replays the whole source: keys exist, nothing inserted
    run_upsert(read_event_stream(spark, src, schema), target, os.path.join(tmp_dir, "ck2"), "k",
               order_by=[F.col("ts")])
    assert target_rows(spark, target) == first


def test_retried_batch_replaces_its_partition(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    batch = spark.createDataFrame([("x", 1, 0), ("y", 2, 0)], SCHEMA)
    insert_new_rows(batch, target, "k", "s-000000000007")
    insert_new_rows(batch, target, "k", "s-000000000007")  # the same batch again after a failure
    assert target_rows(spark, target) == [("x", 1, 0), ("y", 2, 0)]
    insert_new_rows(batch, target, "k", "s-000000000008")  # a later batch with the same keys
    assert target_rows(spark, target) == [("x", 1, 0), ("y", 2, 0)]


def test_stream_aligns_to_target_schema(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    write_silver(spark.createDataFrame([("a", 1, 0, "z")], SCHEMA + ", extra string"), target)
    insert_new_rows(spark.createDataFrame([("b", 2, 1)], SCHEMA), target, "k", "s-1")
    got = sorted(tuple(r) for r in spark.read.parquet(target).drop(LOAD_COL).collect())
    assert got == [("a", 1, 0, "z"), ("b", 2, 1, None)]


def test_raw_ingest_stream(spark, tmp_dir):
    src, target = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "raw")
    rows = [booking_row(booking_id=f"B{i}") for i in range(5)]
    df = spark.createDataFrame([tuple(r[c] for c in BOOKING_COLS) for r in rows],
                               ", ".join(f"{c} string" for c in BOOKING_COLS))
    df.write.json(src)
    ingest_events(spark, src, target, os.path.join(tmp_dir, "ck"))
    ingest_events(spark, src, target, os.path.join(tmp_dir, "ck"))  # restart: no duplicates
    out = spark.read.parquet(target)
    assert out.count() == 5 and len(out.columns) == len(RAW_BOOKING_SCHEMA.fields)


def test_batch_and_stream_give_the_same_silver(spark, tmp_dir, bookings):
    rows = [booking_row(booking_id="B1", hotel_name=" GRAND!! hotel. ", total_price="200"),
            booking_row(booking_id="B1", hotel_name="other", total_price="100"),
            booking_row(booking_id="B2", star_rating="6"),
            booking_row(booking_id="B3", hotel_id=None),
            booking_row(booking_id="B4", country_customer="germany", latitude="91")]
    raw = bookings(rows)
    batch = bronze_to_silver(raw).drop("silver_processed_at")
    src = os.path.join(tmp_dir, "src")
    raw.write.json(src)
    target = os.path.join(tmp_dir, "silver")
    stream = read_event_stream(spark, src, raw.schema)
    stream_to_silver(stream, target, os.path.join(tmp_dir, "ck"))
    streamed = spark.read.parquet(target).drop("silver_processed_at", LOAD_COL)
    norm = lambda df: sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert norm(batch) == norm(streamed)
    assert sorted(r[0] for r in streamed.select("booking_id").collect()) == ["B1", "B4"]


def test_key_range_prunes_target_scan(spark, tmp_dir):
    """Silver files are sorted by key, so the batch's key range skips row groups."""
    from lodgeflow.streaming.upsert import known_keys
    target = os.path.join(tmp_dir, "t")
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        base = spark.range(200_000).select(F.format_string("%09d", "id").alias("booking_id")).repartition(4)
        write_silver(base, target)
    finally:
        spark.conf.unset("parquet.block.size")
    batch = spark.range(199_990, 200_010).select(F.format_string("%09d", "id").alias("booking_id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as planned holds the scan's figures
    try:
        hit = known_keys(spark.read.parquet(target), batch, ["booking_id"])
        assert len(hit.collect()) == 10
        leaves = hit._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    scans = [x for x in (leaves.apply(k) for k in range(leaves.size())) if "parquet" in x.nodeName()]
    assert len(scans) == 1
    read = scans[0].metrics().apply("numOutputRows").value()
    assert read < 200_000 // 4  # far fewer rows than the target holds
    insert_new_rows(batch.withColumn("v", F.lit(1)), target, "booking_id", "s-1")
    assert spark.read.parquet(target).count() == 200_010


def test_timestamp_keys_in_a_repeated_hour_insert_once(spark, tmp_dir):
    """Keys stay typed values of the plan: the driver's time zone, whose clock
    goes back at 06:00 UTC, changes nothing."""
    import time
    target, before = os.path.join(tmp_dir, "t"), os.environ.get("TZ")
    row = spark.sql("SELECT TIMESTAMP '2024-11-03 06:30:00' AS k, 1 AS v")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        insert_new_rows(row, target, "k", "s-1")
        insert_new_rows(row.withColumn("v", F.lit(2)), target, "k", "s-2")
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert [r["v"] for r in spark.read.parquet(target).collect()] == [1]


def test_crash_after_write_before_commit_is_replayed_cleanly(spark, tmp_dir):
    """Batch 0 wrote its partition, then the driver died before the batch was
    committed: the restarted query replays batch 0 and overwrites that
    partition instead of inserting the rows twice."""
    from lodgeflow.streaming.upsert import stream_identity
    target, src, ck = (os.path.join(tmp_dir, n) for n in ("t", "src", "ck"))
    land(spark, [("a", 1, 0), ("b", 2, 0)], src)
    sid = stream_identity(spark, ck)
    # the half-finished first attempt of batch 0
    insert_new_rows(spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], SCHEMA), target, "k", f"{sid}-{0:012d}")
    schema = spark.createDataFrame([], SCHEMA).schema
    run_upsert(read_event_stream(spark, src, schema), target, ck, "k", order_by=[F.col("ts")])
    assert target_rows(spark, target) == [("a", 1, 0), ("b", 2, 0)]


def test_failed_batch_is_retried_on_restart(spark, tmp_dir):
    target, src, ck = (os.path.join(tmp_dir, n) for n in ("t", "src", "ck"))
    land(spark, [("a", 1, 0)], src)
    land(spark, [("b", 2, 1)], src)
    schema = spark.createDataFrame([], SCHEMA).schema
    state = {"failed": False}

    def flaky(batch):
        if not state["failed"] and batch.where("k = 'b'").count() > 0:
            state["failed"] = True
            raise RuntimeError("executor lost")
        return batch

    import pytest
    with pytest.raises(Exception):
        run_upsert(read_event_stream(spark, src, schema, max_files_per_trigger=1), target, ck, "k",
                   transform=flaky, order_by=[F.col("ts")])
    assert target_rows(spark, target) == [("a", 1, 0)]
    run_upsert(read_event_stream(spark, src, schema, max_files_per_trigger=1), target, ck, "k",
               transform=flaky, order_by=[F.col("ts")])
    assert target_rows(spark, target) == [("a", 1, 0), ("b", 2, 1)]


def test_observed_metrics_match_the_exact_report(spark, tmp_dir, bookings):
    from lodgeflow.plans.silver import run_bronze_to_silver, silver_metrics
    rows = [booking_row(booking_id="B1"), booking_row(booking_id="B1", total_price="5"),
            booking_row(booking_id="B2", star_rating="9"), booking_row(booking_id="B3", hotel_id=None),
            booking_row(booking_id="B4", country_customer="ATLANTIS")]
    raw = bookings(rows)
    target = os.path.join(tmp_dir, "silver")
    m = run_bronze_to_silver(raw, target)
    exact = silver_metrics(raw).first()
    assert m["dedup"]["rows_before"] == exact["rows_before"] == 5
    assert m["dedup"]["rows_after"] == exact["rows_after_dedup"] == 4
    assert m["filter"]["null_key_rows"] == exact["null_key_rows"] == 1
    assert m["filter"]["rule_failures"] == exact["rule_failures"] == 1
    assert m["filter"]["rows_after"] == exact["rows_after_filter"] == 2
    assert m["lookup"]["filled"] == 3 and m["lookup"]["missing_pct"] == 25.0
    assert m["enrichment"] == {"eur_rate": 1.08, "rate_is_fallback": True, "temperature": 20.0,
                               "temperature_is_fallback": True}
    assert spark.read.parquet(target).count() == 2


def test_ingest_archives_committed_files(spark, tmp_dir):
    src, target, arch = (os.path.join(tmp_dir, n) for n in ("src", "raw", "archive"))
    land(spark, [("a", 1, 0)], src)
    land(spark, [("b", 2, 1)], src)
    schema = spark.createDataFrame([], SCHEMA).schema
    from lodgeflow.streaming.ingest import start_raw_ingest
    for _ in range(2):  # files are archived once a later batch commits
        q = start_raw_ingest(read_event_stream(spark, src, schema, max_files_per_trigger=1, archive_dir=arch),
                             target, os.path.join(tmp_dir, "ck"))
        q.awaitTermination()
    assert spark.read.parquet(target).count() == 2
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".json")]
    assert len(archived) >= 1


def test_upsert_into_catalog_table(spark, tmp_dir):
    """The target may be a catalog table, as in the original (saveAsTable)."""
    name = "silver_upsert_catalog_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_silver(spark.createDataFrame([("a", 1, 0)], SCHEMA), name, keys=["k"])
    src = os.path.join(tmp_dir, "src")
    land(spark, [("a", 9, 1), ("b", 2, 1)], src)
    schema = spark.createDataFrame([], SCHEMA).schema
    ck = os.path.join(tmp_dir, "ck")
    run_upsert(read_event_stream(spark, src, schema), name, ck, "k", order_by=[F.col("ts")])
    run_upsert(read_event_stream(spark, src, schema), name, os.path.join(tmp_dir, "ck2"), "k",
               order_by=[F.col("ts")])  # replay under a new checkpoint
    got = sorted(tuple(r) for r in spark.table(name).drop(LOAD_COL).collect())
    assert got == [("a", 1, 0), ("b", 2, 1)]
    spark.sql(f"DROP TABLE {name}")
    # first load into a table that does not exist yet
    insert_new_rows(spark.createDataFrame([("z", 1, 0)], SCHEMA), name, "k", "s-0")
    assert [r["k"] for r in spark.table(name).collect()] == ["z"]
    spark.sql(f"DROP TABLE {name}")


def test_pushed_keys_skip_row_groups_with_random_ids(spark, tmp_dir):
    """Random ids defeat the key range; the bloom filters written on the key
    let a small batch's key list skip row groups that hold none of its keys."""
    target = os.path.join(tmp_dir, "t")
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        base = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).substr(1, 16).alias("booking_id"))
        write_silver(base.repartition(4), target)
    finally:
        spark.conf.unset("parquet.block.size")
    fresh_keys = [f"new{i:013d}" for i in range(50)]
    batch = spark.createDataFrame([(k,) for k in fresh_keys], "booking_id string")
    scan = spark.read.parquet(target).where(F.col("booking_id").isin(fresh_keys)).select("booking_id")
    assert scan.count() == 0
    scan.collect()
    read = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert read < 200_000 // 10  # nearly every row group skipped by its bloom filter
    insert_new_rows(batch, target, "booking_id", "s-1")
    assert spark.read.parquet(target).count() == 200_050


def test_catalog_retry_replaces_only_its_load(spark):
    """insertInto must honour dynamic partition overwrite: retrying one load
    replaces that load and leaves every other load in place."""
    name = "upsert_retry_catalog_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # the option alone must do it
    try:
        insert_new_rows(spark.createDataFrame([("a", 1, 0)], SCHEMA), name, "k", "s-0")
        insert_new_rows(spark.createDataFrame([("b", 2, 0)], SCHEMA), name, "k", "s-1")
        insert_new_rows(spark.createDataFrame([("b", 2, 0)], SCHEMA), name, "k", "s-1")  # retry
        got = sorted((r["k"], r[LOAD_COL]) for r in spark.table(name).collect())
        assert got == [("a", "s-0"), ("b", "s-1")]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
