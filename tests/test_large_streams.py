import glob
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodgeflow.plans import queries, silver
from lodgeflow.session import drop_shuffles
from lodgeflow.streaming import ingest, upsert
from lodgeflow.streaming.ingest import ingest_events
from lodgeflow.streaming.upsert import insert_new_rows

from conftest import booking_row

WHOLE_STAGE = "spark.sql.codegen.wholeStage"


def test_batch_job_computes_the_rules_once_in_small_methods(spark, tmp_dir, bookings, monkeypatch):
    seen = {}

    def spy(df, *args, **kw):
        seen["whole_stage"] = spark.conf.get(WHOLE_STAGE)
        spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
        seen["plan"] = df._jdf.queryExecution().optimizedPlan().toString()
        spark.conf.unset("spark.sql.debug.maxToStringFields")
        return real(df, *args, **kw)

    real = silver.write_silver
    monkeypatch.setattr(silver, "write_silver", spy)
    before = spark.conf.get(WHOLE_STAGE)
    raw = bookings([booking_row(booking_id="B1"), booking_row(booking_id="B1", hotel_name="zz"),
                    booking_row(booking_id="B2", hotel_id=None), booking_row(booking_id="B3", star_rating="6"),
                    booking_row(booking_id="B4", hotel_id=None, adults="x")])
    target = os.path.join(tmp_dir, "silver")
    report = silver.run_bronze_to_silver(raw, target)
    assert seen["whole_stage"] == "false" and spark.conf.get(WHOLE_STAGE) == before
    assert sum("RLIKE(nights" in line for line in seen["plan"].splitlines()) == 1
    assert report["dedup"] == {"rows_before": 5, "rows_removed": 1, "rows_after": 4, "removed_pct": 20.0}
    assert report["filter"] == {"rows_before": 4, "null_key_rows": 2, "rule_failures": 1, "rows_after": 1, "loss_pct": 75.0}
    got = spark.read.parquet(target)
    assert [r["booking_id"] for r in got.collect()] == ["B1"]
    assert not [c for c in got.columns if c.startswith("__")]


def test_stream_job_cleans_in_small_methods(spark, tmp_dir, bookings, monkeypatch):
    seen = []
    monkeypatch.setattr(silver, "run_upsert", lambda *a, **kw: seen.append(spark.conf.get(WHOLE_STAGE)))
    before = spark.conf.get(WHOLE_STAGE)
    raw = bookings([booking_row()])
    src = os.path.join(tmp_dir, "raw")
    raw.write.parquet(src)
    silver.stream_to_silver(spark.readStream.schema(raw.schema).parquet(src), os.path.join(tmp_dir, "t"), tmp_dir)
    assert seen == ["false"] and spark.conf.get(WHOLE_STAGE) == before


def test_large_landed_files_leave_a_file_per_core(spark, tmp_dir):
    rows = spark.range(0, 20000, 1, 1).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    src, target = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    rows.write.json(src)
    conf = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert spark.read.schema(rows.schema).json(src).rdd.getNumPartitions() > 20
        ingest_events(spark, src, target, os.path.join(tmp_dir, "ck"), schema=rows.schema, max_files_per_trigger=3)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{target}/part-*.parquet")) <= spark.sparkContext.defaultParallelism
    got = spark.read.parquet(target)
    assert got.count() == 20000 and got.exceptAll(rows).isEmpty()


def test_a_batch_without_new_rows_does_not_read_the_target(spark, tmp_dir, monkeypatch):
    target, calls = os.path.join(tmp_dir, "t"), []
    real = upsert.known_keys
    monkeypatch.setattr(upsert, "known_keys", lambda *a, **kw: calls.append(1) or real(*a, **kw))
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    insert_new_rows(one, target, "k", "s-0")
    insert_new_rows(one.limit(0), target, "k", "s-1")
    assert not calls
    insert_new_rows(spark.createDataFrame([("a", 2), ("b", 3), (None, 4)], "k string, v int"), target, "k", "s-2")
    assert calls and sorted((r["k"] or "", r["v"]) for r in spark.read.parquet(target).collect()) == [("", 4), ("a", 1), ("b", 3)]


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(found.length()) if (n := found.apply(i).getName()).startswith("shuffle_")}


def left_by(spark, before, seconds=20):
    """Shuffle files that are still there after a while (they are deleted in the background)."""
    end = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def test_a_large_write_leaves_no_shuffle_files(spark, tmp_dir, bookings):
    before, own = shuffle_files(spark), spark.conf.get(CLEAN_UP)
    with drop_shuffles(spark):
        assert spark.conf.get(CLEAN_UP) == "true"
        spark.range(1000).repartition(3, "id").write.parquet(os.path.join(tmp_dir, "t"))
    assert spark.conf.get(CLEAN_UP) == own
    raw = bookings([booking_row(booking_id=f"B{i % 30}") for i in range(60)])
    target = os.path.join(tmp_dir, "silver")
    assert silver.run_bronze_to_silver(raw, target)["dedup"]["rows_removed"] == 30
    assert left_by(spark, before) == set()
    assert spark.read.parquet(os.path.join(tmp_dir, "t")).count() == 1000 and spark.read.parquet(target).count() == 30


def test_stream_job_drops_shuffles(spark, tmp_dir, bookings, monkeypatch):
    seen, own = [], spark.conf.get(CLEAN_UP)
    monkeypatch.setattr(silver, "run_upsert", lambda *a, **kw: seen.append(spark.conf.get(CLEAN_UP)))
    raw = bookings([booking_row()])
    src = os.path.join(tmp_dir, "raw")
    raw.write.parquet(src)
    silver.stream_to_silver(spark.readStream.schema(raw.schema).parquet(src), os.path.join(tmp_dir, "t"), tmp_dir)
    assert seen == ["true"] and spark.conf.get(CLEAN_UP) == own


@pytest.mark.parametrize("named", [False, True])
def test_raw_files_have_small_row_groups(spark, tmp_dir, named, monkeypatch):
    monkeypatch.setattr(ingest, "RAW_ROW_GROUP_BYTES", 64 * 1024)
    rows = spark.range(0, 20000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    src, folder = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    rows.write.json(src)
    own = spark.conf.get("parquet.block.size", None)
    target = folder
    if named:
        target = f"raw_{os.path.basename(tmp_dir).replace('-', '_')}"
        spark.sql(f"CREATE TABLE {target} (v string) USING parquet LOCATION '{folder}'")
    try:
        ingest_events(spark, src, target, os.path.join(tmp_dir, "ck"), schema=rows.schema)
        assert min(pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{folder}/part-*.parquet")) > 4
        assert spark.conf.get("parquet.block.size", None) == own
        got = spark.read.parquet(folder)
        assert got.count() == 20000 and got.exceptAll(rows).isEmpty()
    finally:
        if named:
            spark.sql(f"DROP TABLE {target}")


class Landed(Exception):
    pass


def test_stream_job_lands_compressed_events(spark, tmp_dir, monkeypatch):
    n = 3000
    spark.range(n).selectExpr("id % 2900 AS o_orderkey", "id % 40 AS o_custkey", "substr('OFP', int(id % 3) + 1, 1) AS o_orderstatus",
                              "id * 1.5D AS o_totalprice", "timestamp_ntz '2024-01-01' AS o_orderdate",
                              "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.range(40).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "id % 3 AS c_nationkey",
                               "id * 2.5D AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_dir}/customer.parquet")
    spark.range(3).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{tmp_dir}/nation.parquet")
    spark.range(5).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01' AS ts", "id * 1.0D AS value",
                              "id AS user_id", "'k' AS kind").write.parquet(f"{tmp_dir}/events.parquet")

    def stop(spark, source, *args, **kw):
        raise Landed(source)

    monkeypatch.setattr(queries, "ingest_events", stop)
    with pytest.raises(Landed) as e:
        queries.q_stream_job(spark, tmp_dir)
    raw = queries.dirty_bookings(spark, tmp_dir)
    assert queries.dirty_bookings(spark, tmp_dir, parts=4).exceptAll(raw).isEmpty()
    plain = os.path.join(tmp_dir, "plain")
    raw.write.json(plain)
    size = lambda files: sum(map(os.path.getsize, files))
    for half in ("a", "b"):
        at = str(e.value).removeprefix("file:").replace("*", half)
        files = glob.glob(f"{at}/part-*")
        assert len(files) == 4 and size(files) * 3 < size(glob.glob(f"{plain}/part-*"))
        landed = spark.read.schema(raw.schema).json(at)
        assert landed.count() == n and landed.exceptAll(raw).isEmpty()
        of = (landed.withColumn("file", F.input_file_name()).groupBy("booking_id")
              .agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows")))
        assert of.where("files > 1").isEmpty() and of.where("rows > 1").count() == 100
