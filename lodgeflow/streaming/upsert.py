"""Insert-only upsert of a stream into a keyed table (SNK-3, JOI-4, AGG-10,
STR-1..6, JOB-2).

Per micro-batch ``N`` of stream ``S``:

1. keep one row per key inside the batch (total order, so two new rows with
   one key insert once);
2. drop rows whose key is already in the target, ignoring the partition this
   same batch may have written in an earlier, failed attempt;
3. write the rest as partition ``_load_id = S-N`` with dynamic partition
   overwrite.

A retried batch therefore replaces its own partition instead of appending
again, and the whole thing keeps no streaming state.  The stream id lives
inside the checkpoint folder: a new checkpoint gets a new id, so replaying a
source under a fresh checkpoint cannot overwrite older batches.  Assumes one
writer per target.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lodgeflow.operators.dedup import dedup_by_key
from lodgeflow.session import is_path
from lodgeflow.sinks.tables import key_bloom_options
from lodgeflow.sources.files import MISSING, read_path_if_exists

LOAD_COL = "_load_id"


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    """The target (a parquet folder or a catalog table), or None if absent."""
    if not is_path(target):
        return spark.read.table(target) if spark.catalog.tableExists(target) else None
    return read_path_if_exists(spark, target)


def write_load(df: DataFrame, target: str, exists: bool, options: dict | None = None) -> None:
    """Replace the ``_load_id`` partitions present in ``df`` and nothing else."""
    w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**(options or {})))
    if is_path(target):
        w.partitionBy(LOAD_COL).parquet(target)
    elif exists:
        # an insert takes the mode from the session alone
        conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            w.insertInto(target)  # by position: ``df`` follows the table's column order
        finally:
            conf.set(mode, before)
    else:
        w.partitionBy(LOAD_COL).format("parquet").saveAsTable(target)


def align_to(df: DataFrame, target: DataFrame) -> DataFrame:
    """Target's columns in target order; absent ones null, extra ones dropped."""
    have = set(df.columns)
    cols = []
    for f in target.schema.fields:
        if f.name == LOAD_COL:
            continue
        if f.name in have:
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def key_range(fresh: DataFrame, key: str) -> Column | None:
    """``key`` between its smallest and largest value in ``fresh``, as literals
    (a scalar subquery would not reach the parquet scan), or None where no
    value is there or the type does not survive the way exactly.  Timestamps
    go as microseconds, so no time zone has a say."""
    kind = fresh.schema[key].dataType
    if isinstance(kind, T.TimestampType):
        plain, typed = F.unix_micros(key), F.timestamp_micros
    elif isinstance(kind, (T.StringType, T.IntegralType, T.DateType)):
        plain, typed = F.col(key), lambda x: x
    else:
        return None
    low, high = fresh.agg(F.min(plain), F.max(plain)).first()
    return None if low is None else F.col(key).between(typed(F.lit(low)), typed(F.lit(high)))


def known_keys(current: DataFrame, fresh: DataFrame, keys: Sequence[str], prune_by_key_range: bool = True) -> DataFrame:
    """Keys of ``fresh`` that ``current`` holds.

    Only the key columns are read, and only in the range of the first key in
    ``fresh``, which skips row groups (silver files are sorted by key, see
    ``write_silver``).  The join strategy is left to the measured sizes."""
    held = current.select(*keys)
    inside = key_range(fresh, keys[0]) if prune_by_key_range else None
    if inside is not None:
        held = held.where(inside)
    return held.join(fresh.select(*keys), keys, "left_semi").distinct()


def insert_new_rows(batch: DataFrame, target: str, keys: str | Sequence[str], load_id: str,
                    order_by: Sequence[Column] | None = None, prune_by_key_range: bool = True,
                    bloom_keys: int = 50_000) -> None:
    """Insert the rows of ``batch`` whose key is not yet in ``target`` (one
    row per key, first in ``order_by``) as load ``load_id``; rows with a
    known key are left untouched.  Calling it again with the same
    ``load_id`` replaces that load instead of adding to it.  ``bloom_keys``
    sizes the bloom filter on the key in each written row group."""
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    fresh = dedup_by_key(batch, keys, order_by).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        current = read_target(spark, target)
        if current is not None:
            if fresh.count() == 0:  # a replay, say: no need to read the target
                return
            others = current.where(F.col(LOAD_COL) != F.lit(load_id))
            hit = known_keys(others, fresh, keys, prune_by_key_range)
            out = align_to(fresh.join(hit, keys, "left_anti"), current)
        else:
            out = fresh
        # sorted by key inside each file: tight row-group min/max statistics,
        # so the key range above skips most of the target
        write_load(out.withColumn(LOAD_COL, F.lit(load_id)).sortWithinPartitions(LOAD_COL, *keys),
                   target, current is not None, key_bloom_options(keys[0], ndv=bloom_keys))
    finally:
        fresh.unpersist()


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """A stable id for the query owning ``checkpoint`` (kept inside it)."""
    path = checkpoint.rstrip("/") + "/lodgeflow_stream_id"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        sid = uuid.uuid4().hex[:16]
        spark.createDataFrame([(sid,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return spark.read.text(path).first()[0]


def unmatched_sql(target: str, keys: str | Sequence[str], batch_view: str = "updates") -> str:
    """SQL for the rows of the micro-batch view whose key the target (a table
    of the catalog) does not hold: the WHEN NOT MATCHED half of a merge.  What
    an earlier attempt of the same load wrote doesn't count as held."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    on = " AND ".join(f"t.`{k}` = u.`{k}`" for k in keys)
    return f"SELECT u.* FROM {batch_view} AS u LEFT ANTI JOIN {target} AS t ON {on} AND t.{LOAD_COL} <> :load_id"


def start_upsert(stream: DataFrame, target: str, checkpoint: str, keys: str | Sequence[str],
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 order_by: Sequence[Column] | None = None,
                 available_now: bool = True, batch_view: str | None = "updates",
                 batch_sql: str | None = None) -> StreamingQuery:
    """Start the upsert.  ``transform`` runs on each micro-batch as a static
    DataFrame (for example enrichment that re-reads reference tables).  The
    micro-batch is also registered as temporary view ``batch_view`` so SQL
    run from ``transform`` can refer to it.

    ``batch_sql`` is a query over that view, run in the micro-batch's own
    session after ``transform`` (whose result the view then shows); only its
    rows are inserted.  It may use ``:load_id``."""
    spark = stream.sparkSession
    sid = stream_identity(spark, checkpoint)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{sid}-{batch_id:012d}"
        if batch_view:
            batch.createOrReplaceTempView(batch_view)
        df = transform(batch) if transform else batch
        if batch_sql:
            df.createOrReplaceTempView(batch_view)
            df = batch.sparkSession.sql(batch_sql, args={"load_id": load_id})
        insert_new_rows(df, target, keys, load_id, order_by)

    w = (stream.writeStream.foreachBatch(each_batch).outputMode("update")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def run_upsert(stream: DataFrame, target: str, checkpoint: str, keys: str | Sequence[str],
               transform: Callable[[DataFrame], DataFrame] | None = None,
               order_by: Sequence[Column] | None = None, batch_view: str | None = "updates",
               batch_sql: str | None = None) -> None:
    """Drain the stream into the target and wait for it to finish."""
    q = start_upsert(stream, target, checkpoint, keys, transform, order_by, batch_view=batch_view,
                     batch_sql=batch_sql)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
