"""Raw event ingest (SRC-6, SRC-7, SNK-7).

Events are landed as JSON files; the stream reads them with an explicit
all-text schema (no inference, malformed fields become null) and appends them
unchanged to a raw table, a folder or a table of the catalog.  The file sink
commits through its own log, so a restarted query never duplicates a file's
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodgeflow.session import is_path, setting
from lodgeflow.sources.files import RAW_BOOKING_SCHEMA

# Lossless text form of timestamps in landed JSON (the default keeps only
# milliseconds).  Use the same options when landing and when reading.
JSON_TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

#: Row groups of the raw table: small, as its files are few and large.
RAW_ROW_GROUP_BYTES = 16 * 1024 * 1024


def read_event_stream(spark: SparkSession, path: str, schema: StructType = RAW_BOOKING_SCHEMA,
                      fmt: str = "json", max_files_per_trigger: int | None = None,
                      path_glob: str | None = None, options: dict | None = None,
                      archive_dir: str | None = None) -> DataFrame:
    """Landed event files as a stream, with an explicit schema.

    ``max_files_per_trigger`` bounds each micro-batch; ``archive_dir`` moves
    committed files out of the landing folder (the file source's
    ``cleanSource``), so the folder listed on every trigger stays small on a
    long-running stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if fmt == "json":
        reader = reader.options(**JSON_TIMESTAMP_OPTIONS)
    if options:
        reader = reader.options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(path)


def start_raw_ingest(stream: DataFrame, target: str, checkpoint: str,
                     available_now: bool = True, fmt: str = "parquet",
                     files_per_batch: int | None = None) -> StreamingQuery:
    """Append the stream to ``target``.  ``files_per_batch`` bounds the files
    that a micro-batch leaves there (no shuffle): without it large landed files
    become a file per input split, and a reader that takes so many files a
    trigger makes more micro-batches as the input grows."""
    if files_per_batch:
        stream = stream.coalesce(files_per_batch)
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    # row groups by which all cores read what one trigger takes; the file sink
    # hears of them from the session at its start, not from the writer's options
    with setting(stream.sparkSession, "parquet.block.size", str(RAW_ROW_GROUP_BYTES)):
        # a name is a table of the catalog, created on first use; a path is a folder
        return w.start(target) if is_path(target) else w.toTable(target)


def ingest_events(spark: SparkSession, source: str, target: str, checkpoint: str,
                  schema: StructType = RAW_BOOKING_SCHEMA, fmt: str = "json",
                  max_files_per_trigger: int | None = None) -> None:
    """Drain everything landed so far into the raw table, then stop.  A
    micro-batch leaves at most a file per core."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # remote session
        cores = None
    q = start_raw_ingest(read_event_stream(spark, source, schema, fmt, max_files_per_trigger),
                         target, checkpoint, files_per_batch=cores)
    q.awaitTermination()


def read_table_stream(spark: SparkSession, name_or_path: str, schema: StructType | None = None,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the appends of a table (SRC-7): a catalog name or a folder.

    A folder needs its schema; it is taken from the table itself when not
    given (one metadata read, no data scan)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if not is_path(name_or_path):
        return reader.table(name_or_path)
    schema = schema or spark.read.format(fmt).load(name_or_path).schema
    return reader.schema(schema).format(fmt).load(name_or_path)


def dedup_within_watermark(stream: DataFrame, keys, event_time: str, delay: str) -> DataFrame:
    """Streaming de-duplication with bounded state (AGG-10 alternative): a key
    seen again within ``delay`` of event time is dropped; state older than the
    watermark is purged.  ``timestamp_ntz`` columns are cast to ``timestamp``
    (the watermark needs it)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampNTZType
    keys = [keys] if isinstance(keys, str) else list(keys)
    if isinstance(stream.schema[event_time].dataType, TimestampNTZType):
        stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
