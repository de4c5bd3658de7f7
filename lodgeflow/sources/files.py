"""Batch sources (SRC-1, SRC-2, SRC-8) and load metadata (PRJ-1)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodgeflow.constants import BATCH_SOURCE_NAME, RAW_BOOKING_COLUMNS
from lodgeflow.session import is_path

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def string_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


RAW_BOOKING_SCHEMA = string_schema(RAW_BOOKING_COLUMNS)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             multi_line: bool = True, spread_to: int | None = None) -> DataFrame:
    """CSV with a header row, quoted multi-line fields, ``"`` as quote and
    escape, padding dropped; every column is text.

    Without ``schema`` the names come from the header (every column still
    text: no inference pass over the data).  A multi-line CSV file cannot be
    split, so one file is one task: land many files, or

    * ``multi_line=False`` when the producer guarantees no newline inside a
      quoted field: every file is then split into blocks;
    * ``spread_to=n`` to rebalance the parsed rows over ``n`` partitions
      right after the scan (when the scan yields fewer), so a single huge
      file costs one parsing task but not one task for everything after it.
    """
    options = dict(CSV_OPTIONS, multiLine="true" if multi_line else "false")
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if spread_to:
        try:
            if df.rdd.getNumPartitions() < spread_to:
                df = df.repartition(spread_to)
        except Exception:  # no RDD view (remote session): leave the scan as is
            pass
    return df


def add_load_metadata(df: DataFrame, source: str | None = BATCH_SOURCE_NAME,
                      ts_col: str = "ingestion_timestamp", source_col: str = "source_bron") -> DataFrame:
    cols = {ts_col: F.current_timestamp()}
    if source is not None:
        cols[source_col] = F.lit(source)
    return df.withColumns(cols)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``db.table`` or ``catalog.db.table``) or a path."""
    if is_path(name_or_path):
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def read_table_if_exists(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when it does not exist (catalog names are checked
    with ``catalog.tableExists``).  Used for optional reference tables such as exchange rates."""
    if not is_path(name_or_path):
        return spark.read.table(name_or_path) if spark.catalog.tableExists(name_or_path) else None
    return read_path_if_exists(spark, name_or_path, fmt)


#: Error conditions of a path that is absent or holds no file.
MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_path_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The folder's rows, or None when it is absent or holds no file; every
    other error is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in MISSING:
            return None
        raise
