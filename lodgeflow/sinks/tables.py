"""Sinks (SNK-1, SNK-2, SNK-6, SNK-8, SNK-9).

Tables are parquet folders (or catalog tables) written with ``overwrite``:
a failed or retried job rewrites the same output, so reruns are safe.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from lodgeflow.session import is_path


def key_bloom_options(key: str, ndv: int = 200_000) -> dict:
    """Parquet writer options for a bloom filter on ``key`` in every row group,
    sized for ``ndv`` distinct keys per row group (~1 % false positives).
    Point look-ups (``key IN (...)``) then skip row groups without the keys."""
    return {f"parquet.bloom.filter.enabled#{key}": "true",
            f"parquet.bloom.filter.expected.ndv#{key}": str(ndv)}


def overwrite(df: DataFrame, target: str, partition_by: list[str] | None = None,
              fmt: str = "parquet", options: dict | None = None) -> None:
    """Full refresh.  A name without ``/`` is a catalog table."""
    w = df.write.mode("overwrite").format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path(target):
        # replace every partition, whatever the session's overwrite mode is
        w.option("partitionOverwriteMode", "static").save(target)
    else:
        w.option("overwriteSchema", "true").saveAsTable(target)


def replace(spark: SparkSession, df: DataFrame, target: str, partition_by: list[str] | None = None,
            fmt: str = "parquet") -> None:
    """Drop and recreate with the new schema."""
    if not is_path(target):
        spark.sql(f"DROP TABLE IF EXISTS {target}")
    overwrite(df, target, partition_by, fmt)


def write_report_json(spark: SparkSession, report: dict, path: str) -> None:
    """Write a small report dict as one JSON document (a single file)."""
    spark.createDataFrame([(json.dumps(report),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
