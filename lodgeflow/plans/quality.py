"""Validate and publish (JOB-3, SNK-4, SNK-5, SNK-6)."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.operators.quality import Check, QualityGateError, blocking_suite, evaluate
from lodgeflow.sinks.tables import overwrite, write_report_json


REPORT_SCHEMA = ("evaluation_parameters struct<total_records: long>, "
                 "results array<struct<name: string, fail_count: long>>, success boolean")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A written report, a row per check: ``check_name, fail_count,
    total_records, success`` (of the whole suite)."""
    return spark.read.schema(REPORT_SCHEMA).json(path).select(
        F.inline("results").alias("check_name", "fail_count"),
        F.col("evaluation_parameters.total_records").alias("total_records"), "success")


def validate_and_publish(spark: SparkSession, silver: DataFrame, target: str,
                         suite: Callable[[DataFrame], Sequence[Check]] = blocking_suite,
                         on_fail: str = "raise", report_path: str | None = None) -> dict:
    """Run the suite as one job; publish ``silver`` to ``target`` only if every
    check passes.  On failure: ``raise`` stops the run, ``warn`` returns the
    report without writing."""
    report = evaluate(silver, suite(silver))
    if report_path:
        write_report_json(spark, report, report_path)
    if report["success"]:
        overwrite(silver, target)
        return report
    failed = [r["name"] for r in report["results"] if r["fail_count"] > 0]
    msg = f"QUALITY FAILED: {', '.join(failed)}"
    if on_fail == "raise":
        raise QualityGateError(msg)
    warnings.warn(msg)
    return report
