"""Small helpers that the operators of this subpackage have in common."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgeflow.session import shared_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting by which a query's shuffle files go when the query has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder.

    Everything that later steps read more than once, or that must not be
    computed anew when an executor is lost, goes through here.  Nothing reads
    the shuffle files once the table is there, so they don't stay on disk."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def freed(table: DataFrame) -> None:
    """Give up the rows of a table that ``written`` made and nothing reads any more."""
    table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(table.written_to)


def ship_code(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers (what ``--py-files``
    does), once per Spark context."""
    sc, name = spark.sparkContext, "lodgeflow-llm.zip"
    if name in {os.path.basename(x) for x in sc._python_includes}:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="lodgeflow-code-"), name)  # on the driver; Spark serves it
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    at = os.path.join(folder, n)
                    z.write(at, os.path.relpath(at, os.path.dirname(package)))
    sc.addPyFile(target)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package's code at hand in the workers."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator needs, null texts as empty ones; what else the
    table holds, under whatever name, stays out of the way."""
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"), *more)


def part_offsets(totals: DataFrame, part: str = "part", total: str = "total") -> DataFrame:
    """Second pass of a distributed prefix sum: ``totals`` has one row per
    input partition (so its size follows the number of partitions, not of
    rows), the result holds the sum of all earlier partitions as ``before``."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("long").alias("before"))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo ``n`` (null value: null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def slices(values: list[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` characters each, so that what Python
    holds at a time does not depend on how rows were put into Arrow batches."""
    start = size = 0
    for i, v in enumerate(values):
        size += len(v) + 50
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values)


def ragged(lengths: Iterable[int]) -> np.ndarray:
    """Start offsets (one more than rows) of rows of the given lengths."""
    lengths = np.asarray(lengths, dtype=np.int64)
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
