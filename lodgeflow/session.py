"""Session defaults and the shared working folder.

Every operator in the package is a plain ``DataFrame -> DataFrame`` function, so
nothing here is required to use them.  ``get_session`` only bundles the settings
the jobs are tuned for (ANSI on, UTC, AQE with skew handling) and ``shared_dir``
gives jobs a place for intermediate tables and stream checkpoints that every
executor can see.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs assume.  Shuffle partitions are left to the caller: on a
# cluster size them so one partition is ~128-256 MB after AQE coalescing.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster (~1000 executors, inputs of ~100 TB).  Input
# splits of 256 MB; many shuffle partitions that AQE coalesces towards 256 MB
# each (so a stage neither spills nor produces tiny tasks); skewed partitions
# over 1 GB (5x the median) are split; joins switch to broadcast at run time
# only below 64 MB of actual shuffle output.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def get_session(master: str | None = None, app_name: str = "lodgeflow",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                cluster: bool = False) -> SparkSession:
    """A session with ``DEFAULT_CONF`` (and ``CLUSTER_CONF`` when ``cluster``)
    filled in under whatever the submitter already set (``spark-submit
    --conf``, spark-defaults); explicit arguments (``shuffle_partitions``,
    ``extra``) override both.  The web UI stays off."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
        present = {k for k, _ in spark.sparkContext.getConf().getAll()}
    except Exception:  # remote session: leave its configuration alone
        return spark
    defaults = dict(DEFAULT_CONF)
    if cluster:
        defaults.update(CLUSTER_CONF)
    for k, v in defaults.items():  # all runtime SQL settings
        if k not in present and k != "spark.ui.enabled":
            spark.conf.set(k, v)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Run what is inside with ``key`` set in the session, whose own setting is put back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Run (or start, if a stream) what is inside without whole-stage codegen.

    The clean-up of a booking is one projection of some twenty text expressions.
    Whole-stage codegen puts it into a single method that is larger than the JVM
    compiles (8,000 bytes), so it runs interpreted; a plain projection is
    generated as many small methods.  The session's own setting is put back."""
    with setting(spark, "spark.sql.codegen.wholeStage", "false"):
        yield


@contextmanager
def drop_shuffles(spark: SparkSession) -> Iterator[None]:
    """Run (or start, if a stream) what is inside with each job's shuffle files
    deleted as soon as the job ends.

    Else they lie on disk until the driver's JVM happens to collect the plan, so
    those of several large jobs add up.  A write reads its shuffles once; an
    action that is run again on the same plan would have to make them anew.  The
    session's own setting is put back."""
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def is_path(target: str) -> bool:
    """A folder or URI (``/lake/t``, ``s3a://b/t``) rather than a catalog
    table name (``db.table``)."""
    return "/" in target or ":" in target


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session.  Only on a local master (tests) is a private folder
    created and registered where nothing is configured, so that
    ``DataFrame.checkpoint`` and our own tables land in the same place; on a
    cluster no machine's own folder would do, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no context handle (remote session): configuration only
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master or 'the cluster'} share")
        configured = tempfile.mkdtemp(prefix="lodgeflow-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A sub-folder of the shared checkpoint folder for one job's tables."""
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return os.path.join(checkpoint_root(spark), "lodgeflow", leaf)


def shared_database(spark: SparkSession, name: str) -> str:
    """A database of its own for one job's tables, in the shared folder."""
    leaf = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {leaf} LOCATION '{shared_dir(spark, leaf, unique=False)}'")
    return leaf
