"""Spark session defaults and the shared scratch location.

Everything that has to be written between stages (checkpoints, streaming
state, per-batch counter deltas, replaced day tables in tests) goes under the
directory the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is absent (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def session_defaults(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings we rely on.  AQE re-plans joins and coalesces shuffle output;
    skew-join splitting covers a hot key that holds a large share of rows."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Day partitions are strings such as 20190130: never infer them as ints.
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def scale_settings(shuffle_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a job that shuffles about ``shuffle_bytes`` on ``total_cores``.

    Start with enough shuffle partitions that each holds ~``partition_bytes``
    (and at least three waves of tasks); AQE coalesces the small ones and
    splits any partition over twice the target that is also 4x the median
    (a hot key).  Scan splits use the same size so a task's input fits its
    share of executor memory and spills instead of failing.
    """
    n = max(total_cores * 3, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def get_session(master: str | None = None, app: str = "loglark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**session_defaults(shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    Read from ``spark.checkpoint.dir``; if unset and the master is local
    (tests) create a private directory once per session and register it as
    checkpoint dir.  On a cluster an unset setting is an error.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - not set
            root = None
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        # executors cannot see a driver-local folder: the cluster must name a shared one
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOT:
        _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="loglark-")
        spark.sparkContext.setCheckpointDir(os.path.join(_LOCAL_ROOT[key], "rdd-checkpoints"))
    return _LOCAL_ROOT[key]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: point it at the shared root."""
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root + "/rdd-checkpoints")


def new_scratch(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused sub-folder of the shared root."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted when it ends, not when the driver
    happens to collect garbage: a chain of written steps then holds one step's files."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
