"""Session helpers: session settings, the shared work folder and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def build_session(app: str = "helixtab", cores: int | str = "*") -> SparkSession:
    """A local session with the settings the library is tuned for.

    On a cluster the session comes from spark-submit; nothing here is required by the operators.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of column expressions are not recorded: they slow the building of long rule lists
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("HELIXTAB_SHUFFLE", "8"))
        .config("spark.driver.memory", os.environ.get("HELIXTAB_DRIVER_MEM", "12g"))
        .config("spark.checkpoint.dir", os.environ.get("HELIXTAB_WORK") or tempfile.mkdtemp(prefix="helixtab-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the folder the session names in ``spark.checkpoint.dir``; ``build_session`` names one.  Only a
    foreign local session without the setting, where driver and executors share one disk, gets a fresh
    temporary folder; a cluster session raises.
    """
    root = spark.conf.get(_CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="helixtab-")
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the work folder that no other run uses."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back, so that every later use sees the same rows.

    This cuts the lineage at a written table: a lost executor re-reads files instead of
    recomputing, and partition-dependent columns keep the value they were written with.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores when the input has fewer splits than that.

    For work that is heavy per row on input that comes in few files; a large table has splits enough
    and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
