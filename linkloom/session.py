"""Session helpers: a default local session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int = 8, app: str = "linkloom", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reachable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever the driver was started.

    A cluster gets the package by its own means (``--py-files`` or an installed copy).
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine gets a temporary folder; on a cluster that is an
    error, as executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for an intermediate file set."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and read it from there.

    Spark drops the shuffle files of the writing at its end, not at some later collection of the driver's memory.
    """
    shared_dir(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def cut_lineage_placed(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, and what is read back is known to be dealt and sorted as ``df`` is.

    An adaptive plan does not state its partitioning, so this one is made without; it is for steps that need no skew handling.
    """
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut_lineage(df.select("*"))
    finally:
        conf.set("spark.sql.adaptive.enabled", before)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when a small input has fewer partitions than the cluster has cores.

    For plain scans before work that is heavy per row; large inputs are split already and
    pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
