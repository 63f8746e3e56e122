"""Session helpers: one place for the configs the library assumes."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Defaults sized for local tests; on a cluster these come from the job config.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

BALANCE_BYTES = 256 << 20


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tabflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the session's Python workers, once: the functions that run in tasks are imported
    there, whatever folder the driver was started in (the same as ``--py-files``).  Arrow batches are kept small
    unless the session sets their size itself."""
    sc = spark.sparkContext
    if getattr(sc, "_tabflow_shipped", False):
        return
    # rows are whole texts: batches of the default size are held several times over by every worker
    for key, usual, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
                              ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b")):
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, value)
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tabflow-py-"), "tabflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tabflow", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._tabflow_shipped = True


def balanced(df):
    """Spread an under-partitioned scan over the cluster's cores.

    A small table stored as one Parquet row group is read by one task no
    matter how many splits are planned, and every narrow stage after it
    (joins against broadcast sides, projections, partial aggregates, model
    fits on a persisted copy) inherits that single partition.  When a scan of
    at most ``BALANCE_BYTES`` yields fewer partitions than the default
    parallelism it is round-robin repartitioned (Spark sorts before a
    round-robin exchange, so a retried task gets the same rows).  Larger
    inputs pass through untouched: no extra shuffle, however many cores.
    """
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size <= BALANCE_BYTES and df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the cluster's ``spark.checkpoint.dir``.

    A session that runs in one process (``local[...]``) and names none gets a
    scratch folder of its own; on a cluster a missing setting is an error,
    because a folder of one machine is out of reach for the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tabflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")
