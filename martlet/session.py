"""Session defaults. A cluster passes its own session; these are for local runs and tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# The folder of this process for local sessions that name none; Spark refuses to set the key once a session runs.
_fallback: str | None = None


def local_session(cpus: int | None = None, app: str = "martlet", shared: str | None = None) -> SparkSession:
    """A session on this machine; `shared` becomes its ``spark.checkpoint.dir``, in place of what Spark's own settings name."""
    cpus = cpus or os.cpu_count() or 4
    builder = SparkSession.builder
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared).config("spark.sql.warehouse.dir", f"{shared}/warehouse")
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording a call site for every column costs more than planning does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master, where all executors share one disk, may fall back to a
    temporary folder (one per process); anywhere else a missing setting is an error.
    """
    global _fallback
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _fallback is None:
        _fallback = tempfile.mkdtemp(prefix="martlet-")
    return _fallback
