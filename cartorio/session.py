"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "cartorio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` keys use ``_`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        # recording the Python call site of every column expression makes plans slow to build
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        # a checkpoint goes once nothing in the session refers to it any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a local session, whose executors are in this
    process; on a cluster they could not read it, so there it is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors reach")
        configured = tempfile.mkdtemp(prefix="cartorio-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
