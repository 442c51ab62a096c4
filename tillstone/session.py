"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: list[tempfile.TemporaryDirectory] = []


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; anything in ``conf`` wins.

    AQE sizes and splits shuffle partitions at run time, so nothing below
    depends on the number of executors.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Datasets of a run are loaded side by side, each in a pool of its own.
        .config("spark.scheduler.mode", "FAIR")
        # Recording the Python line of every expression doubles the time to build wide projections.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session, whose executors all live on this machine, may fall
    back to a temporary folder; that choice is stored in the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    holder = tempfile.TemporaryDirectory(prefix="tillstone-")
    _local_roots.append(holder)
    spark.conf.set("spark.checkpoint.dir", holder.name)
    return holder.name


def new_workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused sub-folder of the shared folder."""
    return f"{shared_root(spark)}/tillstone/{purpose}-{uuid.uuid4().hex}"
