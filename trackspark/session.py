"""Session settings the jobs rely on."""

from __future__ import annotations

import re
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that may be changed on a live session. They fix meaning (zone, ANSI casts) and let
# the runtime re-plan: coalesce small shuffles, split skewed join partitions, pick broadcast
# sides by measured size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
}
# Fixed at start: do not record a Python call site for every column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "trackspark", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``master`` only for local runs, a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    A temporary folder is made only where nothing is set (tests, local mode).
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not re.match(r"local(\[|$)", context.master):  # local-cluster is a cluster
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = Path(tempfile.mkdtemp(prefix="run-")).as_uri()
    context.setCheckpointDir(made)
    return made
