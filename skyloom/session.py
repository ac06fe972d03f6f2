"""Session helpers: settings for local runs and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "skyloom") -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a temporary folder, on a local master only."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="skyloom-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables written between two steps."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
