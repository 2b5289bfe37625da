"""Session helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def session(name: str = "tabulon", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; cluster settings come from spark-submit or conf."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound what goes to Python workers at once by bytes: batches by the default bound take some 200 MB on each side where texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it; a cluster installs it or takes --py-files."""
    small_batches(spark)
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, spark.checkpoint.dir; on one machine one of our own where it is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='tabulon-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"
