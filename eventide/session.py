"""Sessions for local work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one only in local sessions that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="eventide-")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local(cores: int | str = "*", partitions: int = 8, memory: str = "4g", checkpoint: str | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("eventide")
    conf = {
        "spark.sql.shuffle.partitions": str(partitions), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.ansi.enabled": "true",
        "spark.driver.memory": memory, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    }
    if checkpoint:
        conf["spark.checkpoint.dir"] = checkpoint
    session = builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
