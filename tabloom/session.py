"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The JVM interprets methods above 8000 bytes for ever. Parsing expressions fused
    # into one stage exceed that; run operator by operator, they are compiled.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # A Python worker holds a batch and what it makes of it; rows here are whole pages and tables, not numbers.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tabloom-")
    return f"{root.rstrip('/')}/tabloom/{label}-{uuid.uuid4().hex}"
