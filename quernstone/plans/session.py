"""Sessions for local work.  On a cluster the caller brings its own session and settings."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="quernstone-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def local_session(cores: int | None = None, app: str = "quernstone") -> SparkSession:
    """A local session; adaptive execution is on and shuffles are sized for the cores at hand.

    Intermediate tables go to QUERNSTONE_CHECKPOINTS or a new folder, which is right for one machine only.
    """
    cores = cores or os.cpu_count() or 2
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUERNSTONE_DRIVER_MEMORY", "8g"))
    )
    if SparkSession.getActiveSession() is None:
        builder = builder.config("spark.checkpoint.dir", os.environ.get("QUERNSTONE_CHECKPOINTS") or _own_folder())
    return builder.getOrCreate()
