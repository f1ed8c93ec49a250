"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(name: str = "amendry", cores: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark (a cluster brings its own).

    The folder for staged tables is set here, as a cluster's configuration would.
    """
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    shared = os.environ.get("SHARED_FOLDER") or tempfile.mkdtemp(prefix="run-")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
