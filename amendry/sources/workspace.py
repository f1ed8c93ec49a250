"""Staged tables in the folder every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}  # by application, where the setting is missing


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which every executor can reach.

    A session of one process that lacks the setting, as in tests, gets a folder of its own.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="run-"))


class Workspace:
    """One run's own area of the shared folder. A staged table cuts lineage and outlives executors."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_folder(spark)}/amendry-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        """Create the staging table, or replace all rows it holds, and read it back."""
        schema = df.schema
        df.write.mode("overwrite").parquet(self.path(name), compression=codec)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def append(self, df: DataFrame, name: str) -> DataFrame:
        """Add rows, creating the table if absent, and read all of it."""
        schema = df.schema
        df.write.mode("append").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))
