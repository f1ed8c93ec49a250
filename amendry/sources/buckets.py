"""Tables stored in buckets of a key, and joins that keep them where they are.

Rows are hashed into buckets when they are written, so that later joins and groupings on the key
need no exchange of the table. A bucket is read by one task; keys with more rows than
a task should read are therefore kept apart, in files of their own without buckets. They
meet their few partners in a broadcast, which is as large as there are such keys.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amendry.sources.workspace import Workspace

HOT_ROWS = 1 << 22  # rows of a key beyond which it is kept apart
SETTINGS = "key string, buckets int"


class Bucketed(NamedTuple):
    """A stored table: rows in buckets of the key, rows of hot keys, and these keys, each once."""

    key: str
    cold: DataFrame
    hot: DataFrame
    hot_keys: DataFrame


def write_bucketed(df: DataFrame, key: str, buckets: int, folder: str, hot_rows: int = HOT_ROWS) -> None:
    """Store a table by `key`. A null key has no bucket worth the name and is kept apart like a hot one."""
    spark = df.sparkSession
    counted = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n"))
    hot = counted.filter((F.col("n") > hot_rows) | F.col("_hot").isNull()).select("_hot")
    hot.write.parquet(f"{folder}/hot_keys")  # at most one key for each hot_rows rows, and null
    hot = F.broadcast(spark.read.schema(hot.schema).parquet(f"{folder}/hot_keys"))
    same = F.col(key).eqNullSafe(F.col("_hot"))
    df.join(hot, same, "left_semi").write.parquet(f"{folder}/hot")
    name = _name(folder)
    cold = df.join(hot, same, "left_anti").repartition(buckets, key)
    cold.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/cold").saveAsTable(name)
    spark.createDataFrame([(key, buckets)], SETTINGS).coalesce(1).write.parquet(f"{folder}/settings")


def _name(folder: str) -> str:
    return f"bucketed_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"


def read_bucketed(spark: SparkSession, folder: str) -> Bucketed:
    """A table stored before, by this session or another one."""
    key, buckets = spark.read.schema(SETTINGS).parquet(f"{folder}/settings").first()
    hot, name = spark.read.parquet(f"{folder}/hot"), _name(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hot.schema)
        clustered = f"clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets"
        spark.sql(f"create table {name} ({columns}) using parquet {clustered} location '{folder}/cold'")
    return Bucketed(key, spark.table(name), hot, spark.read.parquet(f"{folder}/hot_keys"))


def bucketed_join(left: Bucketed, right: DataFrame | Bucketed, right_key: str, how: str = "left") -> DataFrame:
    """Join a stored table to one that has at most one row per key, which is dropped; inner or left.

    The stored rows are not exchanged. The other side is, unless it is stored in as many
    buckets of its key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left: {how!r}")
    # of one row per key, none is hot; rows of a null key match nothing
    partner = (right.cold if isinstance(right, Bucketed) else right).withColumnRenamed(right_key, "_right")
    cold = left.cold.join(partner, F.col(left.key) == F.col("_right"), how)
    few = partner.join(F.broadcast(left.hot_keys), F.col("_right") == F.col("_hot"), "left_semi")
    hot = left.hot.join(F.broadcast(few), F.col(left.key) == F.col("_right"), how)
    return cold.unionByName(hot).drop("_right")
