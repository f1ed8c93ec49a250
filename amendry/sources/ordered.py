"""Tables kept in order: sorted files, their first and last keys, and a check that the order holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amendry.operators.order import Order, sorted_rows


def write_sorted(df: DataFrame, order: Order, path: str) -> None:
    """Write the rows in the order. File names ascend with the order, rows of a file follow it."""
    sorted_rows(df, order).write.parquet(path)


def _before(order: Order, left: str, right: str) -> Column:
    """Whether the key in struct column `left` comes strictly before that in `right`; NULL ranks highest."""
    before = F.lit(False)
    for name, down in reversed(order):
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        up = F.when(a.isNull(), F.lit(False)).when(b.isNull(), F.lit(True)).otherwise(a < b)
        over = F.when(b.isNull(), F.lit(False)).when(a.isNull(), F.lit(True)).otherwise(a > b)
        before = (over if down else up) | (a.eqNullSafe(b) & before)
    return before


def file_ranges(spark: SparkSession, path: str, order: Order) -> DataFrame:
    """One row per file: its name, rows, first and last key, and how many rows come before the one above them.

    A row meets the one above it by its place in the file, so no file is sorted again.
    """
    key = F.struct(*[F.col(k.name) for k in order]).alias("key")
    rows = spark.read.parquet(path).select(key, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    above = rows.select(F.col("file").alias("file_above"), (F.col("at") + 1).alias("at_above"), F.col("key").alias("above"))
    met = rows.join(above, (F.col("file") == F.col("file_above")) & (F.col("at") == F.col("at_above")), "left")
    wrong = F.count_if(F.col("above").isNotNull() & _before(order, "key", "above"))
    return met.groupBy("file").agg(
        F.count("*").alias("rows"), F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"), wrong.alias("wrong")
    )


def violations(ranges: DataFrame, order: Order) -> DataFrame:
    """Files whose rows are out of order, or that begin before an earlier file ends. The window sees one row per file."""
    previous = F.lag("last").over(Window.orderBy("file")).alias("ended")
    met = ranges.select("*", previous)
    return met.filter((F.col("wrong") > 0) | (F.col("ended").isNotNull() & _before(order, "first", "ended"))).drop("ended")
