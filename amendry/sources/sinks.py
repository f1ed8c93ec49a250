"""Insert-select, literal rows, archive and reject log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amendry.functions.dates import on_day
from amendry.operators.order import descending, sorted_rows
from amendry.operators.rejects import COLUMNS
from amendry.sources.publish import published


def shaped(df: DataFrame, like: DataFrame) -> DataFrame:
    """df with the columns and types of `like`; columns it does not supply are NULL."""
    unknown = set(df.columns) - set(like.columns)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def insert_select(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Target plus the selected rows, of which only some columns need be given."""
    return target.unionByName(shaped(rows, target))


def insert_values(spark: SparkSession, target: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """Target plus literal rows."""
    fields = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    literal = spark.createDataFrame(rows, ", ".join(f"{n} {fields[n]}" for n in names))
    return insert_select(target, literal)


def archive_rows(members: DataFrame) -> DataFrame:
    """The rows to keep: those a correction stamped."""
    return members.filter(F.col("dateModif").isNotNull())


def dated(rejects: DataFrame, day: date) -> DataFrame:
    """Log rows with the day they belong to."""
    return rejects.select(F.lit(day).alias("log_date"), *COLUMNS)


def read_log(spark: SparkSession, root: str, day: date) -> DataFrame | None:
    """What jobs logged on one day, from the published log; the folders of other days are not read."""
    log = published(spark, root, "log")
    return None if log is None else log.filter(F.col("log_date") == F.lit(day)).select(*COLUMNS)


def log_of_day(log: DataFrame, stamp: str, day: date) -> DataFrame:
    """Log rows of a day, latest first."""
    return sorted_rows(log.filter(on_day(F.col(stamp), day)), descending(stamp))
