"""Key checks and the exactly-one check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.operators.joins import Keys, without_match


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Primary-key violations: keys carried by more than one row, with the row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(df: DataFrame, ref: DataFrame, keys: Keys) -> DataFrame:
    """Foreign-key violations: rows whose (non-NULL) key is absent from ref."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k, _ in keys])
    return without_match(df.filter(present), ref, keys)


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """NOT NULL violations per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "n_null")


def exactly_one(df: DataFrame, condition: Column, by: list[str]) -> DataFrame:
    """Per key, the number of rows meeting the condition and whether it is one."""
    n = F.count_if(condition)
    return df.groupBy(*by).agg(n.alias("n"), (n == 1).alias("ok"))
