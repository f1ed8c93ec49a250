"""Table changes as DataFrame -> DataFrame; the result is written as a new table version."""

from __future__ import annotations

from datetime import datetime
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.functions.dates import clock
from amendry.operators.joins import Keys, guarded_join
from amendry.operators.lookup import OK, checked_lookup


def fill_null(df: DataFrame, col: str, value: Column) -> DataFrame:
    """Fill col where it is NULL; other rows keep theirs."""
    return df.withColumn(col, F.coalesce(F.col(col), value).cast(df.schema[col].dataType))


def merged_changes(changes: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One row per key, with `_conflict` set where its rows ask for different values."""
    differs = [
        f"coalesce(min({c}) <> max({c}), false) or (count({c}) > 0 and count({c}) < count(1))" for c in cols
    ]
    conflict = F.expr(f"({' or '.join(differs)}) as _conflict")
    return changes.groupBy(*keys).agg(conflict, *[F.expr(f"max({c}) as {c}") for c in cols])


def conflicting_changes(changes: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    return merged_changes(changes, keys, cols).filter("_conflict").select(*keys)


def update_keyed(df: DataFrame, changes: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Set cols on every row whose key is in changes; conflicting keys are left as they are."""
    new = merged_changes(changes, keys, cols)
    new = new.selectExpr(*keys, "_conflict", *[f"{c} as _new_{c}" for c in cols])
    joined = guarded_join(df, new, [(k, k) for k in keys], "left")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    updated = {c: f"cast(if(_conflict = false, _new_{c}, {c}) as {kinds[c]}) as {c}" for c in cols}
    return joined.selectExpr(*[updated.get(c, c) for c in df.columns])


def mark_processed(worklist: DataFrame, flag: str, processed: Column | None = None) -> DataFrame:
    """Flag N -> O, on all open rows or on those meeting `processed`."""
    done = F.col(flag) == "N"
    if processed is not None:
        done = done & processed
    return worklist.withColumn(flag, F.when(done, "O").otherwise(F.col(flag)))


def reset_null(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.lit(None).cast(df.schema[col].dataType))


def set_constant(df: DataFrame, col: str, value: object) -> DataFrame:
    kind = df.schema[col].dataType if col in df.columns else None
    return df.withColumn(col, F.lit(value) if kind is None else F.lit(value).cast(kind))


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def update_from_table(df: DataFrame, src: DataFrame, keys: Keys, col: str, source_col: str) -> DataFrame:
    """Take col from src on rows with exactly one match there; the others keep theirs."""
    looked = checked_lookup(df, src.withColumnRenamed(source_col, "_new"), keys, ["_new"], "_status")
    value = F.when(F.col("_status") == OK, F.col("_new")).otherwise(F.col(col))
    return looked.withColumn(col, value.cast(df.schema[col].dataType)).select(*df.columns)


def touch_changed(df: DataFrame, changed: Column, col: str, as_of: datetime | None = None) -> DataFrame:
    """Row-change timestamp: set only on rows that really changed."""
    return df.withColumn(col, F.when(changed, clock(as_of)).otherwise(F.col(col)))
