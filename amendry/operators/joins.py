"""Equi-joins against one-row-per-key tables that survive a hot key.

A lookup side built by an aggregation is already partitioned by the join key, so
Spark would join it in the aggregation's own stage, where adaptive skew handling
cannot split a hot partition of the other side. `guarded_join` compares the
complements of an integral key instead (~a = ~b holds exactly when a = b), which no
earlier partitioning satisfies. Each side then enters the join straight from its own
exchange, and a hot key's rows are split over many tasks at run time, also when the
result is grouped by the key afterwards. No side carries a broadcast hint: Spark
broadcasts one only when its estimated or measured size is below
`spark.sql.autoBroadcastJoinThreshold`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = list[tuple[str, str]]


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _tests(left: DataFrame, right: DataFrame, keys: Keys) -> list[str]:
    """Equality of every key, one of them guarded; right keys are named _right_0, _right_1, ..."""
    types = [(_types(left)[l], _types(right)[r]) for l, r in keys]
    integral = [i for i, pair in enumerate(types) if all(isinstance(t, T.IntegralType) for t in pair)]
    sign = ["~" if i == min(integral, default=None) else "" for i in range(len(keys))]
    tests = [f"{sign[i]}`{l}` = {sign[i]}_right_{i}" for i, (l, _) in enumerate(keys)]
    if not integral:  # a hash guards other keys; it is comparable only between equal types
        if any(a != b for a, b in types):
            raise TypeError(f"keys of different types: {keys}")
        own = ", ".join(f"`{l}`" for l, _ in keys)
        other = ", ".join(f"_right_{i}" for i in range(len(keys)))
        tests.append(f"xxhash64({own}) = xxhash64({other})")
    return tests


def guarded_join(
    left: DataFrame, right: DataFrame, keys: Keys, how: str = "left", condition: str | None = None
) -> DataFrame:
    """Join left to a right side holding few rows per key; right key columns are dropped."""
    rkeys = [k for _, k in keys]
    renamed = right.selectExpr(
        *[f"`{k}` as _right_{i}" for i, k in enumerate(rkeys)],
        *[f"`{c}`" for c in right.columns if c not in rkeys],
    )
    tests = _tests(left, right, keys) + ([f"({condition})"] if condition else [])
    joined = left.join(renamed, F.expr(" and ".join(tests)), how)
    return joined.drop(*[f"_right_{i}" for i in range(len(keys))])


def having_match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """Rows of left with a match (EXISTS / IN). Right keys are deduplicated map-side first."""
    return guarded_join(left, right.select(*[k for _, k in keys]).distinct(), keys, "left_semi")


def without_match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """Rows of left without a match."""
    return guarded_join(left, right.select(*[k for _, k in keys]).distinct(), keys, "left_anti")


def latest_batch_rows(df: DataFrame, group: str, batch: str) -> DataFrame:
    """All rows of each group's highest batch, ties kept. Two map-side combined steps, no window."""
    top = group_max(df, group, batch, "_top")
    return guarded_join(df, top, [(group, group), (batch, "_top")], "left_semi")


def group_max(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return df.groupBy(group).agg(F.max(value).alias(name))
