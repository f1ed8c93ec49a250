"""Single-row lookups that report a missing or repeated key instead of failing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amendry.operators.joins import Keys, guarded_join

OK, NOT_FOUND, AMBIGUOUS = "OK", "NOT_FOUND", "AMBIGUOUS"


def one_per_key(ref: DataFrame, keys: list[str], cols: list[str], count: str, weight: str | None = None) -> DataFrame:
    """One row per key: how many rows carry it and, when exactly one does, its columns.

    `weight` names a column that counts a row as several, for copies merged beforehand.
    """
    n = F.expr("count(1)" if weight is None else f"sum({weight})")
    grouped = ref.groupBy(*keys).agg(n.alias(count), *[F.expr(f"max({c}) as {c}") for c in cols])
    return grouped.selectExpr(*keys, count, *[f"case when {count} = 1 then {c} end as {c}" for c in cols])


def checked_lookup(
    df: DataFrame,
    ref: DataFrame,
    keys: Keys,
    cols: list[str],
    status: str = "status",
    weight: str | None = None,
) -> DataFrame:
    """df + cols + status: OK for one matching row, NOT_FOUND for none, AMBIGUOUS for more."""
    single = one_per_key(ref, [k for _, k in keys], cols, "_n", weight)
    joined = guarded_join(df, single, keys, "left")
    found = f"case when _n is null or _n = 0 then '{NOT_FOUND}' when _n > 1 then '{AMBIGUOUS}' else '{OK}' end"
    return joined.withColumn(status, F.expr(found)).drop("_n")
