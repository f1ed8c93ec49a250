"""Dated lookups: the value in force on a day.

Keys with a handful of dates meet their intervals in an equi-join. A key with MANY dates or
more would pair each of its rows with every interval; rows and dates of such keys are
sorted together instead, in ranges that may split a key, and the last date before a row is
carried forward, first inside a range and then from one range to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amendry.operators.joins import Keys, guarded_join
from amendry.operators.order import ascending, placed_in_ranges
from amendry.sources.workspace import Workspace

MANY = 64  # dates of one key
RANGE_ROWS = 1 << 20  # rows and dates that one task sorts


def dated_values(ref: DataFrame, keys: list[str], start: str, value: str) -> DataFrame:
    """One row per key and start date; repeated ones are counted."""
    return ref.groupBy(*keys, start).agg(F.expr("count(1) as _n"), F.expr(f"max({value}) as {value}"))


def validity_intervals(ref: DataFrame, keys: list[str], start: str, value: str) -> DataFrame:
    """Half-open intervals [start, next start) per key; repeated (key, start) rows are counted."""
    following = f"lead({start}) over (partition by {', '.join(keys)} order by {start})"
    return dated_values(ref, keys, start, value).selectExpr(*keys, f"{start} as _from", f"{following} as _to", "_n", value)


def asof_lookup(
    df: DataFrame, ref: DataFrame, keys: Keys, day: str, start: str, value: str, rc: str = "rc", many: int = MANY
) -> DataFrame:
    """df + value in force on `day` + rc: 0 found, 100 none, -811 several for the same start."""
    names = [k for _, k in keys]
    often = ref.groupBy(*names).agg(F.count_distinct(start).alias("_dates")).filter(F.col("_dates") >= many).drop("_dates")
    if often.isEmpty():
        return _with_code(_by_interval(df, ref, keys, day, start, value), value, rc)
    work = Workspace(df.sparkSession)
    flagged = guarded_join(df, often.withColumn("_often", F.lit(True)), keys, "left")
    flagged = work.stage(flagged.withColumn("_often", F.coalesce("_often", F.lit(False))), "rows")
    few = _by_interval(flagged.filter("not _often").drop("_often"), guarded_join(ref, often, [(k, k) for k in names], "left_anti"), keys, day, start, value)
    rows, dates = flagged.filter("_often").drop("_often"), guarded_join(ref, often, [(k, k) for k in names], "left_semi")
    carried = _carried_forward(rows, dated_values(dates, names, start, value), keys, day, start, value, work)
    return _with_code(few.unionByName(carried), value, rc)


def _with_code(df: DataFrame, value: str, rc: str) -> DataFrame:
    return df.withColumns(
        {
            rc: F.expr("case when _n is null then 100 when _n > 1 then -811 else 0 end"),
            value: F.expr(f"case when _n = 1 then {value} end"),
        }
    ).drop("_n")


def _by_interval(df: DataFrame, ref: DataFrame, keys: Keys, day: str, start: str, value: str) -> DataFrame:
    """df + the value and _n of the interval its day is in."""
    spans = validity_intervals(ref, [k for _, k in keys], start, value)
    in_force = f"`{day}` >= _from and (_to is null or `{day}` < _to)"
    return guarded_join(df, spans, keys, "left", in_force).drop("_from", "_to")


def _carried_forward(
    df: DataFrame, dated: DataFrame, keys: Keys, day: str, start: str, value: str, work: Workspace
) -> DataFrame:
    """The same by sorting rows and dates together; each row is met once, however many dates its key has.

    Ranges are cut by key, day and a hash of the row, so that neither a key nor a day keeps
    rows together. What a range needs from earlier ones is one date per key that it shares with them.
    """
    own = [f"_key_{k}" for k in range(len(keys))]
    kinds = dict(df.dtypes)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(
        *[F.col(f"`{l}`").alias(k) for (l, _), k in zip(keys, own)],
        F.col(f"`{day}`").alias("_day"),
        F.lit(1).alias("_kind"),
        F.xxhash64(row).alias("_tie"),
        row.alias("_row"),
    )
    dates = dated.select(
        *[F.col(f"`{r}`").cast(kinds[l]).alias(k) for (l, r), k in zip(keys, own)],
        F.col(f"`{start}`").cast(kinds[day]).alias("_day"),
        F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_tie"),
        F.struct("_n", F.col(f"`{value}`").alias("_value")).alias("_date"),
    ).filter("_day is not null")
    together = rows.unionByName(dates, allowMissingColumns=True)
    placed = placed_in_ranges(together, ascending(*own, "_day", "_kind", "_tie"), RANGE_ROWS, work, "placed")
    # the last date of each key in each range, and what its next range takes over
    ends = placed.groupBy("_range", *own).agg(F.max_by("_date", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_end"))
    earlier = Window.partitionBy(*own).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).filter("_carry is not null")
    carry = carry.select(F.col("_range").alias("_in"), *[F.col(k).alias(f"{k}_in") for k in own], "_carry")
    inside = Window.partitionBy("_range", *own).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    filled = placed.withColumn("_found", F.last("_date", ignorenulls=True).over(inside)).filter("_kind = 1")
    filled = guarded_join(filled, carry, [("_range", "_in"), *[(k, f"{k}_in") for k in own]], "left")
    found = F.when(F.col("_day").isNotNull(), F.coalesce("_found", "_carry"))  # a row without a day comes last
    return filled.select(found.alias("_found"), "_row.*").select(
        *[F.col(f"`{c}`") for c in df.columns], F.col("_found._n").alias("_n"), F.col("_found._value").alias(value)
    )
