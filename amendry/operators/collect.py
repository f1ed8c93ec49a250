"""Per-group lists, pivots and flags with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amendry.operators.joins import guarded_join
from amendry.operators.order import Order, ascending, columns, placed_in_ranges
from amendry.sources.workspace import Workspace

LIMIT_ROWS = 1000  # Spark's own bound on a row-number filter that it applies before the shuffle
RANGE_ROWS = 1 << 20  # rows that one task sorts for longer lists


def fixed_lists(
    df: DataFrame, keys: list[str], items: dict[str, str], order: Order, width: int = 20, sep: str = "/"
) -> DataFrame:
    """Parallel delimited lists per key in one shared order, each cut to CHAR(width).

    An item takes at least one character and its separator, so no more than
    width / (1 + len(sep)) leading rows of a group can show. Only these are kept. Up to
    LIMIT_ROWS of them, a row-number filter does so which Spark applies per map task before
    the shuffle; more are ranked in sorted ranges that split a group. Either way a huge group
    never reaches one task whole, and the lists are still exact.
    """
    shown = -(-width // (1 + len(sep)))
    parts = ", ".join(f"{text} as {name}" for name, text in items.items())
    if shown <= LIMIT_ROWS:
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*columns(order))))
        ranked = ranked.filter(F.col("_rank") <= shown)
    else:
        ranked = first_in_groups(df, keys, order, shown)
    ranked = ranked.select(*keys, F.expr(f"struct(_rank, {parts}) as _item"))
    grouped = ranked.groupBy(*keys).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    texts = [f"substring(concat_ws('{sep}', _items.{n}) || '{sep}', 1, {width}) as {n}" for n in items]
    return grouped.selectExpr(*keys, *texts)


def first_in_groups(df: DataFrame, keys: list[str], order: Order, shown: int) -> DataFrame:
    """df + _rank, the first `shown` rows of every group, without a window over a group.

    All rows are sorted by key and order in ranges of bounded size. A row's rank is its place in
    its range and group, and the number of the group's rows in earlier ranges, of which
    there is one count for each group and range that meet.
    """
    work = Workspace(df.sparkSession)
    placed = placed_in_ranges(df, [*ascending(*keys), *order], RANGE_ROWS, work, "placed")
    own = [f"_key_{k}" for k in range(len(keys))]
    met = placed.groupBy("_range", *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).filter(F.col("_before") < shown)
    met = met.select(F.col("_range").alias("_in"), *[F.col(k).alias(n) for k, n in zip(keys, own)], "_first", "_before")
    # a null key is a group too: it meets its own by what stands for it
    whole, other = (F.xxhash64(*[F.col(c) for c in names]) for names in (keys, own))
    joined = guarded_join(placed.withColumn("_whole", whole), met.withColumn("_other", other), [("_range", "_in"), ("_whole", "_other")], "inner")
    same = F.lit(True)
    for k, n in zip(keys, own):
        same = same & F.col(k).eqNullSafe(F.col(n))
    ranked = joined.filter(same).withColumn("_rank", F.expr("_before + _at - _first + 1")).filter(F.col("_rank") <= shown)
    return ranked.select(*df.columns, "_rank")


def pivot_ordinals(
    df: DataFrame, keys: list[str], ordinal: str, value: str, names: list[str]
) -> DataFrame:
    """Ordinals 1..n into n columns (0 when absent, highest value when repeated), others ignored."""
    slots = [
        f"cast(coalesce(max(if({ordinal} = {i}, {value}, null)), 0) as int) as {name}"
        for i, name in enumerate(names, start=1)
    ]
    return df.groupBy(*keys).agg(*[F.expr(slot) for slot in slots])


def group_flags(df: DataFrame, keys: list[str], flags: dict[str, str]) -> DataFrame:
    """Per key, whether any row meets each condition (an unknown condition counts as false)."""
    return df.groupBy(*keys).agg(
        *[F.expr(f"bool_or(coalesce({condition}, false)) as {name}") for name, condition in flags.items()]
    )
