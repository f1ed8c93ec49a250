"""Total orders with NULL ranked highest, first-N and top-k."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.sources.workspace import Workspace

ALL = "*all"  # fixed value: no limit
HASH, SECOND = "_hash", "_hash_2"
FEW = 1 << 20  # rows among which the sought key is found by one bounded sort of keys
SAMPLE = 16384  # keys, about, that marks are chosen from
MARKS = (-24, -5, -1, 1, 5, 24)  # where marks stand about the sought key, in spreads of its rank in the sample


class Key(NamedTuple):
    """One sort column; NULL ranks highest either way."""

    name: str
    down: bool = False

    @property
    def column(self) -> Column:
        return F.col(self.name).desc_nulls_first() if self.down else F.col(self.name).asc_nulls_last()


Order = list[Key]


def ascending(*names: str) -> Order:
    return [Key(n) for n in names]


def descending(*names: str) -> Order:
    return [Key(n, True) for n in names]


def columns(order: Order) -> list[Column]:
    return [k.column for k in order]


def parse_quantity(quantity: int | str) -> int | None:
    """Number of rows to handle; None for '*all'."""
    text = str(quantity).strip()
    if text == ALL:
        return None
    if not (text.isascii() and text.isdigit()):
        raise ValueError(f"quantity must be {ALL!r} or digits: {quantity!r}")
    return int(text)


def sorted_rows(df: DataFrame, order: Order) -> DataFrame:
    """Global sort in which rows with equal keys, and copies of one row, can span range partitions.

    A hash of the row and the partition it comes from close the order. Both are the same
    when a task is repeated, unlike a row's position, so a retry neither loses nor doubles rows.
    """
    ties = {HASH: F.xxhash64(*df.columns), "_part": F.spark_partition_id()}
    return df.withColumns(ties).orderBy(*columns(order), HASH, "_part").drop(HASH, "_part")


def placed_in_ranges(df: DataFrame, order: Order, rows: int, work: Workspace, name: str) -> DataFrame:
    """df staged in the order, with _range, the number of a row's range, and _at, its place, without gaps in a range.

    Ranges hold about `rows` rows each. The partition a row comes from closes the order, so that
    copies of one row can span ranges.
    """
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, df.count() // rows + 1)
    closed = [*columns(order), F.col("_from")]
    placed = df.withColumn("_from", F.spark_partition_id()).repartitionByRange(ranges, *closed).sortWithinPartitions(*closed)
    placed = placed.drop("_from").withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    return work.stage(placed, name)


def _against(order: Order, types: dict, edge: dict) -> tuple[Column, Column]:
    """Whether a row comes before the edge, and whether it has the same key."""
    before, same = F.lit(False), F.lit(True)
    for name, down in reversed(order):
        here, there = F.col(name), F.lit(edge[name]).cast(types[name])
        if edge[name] is None:
            first = F.lit(False) if down else here.isNotNull()
        else:
            first = (here.isNull() | (here > there)) if down else F.coalesce(here < there, F.lit(False))
        equal = here.eqNullSafe(there)
        before, same = first | (equal & before), equal & same
    return before, same


def _place(order: Order, types: dict, marks: list[dict]) -> Column:
    """Place of a row among sorted marks: 2k before mark k, 2k + 1 with its key. Found by halving."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        half = (low + high) // 2
        before, same = _against(order, types, marks[half])
        return F.when(before, between(low, half)).when(same, F.lit(2 * half + 1)).otherwise(between(half + 1, high))

    return between(0, len(marks))


def _marks(inside: DataFrame, rows: int, rank: int, order: Order) -> list[dict]:
    """Keys to count between: some of a sample, about the sought one's rank."""
    keys = inside.select(*[k.name for k in order])
    drawn = keys.filter(F.pmod(F.col(HASH), F.lit(1 << 30)) < max(1, int((1 << 30) * SAMPLE / rows))).distinct()
    found = [r.asDict() for r in drawn.orderBy(*columns(order)).limit(4 * SAMPLE).collect()]
    if not found:  # all copies of one row, or nearly
        return [r.asDict() for r in keys.limit(1).collect()]
    last, near, step = len(found) - 1, len(found) * rank // rows, 1.5 * math.sqrt(len(found))
    return [found[k] for k in sorted({min(last, max(0, round(near + step * m))) for m in MARKS})]


def _edge(closed: DataFrame, n: int, order: Order) -> tuple[dict, int | None] | None:
    """The N-th key of the order, and how many of the first N rows have it, or None if all rows that have it do.

    None if there are no more than N rows. An interval of keys that holds the sought one is
    narrowed by counting passes over the table itself, until few enough rows are left to sort
    their keys. The driver sees counts, the keys to count between, at most a few times SAMPLE,
    and the last keys of the sort.
    """
    types = {f.name: f.dataType for f in closed.schema.fields}
    inside, rank, rows = closed, n, closed.count()
    if rows <= n:
        return None
    while rows > FEW:
        marks = _marks(inside, rows, rank, order)
        counts = dict(map(tuple, inside.groupBy(_place(order, types, marks).alias("place")).count().collect()))
        for place in sorted(counts):
            if counts[place] >= rank:
                break
            rank -= counts[place]
        mark, same = divmod(place, 2)
        if same:
            return marks[mark], rank if counts[place] > rank else None
        rows = counts[place]
        if mark:
            before, equal = _against(order, types, marks[mark - 1])
            inside = inside.filter(~(before | equal))
        if mark < len(marks):
            inside = inside.filter(_against(order, types, marks[mark])[0])
    first = inside.select(*[k.name for k in order]).orderBy(*columns(order)).limit(rank + 1)
    *found, after = [r.asDict() for r in first.tail(2)] + [None] * (rows == rank)
    if found[-1] != after:
        return found[-1], None
    before, same = _against(order, types, after)
    return after, rank - inside.filter(before).count()


def split_first(df: DataFrame, quantity: int | str, order: Order) -> tuple[DataFrame, DataFrame]:
    """The first N rows of a total order, and all other rows, each a filter on df itself, for any N.

    Rows with equal keys are ordered by two hashes of the whole row. What shares the N-th key
    and both hashes are copies of one row; they are dealt to both sides by number.
    """
    n = parse_quantity(quantity)
    if n is None:
        return df, df.filter(F.lit(False))
    if n == 0:
        return df.filter(F.lit(False)), df
    closed = df.withColumns({HASH: F.xxhash64(*df.columns), SECOND: F.xxhash64(F.lit(SECOND), *df.columns)})
    full = [*order, Key(HASH), Key(SECOND)]
    found = _edge(closed, n, full)
    if found is None:
        return df, df.filter(F.lit(False))
    edge, taken = found
    before, same = _against(full, {f.name: f.dataType for f in closed.schema.fields}, edge)
    if taken is None:
        return closed.filter(before | same).select(*df.columns), closed.filter(~(before | same)).select(*df.columns)
    copies = closed.filter(same).groupBy(HASH, SECOND).agg(F.count("*").alias("_copies"), *[F.first(c).alias(c) for c in df.columns])

    def numbered(low: str, high: str) -> DataFrame:
        wanted = copies.withColumn("_copy", F.explode(F.expr(f"if({high} >= {low}, sequence({low}, {high}), array())")))
        return wanted.select(*df.columns)

    picked = closed.filter(before).select(*df.columns).unionByName(numbered("1L", f"{taken}L"))
    rest = closed.filter(~(before | same)).select(*df.columns).unionByName(numbered(f"{taken + 1}L", "_copies"))
    return picked, rest


def first_rows(df: DataFrame, quantity: int | str, order: Order) -> DataFrame:
    """First N rows of a total order, in that order."""
    return sorted_rows(split_first(df, quantity, order)[0], order)
