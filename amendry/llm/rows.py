"""Row-wise operators over Arrow batches, and staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.operators.joins import guarded_join

SLICE_BYTES = 4 << 20
SENT_ROWS = 1 << 20  # rows of two numbers that every task may hold, some 50 MB


def pieces(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of about `limit` bytes; a longer row is a slice of its own."""
    rows, done = batch.num_rows, 0
    step = max(1, int(rows * limit / max(1, batch.nbytes)))
    while done < rows:
        part = batch.slice(done, step)
        while part.num_rows > 1 and part.nbytes > 2 * limit:
            part = part.slice(0, part.num_rows // 2)
        done += part.num_rows
        yield part


def side_by_side(tiles: DataFrame, pairs: DataFrame, tile: str, tasks: int) -> DataFrame:
    """Rows of `tiles` once for every pair (i, j) that they are in, the two of a pair one after the other in one task.

    Each tile is sent once to each of its pairs. `sides` reads the pairs again.
    """
    ends = pairs.selectExpr("i", "j", f"inline(array(struct(i as `{tile}`, 0 as side), struct(j as `{tile}`, 1 as side)))")
    met = tiles.join(ends, tile)
    return met.repartitionByRange(tasks, "i", "j").sortWithinPartitions("i", "j", "side")


def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch]]:
    """The two rows of each pair, as batches of one row."""
    held = None
    for batch in batches:
        side = batch.column("side").to_pylist()
        for k in range(batch.num_rows):
            if side[k] == 0:
                held = batch.slice(k, 1)
            else:
                yield held, batch.slice(k, 1)


def led(rows: DataFrame, facts: DataFrame, key: str, by: str, each: int, tasks: int) -> DataFrame:
    """rows in parts of about `each` rows of one key, and before every part the key's row of `facts`.

    A large fact of a key, unique in `facts`, is so sent once to each part and not beside every
    row; a hot key has many parts. `by` tells the rows of a key apart. Keys without rows are
    left out; rows without a fact are not led. Sorted by key, _part and _lead, leaders first.
    """
    parts = rows.groupBy(key).agg(F.ceil(F.count("*") / each).cast("int").alias("_parts"))
    dealt = guarded_join(rows, parts, [(key, key)], "inner").withColumn("_part", F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"))
    heads = guarded_join(facts, parts, [(key, key)], "inner").withColumn("_part", F.explode(F.expr("sequence(0, _parts - 1)")))
    both = dealt.withColumn("_lead", F.lit(0)).unionByName(heads.withColumn("_lead", F.lit(1)), allowMissingColumns=True)
    return both.drop("_parts").repartition(tasks, key, "_part").sortWithinPartitions(key, "_part", F.desc("_lead"))


def meet(left: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left join of wide rows with staged facts: a long key, unique and of the same name, and one number.

    The facts are counted. Few enough are sent to all tasks, so that the wide rows stay
    where they are; more are met in a shuffle join that splits hot keys.
    """
    if facts.count() <= SENT_ROWS:
        return left.join(F.broadcast(facts), key, "left")
    return guarded_join(left, facts, [(key, key)], "left")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df less the columns of these names, compared as Spark does, without case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def add_columns(
    df: DataFrame,
    using: list[str],
    fields: list[T.StructField],
    compute: Callable[..., list],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """df + fields computed from the `using` columns, batch by batch.

    A column of df with the name of a new one is replaced. `compute` gets the Arrow
    arrays of `using` and returns one Arrow array per field.
    """
    names = [f.name for f in fields]
    clash = [u for u in using if u.lower() in {n.lower() for n in names}]
    inputs = [f"_in{i}_{u}" for i, u in enumerate(using)]
    if clash:
        df = df.select("*", *[F.col(f"`{u}`").alias(i) for u, i in zip(using, inputs)])
    else:
        inputs = using
    kept = [c for c in without(df, names).columns if not (clash and c in inputs)]
    df = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, *inputs])])
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, limit):
                got = compute(*[part.column(part.schema.get_field_index(i)) for i in inputs])
                old = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*old, *got], names=[*kept, *names])

    return df.mapInArrow(run, schema)
