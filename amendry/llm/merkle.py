"""Merkle manifest of a table by butterfly exchange.

Every row is a leaf. The leaves of a group, in order, are cut into aligned blocks of
fanout ** height leaves, and each block hashes its own subtree. The blocks then swap
subtree roots round by round: in each round a block meets one block of every other subtree
below the same parent, at most `fanout` in all, and hashes the parent itself. A parent is so
hashed once for each block below it, and after the last round every block holds all hashes
beside its path up to the root: nothing is passed down again, and no task sees more than a
block's leaves or one such meeting. The groups' roots go on in the same way.

Where a subtree has fewer blocks than the largest one beside it, its blocks take part in
several meetings, so that no block lacks a partner.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace

FANOUT = 16
HEIGHT = 3  # levels inside a block
RANGE_ROWS = 1 << 17  # leaves that one task sorts
OUT_ROWS = 512  # leaves whose paths are sent to the JVM at once
STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
PATH = T.ArrayType(STEP)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values: list[Column]) -> Column:
    """Hash of a row's values: `-` for null, otherwise the number of UTF-8 bytes, a colon and the value as text."""
    texts = [v.cast("string") for v in values]
    spelt = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*spelt), 256)


# ---- one block


def levels_of(leaves: list[str], fanout: int, height: int, alone: bool) -> list[list[str]]:
    """Nodes of a block level by level, the last of one node. A block that is a whole tree ends at its root."""
    levels = [leaves]
    for _ in range(height):
        below = levels[-1]
        if alone and len(below) == 1:
            break
        levels.append([digest("".join(below[k : k + fanout])) for k in range(0, len(below), fanout)])
    return levels


def _steps(level: list[str], fanout: int) -> list[tuple[str, str]]:
    """What stands left and right of each node in its run."""
    found = []
    for k in range(0, len(level), fanout):
        run = level[k : k + fanout]
        found += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
    return found


def paths_of(levels: list[list[str]], fanout: int) -> list[list[tuple[str, str]]]:
    """For each leaf of a block, the steps up to the block's root."""
    steps = [_steps(level, fanout) for level in levels[:-1]]
    return [[s[k // fanout**h] for h, s in enumerate(steps)] for k in range(len(levels[0]))]


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """Root that a leaf and the hashes beside its path give."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


# ---- places


def _sorted(leaves: DataFrame, total: int, work: Workspace) -> DataFrame:
    """Leaves by group, id and hash, with the number of their range and their place in it.

    The partition a row comes from closes the order, so that copies of one row can span ranges.
    """
    spark = leaves.sparkSession
    order = [F.asc_nulls_first("_group"), F.asc_nulls_first("_id"), F.asc("_leaf"), F.asc("_other"), F.asc("_from")]
    ranges = max(spark.sparkContext.defaultParallelism, total // RANGE_ROWS + 1)
    ranged = leaves.withColumn("_from", F.spark_partition_id()).repartitionByRange(ranges, *order)
    placed = ranged.sortWithinPartitions(*order).drop("_from").withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    return work.stage(placed, "sorted")


def _pieces(placed: DataFrame, work: Workspace) -> DataFrame:
    """(_range, _group, _first, _before, _size, _tree): each group's part of each range.

    _before is the number of the group's leaves in earlier ranges, _size that of all its
    leaves, _tree the group's number. There are no more pieces than groups and ranges together.
    """
    pieces = placed.groupBy("_range", "_group").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    of_group = Window.partitionBy("_group").orderBy("_range")
    earlier = of_group.rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumns(
        {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_size": F.sum("_rows").over(Window.partitionBy("_group")),
        }
    ).withColumn("_new", (F.col("_before") == 0).cast("long"))
    pieces = work.stage(pieces, "pieces")
    # one row for each range
    begun = pieces.groupBy("_range").agg(F.sum("_new").alias("_begun"))
    begun = begun.withColumn("_earlier", F.sum("_begun").over(Window.orderBy("_range")) - F.col("_begun"))
    inside = Window.partitionBy("_range").orderBy("_first")
    pieces = pieces.join(begun.select("_range", "_earlier"), "_range")
    number = F.when(F.col("_new") == 1, F.col("_earlier") + F.sum("_new").over(inside) - 1)
    pieces = pieces.withColumn("_number", number)
    tree = F.max("_number").over(Window.partitionBy("_group"))
    return work.stage(pieces.withColumn("_tree", tree).drop("_new", "_earlier", "_rows", "_number"), "places")


def _blocks(placed: DataFrame, pieces: DataFrame, leaves: int, work: Workspace) -> DataFrame:
    """One row for each block: its tree, number and how many blocks its tree has, and its leaves in order."""
    right = pieces.select(F.col("_range").alias("_r"), F.col("_group").alias("_g"), "_first", "_before", "_size", "_tree")
    same = (F.col("_range") == F.col("_r")) & F.col("_group").eqNullSafe(F.col("_g"))
    ranked = placed.join(right, same).withColumn("_rank", F.expr("_before + _at - _first"))
    ranked = ranked.selectExpr(
        "_tree", f"_rank div {leaves} as _block", f"(_size - 1) div {leaves} + 1 as _blocks", "_rank", "_id", "_leaf", "_other"
    )
    rows = F.array_sort(F.collect_list(F.struct("_rank", "_id", "_leaf", "_other")))
    return work.stage(ranked.groupBy("_tree", "_block", "_blocks").agg(rows.alias("_rows")), "blocks")


# ---- the exchange


def exchange(state: DataFrame, fanout: int) -> DataFrame:
    """One round: every row meets one of each subtree below its parent, and knows the parent afterwards.

    A row stands for a block. _tree and _node name the subtree that it has the root of, _pos
    its number among the blocks below it; _up holds the steps so far. Of the subtrees
    beside each other, the largest has so many blocks as there are meetings; the blocks of
    smaller ones go to every so many.
    """
    keyed = state.withColumns({"_parent": F.expr(f"_node div {fanout}"), "_digit": F.expr(f"_node % {fanout}")})
    sizes = keyed.groupBy("_tree", "_parent", "_digit").agg(F.count("*").alias("n"))
    plan = sizes.groupBy("_tree", "_parent").agg(
        F.max("n").alias("_meetings"), F.collect_list(F.struct("_digit", "n")).alias("_sizes")
    )
    told = guarded_join(keyed, plan, [("_tree", "_tree"), ("_parent", "_parent")], "inner")
    told = told.withColumns(
        {
            "_own": F.expr("filter(_sizes, s -> s._digit = _digit)[0].n"),
            "_lower": F.expr("aggregate(filter(_sizes, s -> s._digit < _digit), 0L, (a, s) -> a + s.n)"),
        }
    )
    sent = told.withColumn("_meeting", F.explode(F.expr("sequence(_pos, _meetings - 1, _own)")))
    home = F.struct("_block", "_blocks", "_group_tree", "_group_root", "_up", (F.col("_lower") + F.col("_pos")).alias("_pos"))
    sent = sent.withColumn("_home", F.when(F.col("_meeting") == F.col("_pos"), home))
    met = sent.groupBy("_tree", "_parent", "_meeting").agg(
        F.collect_list(F.struct("_digit", "_root", "_home")).alias("_met")
    )
    met = met.withColumn("_met", F.expr("array_sort(_met, (a, b) -> int(a._digit - b._digit))"))
    joined = lambda test: f"array_join(transform(filter(_met, m -> m._digit {test}), m -> m._root), '')"
    met = met.withColumn("_root", F.sha2(F.expr(joined("is not null")), 256))
    own = F.expr("filter(_met, m -> m._home is not null)")
    back = met.select("_tree", "_parent", "_root", "_met", F.explode(own).alias("_one"))
    step = f"struct({joined('< _one._digit')} as left, {joined('> _one._digit')} as right)"
    return back.selectExpr(
        "_tree", "_parent as _node", "_one._home._pos as _pos", "_root", "_one._home._block as _block",
        "_one._home._blocks as _blocks", "_one._home._group_tree as _group_tree", "_one._home._group_root as _group_root",
        f"concat(_one._home._up, array({step})) as _up",
    )


def _risen(state: DataFrame, nodes: int, fanout: int, work: Workspace, name: str, many: Column | None = None) -> DataFrame:
    """Rounds until every tree has one node; `many`, if given, is the number of nodes a row's own tree begins with."""
    for turn in itertools.count():
        span = fanout**turn
        if span >= nodes:
            return state
        open_ = F.lit(True) if many is None else many > span
        state = exchange(state.filter(open_), fanout).unionByName(state.filter(~open_))
        state = work.stage(state, f"{name}_{turn}")


def _roots(fanout: int, height: int):
    def run(batches):
        for batch in batches:
            column = batch.column("_leaves")
            roots = [
                levels_of(column[k].as_py(), fanout, height, batch.column("_blocks")[k].as_py() == 1)[-1][0]
                for k in range(batch.num_rows)
            ]
            names = ["_tree", "_block", "_blocks"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(roots, pa.string())], names=[*names, "_root"])

    return run


def _proved(fanout: int, height: int):
    step = pa.struct([("left", pa.string()), ("right", pa.string())])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("_rows").slice(k, 1).flatten()
                ids, leaves, others = (rows.field(n) for n in ("_id", "_leaf", "_other"))
                leaves_of = leaves.to_pylist()
                known = {n: batch.column(n)[k].as_py() for n in ("_blocks", "_up", "_group_root", "_root")}
                above = [(s["left"], s["right"]) for s in known["_up"]]
                levels = levels_of(leaves_of, fanout, height, known["_blocks"] == 1)
                paths = paths_of(levels, fanout)
                for at in range(0, len(paths), OUT_ROWS):
                    whole = [p + above for p in paths[at : at + OUT_ROWS]]
                    folded = [fold(x, p) for x, p in zip(others.slice(at, OUT_ROWS).to_pylist(), whole)]
                    same = lambda name: pa.array([known[name]] * len(whole), pa.string())  # noqa: B023, E731
                    sides = [pa.array([s[i] for p in whole for s in p], pa.string()) for i in (0, 1)]
                    cuts = pa.array(list(itertools.accumulate(map(len, whole), initial=0)), pa.int32())
                    path = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(sides, fields=list(step)))
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(at, OUT_ROWS), leaves.slice(at, OUT_ROWS), same("_group_root"), same("_root"), path,
                         pa.array(folded, pa.string())],
                        names=["_id", "leaf", "subroot", "root", "path", "folded_root"],
                    )

    return run


def add_proofs(
    df: DataFrame,
    columns: list[str],
    ident: str = "doc_id",
    group: str = "source",
    altered: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    height: int = HEIGHT,
) -> DataFrame:
    """One row per row of df: ident, leaf, subroot, root, path and folded_root.

    The leaf hashes `columns`. Leaves of a group ascend by ident, null first, then by their
    hash; groups ascend bytewise, null first, and a null group is a group like any other.
    `path` lists, from the leaf up to the root, what stands left and right of the path at
    each level; both are empty where a node is alone. folded_root is what the path gives for
    the leaf of a row whose columns are replaced as `altered` says, or for the leaf itself.
    Equal rows have leaves of their own, side by side. Columns not named are not read, and
    no name of df clashes. An empty table gives an empty result. A text of any length is
    hashed whole.
    """
    work = Workspace(df.sparkSession)
    now = {c: F.col(f"`{c}`") for c in columns}
    leaves = df.select(
        F.col(f"`{group}`").cast("string").alias("_group"),
        F.col(f"`{ident}`").alias("_id"),
        leaf_of(list(now.values())).alias("_leaf"),
        leaf_of(list({**now, **(altered or {})}.values())).alias("_other"),
    )
    leaves = work.stage(leaves, "leaves")
    placed = _sorted(leaves, leaves.count(), work)
    pieces = _pieces(placed, work)
    trees, most = pieces.agg(F.coalesce(F.max("_tree") + 1, F.lit(0)), F.coalesce(F.max("_size"), F.lit(0))).first()
    width = fanout**height
    blocks = _blocks(placed, pieces, width, work)
    kept = T.StructType([f for f in blocks.schema if f.name != "_rows"] + [T.StructField("_root", T.StringType())])
    roots = blocks.selectExpr("_tree", "_block", "_blocks", "transform(_rows, r -> r._leaf) as _leaves")
    state = roots.mapInArrow(_roots(fanout, height), kept).selectExpr(
        "_tree", "_block as _node", "0L as _pos", "_root", "_block", "_blocks", "_tree as _group_tree",
        "cast(null as string) as _group_root", "cast(array() as array<struct<left: string, right: string>>) as _up",
    )
    state = _risen(work.stage(state, "roots"), -(-most // width), fanout, work, "round", F.col("_blocks"))
    state = state.withColumns(
        {"_tree": F.lit(0).cast("long"), "_node": F.col("_group_tree"), "_pos": F.col("_block"), "_group_root": F.col("_root")}
    )
    state = _risen(state, trees, fanout, work, "top")
    facts = state.select("_group_tree", "_block", "_up", "_group_root", "_root")
    joined = guarded_join(blocks, facts, [("_tree", "_group_tree"), ("_block", "_block")], "inner")
    names = ["leaf", "subroot", "root"]
    schema = T.StructType(
        [T.StructField("_id", leaves.schema["_id"].dataType), *[T.StructField(n, T.StringType()) for n in names]]
        + [T.StructField("path", PATH), T.StructField("folded_root", T.StringType())]
    )
    return joined.mapInArrow(_proved(fanout, height), schema).withColumnRenamed("_id", ident)


def path_digest(path: Column) -> Column:
    """Hash of all hashes beside a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
