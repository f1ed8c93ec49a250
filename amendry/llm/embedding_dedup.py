"""Near-duplicate embeddings by collision-counting projections.

All unit vectors are turned by one random rotation, which gives as many one-dimensional
projections as there are dimensions. Vectors are cut into tiles along the first one. In a
pair of tiles some projections of one side are sorted, every vector of the other opens a
window around its own value in each, and the windows that a pair shares are counted.

The count to pass loses nothing, at any number of dimensions: the squared projection
differences of a pair add up to its squared distance, so a pair within the distance misses
at most distance^2 / window^2 windows. Window and number of projections follow from the
dimension: they are the cheapest with which unrelated vectors, whose differences spread
by the root of 2 / dimension, nearly always miss more. Pairs that pass are verified by their
cosine in double precision. Tiles whose ranges of the first projection lie further apart than
the distance are not compared. Exact copies are folded before. No pair leaves a task: a tile
gives the number of links of each vector and a root for what is connected inside it, a pair
of tiles numbers of links and just enough links between roots.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm.components import components
from amendry.llm.rows import add_columns, side_by_side, sides
from amendry.llm.simhash import _merge
from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace

SPREADS = 3  # by so many spreads of the count do unrelated vectors miss more windows than is allowed
CELLS = 1 << 17  # pairs whose windows are counted at once
TILE_BYTES = 16 << 20  # of double-precision vectors in a tile
SEED = 11


def _packed(vectors: pa.Array) -> list:
    """Numbers of each vector as bytes, in their own precision; None for null, empty, zero and non-finite ones and those with nulls."""
    out, kind = [], np.float32 if vectors.type.value_type == pa.float32() else np.float64
    for v in vectors:
        x = None if not v.is_valid or v.values.null_count or not len(v.values) else np.asarray(v.values, kind) + kind(0)
        out.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
    return out


def rotation(size: int) -> np.ndarray:
    """Orthonormal directions, one per column, the same in every task."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))[0]


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def windows_of(size: int, least: float) -> tuple[int, float, int]:
    """Windows that a pair at the distance may miss, half a window's width, and the number of projections to count."""
    distance = max(1e-12, 2 - 2 * least)
    best = None
    for missed in range(size):
        window = math.sqrt(distance / (missed + 0.999)) + 1e-9
        chance = math.erfc(window / math.sqrt(2 / size) / math.sqrt(2))  # of unrelated vectors, to miss one
        # the smallest m with m * chance - SPREADS * sqrt(m * chance * (1 - chance)) > missed
        root = (SPREADS * math.sqrt(1 - chance) + math.sqrt(SPREADS**2 * (1 - chance) + 4 * (missed + 1))) / 2
        many = math.ceil(root**2 / chance) if chance > 1e-9 else size
        if best is None or many < best[2]:
            best = missed, window, many
    return best[0], best[1], min(size, best[2])


def linked_blocks(left: np.ndarray, right: np.ndarray, least: float):
    """Links between two tiles of unit vectors of one size: (rows of left, rows of right), in blocks."""
    missed, window, many = windows_of(left.shape[1], least)
    turn = rotation(left.shape[1])[:, :many]
    a, b = left @ turn, right @ turn
    kind = np.uint16 if len(b) < 1 << 16 else np.uint32  # holds every rank and width
    ranks = np.empty((many, len(b)), kind)
    low, width = np.empty((2, many, len(a)), kind)
    for k in range(many):
        order = np.argsort(b[:, k])
        known = b[order, k]
        ranks[k, order] = np.arange(len(b))
        low[k] = np.searchsorted(known, a[:, k] - window, "left")
        width[k] = np.searchsorted(known, a[:, k] + window, "right") - low[k]
    step = max(1, CELLS // max(1, len(b)))
    from_low, miss = np.empty((step, len(b)), kind), np.empty((step, len(b)), bool)
    misses = np.empty((step, len(b)), np.uint8 if many < 256 else np.uint16)
    for at in range(0, len(a), step):
        n = min(step, len(a) - at)
        misses[:n] = 0
        for k in range(many):
            np.subtract(ranks[k], low[k, at : at + n, None], out=from_low[:n])
            np.greater_equal(from_low[:n], width[k, at : at + n, None], out=miss[:n])
            np.add(misses[:n], miss[:n], out=misses[:n], casting="unsafe")
        u, v = np.nonzero(misses[:n] <= missed)
        if len(u):
            some, line = np.unique(u, return_inverse=True)
            if len(u) * 8 < len(some) * len(b):  # few pairs of a line are left
                good = np.einsum("ij,ij->i", left[u + at], right[v]) >= least
            else:
                good = (left[some + at] @ right.T)[line, v] >= least
            yield u[good] + at, v[good]


def within_tile(vectors: np.ndarray, weights: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector: weight of the others it is linked with, and the place of its root."""
    degree, labels = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
    for u, v in linked_blocks(vectors, vectors, least):
        u, v = u[u != v], v[u != v]
        np.add.at(degree, u, weights[v])
        if len(u):
            _merge(labels, u, v)
    return degree, labels


def between_tiles(left, right, least: float):
    """Weights of links of both sides and links (a, b) that connect their roots; a side is (vectors, weights, roots)."""
    degrees = [np.zeros(len(s[0]), np.int64) for s in (left, right)]
    nodes, of = np.unique(np.concatenate([left[2], right[2]]), return_inverse=True)
    labels = np.arange(len(nodes))
    for u, v in linked_blocks(left[0], right[0], least):
        np.add.at(degrees[0], u, right[1][v])
        np.add.at(degrees[1], v, left[1][u])
        if len(u):
            _merge(labels, of[u], of[v + len(left[0])])
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return degrees, nodes[moved], nodes[labels[moved]]


# ---- Spark


def _numbers(raw: bytes, wide: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if wide == 4 else np.float64).astype(np.float64)


def _matrix(values: pa.Array, size: int) -> np.ndarray:
    raw = b"".join(values.to_pylist())
    return unit(_numbers(raw, len(raw) // max(1, size * len(values))).reshape(-1, size))


def _first_projection(packed, size):
    """Value of the first projection, by which tiles are cut."""
    found = []
    for raw, n in zip(packed.to_pylist(), size.to_pylist()):
        x = _numbers(raw, len(raw) // n)
        found.append(float((unit(x[None]) @ rotation_first(len(x)))[0]))
    return [pa.array(found)]


def rotation_first(size: int, have={}) -> np.ndarray:  # noqa: B006 - kept between calls on purpose
    if size not in have:
        have[size] = rotation(size)[:, 0]
    return have[size]


def _inside(least: float):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tile, size = batch.column("tile")[k].as_py(), batch.column("size")[k].as_py()
                rows = batch.column("rows")[k].values
                node, weight = (np.asarray(rows.field(n)) for n in ("node", "weight"))
                degree, labels = within_tile(_matrix(rows.field("vector"), size), weight, least)
                n = len(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tile] * n, pa.int64()), pa.array([size] * n, pa.int32()), pa.array(node), pa.array(weight),
                     rows.field("vector"), pa.array(node[labels]), pa.array(degree)],
                    names=["tile", "size", "node", "weight", "vector", "root", "links"],
                )

    return run


def _across(least: float):
    def run(batches):
        for pair in sides(batches):
            parts, nodes = [], []
            for batch in pair:
                rows = batch.column("rows")[0].values
                nodes.append(np.asarray(rows.field("node")))
                vectors = _matrix(rows.field("vector"), batch.column("size")[0].as_py())
                parts.append((vectors, *[np.asarray(rows.field(n)) for n in ("weight", "root")]))
            degrees, a, b = between_tiles(*parts, least)
            node = np.concatenate([n[d > 0] for n, d in zip(nodes, degrees)])
            links = np.concatenate([d[d > 0] for d in degrees])
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node, a])), pa.concat_arrays([pa.array(links), none]),
                 pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(b)])],
                names=["node", "links", "other"],
            )

    return run


def _limit(size: int, limit: int) -> int:
    """Vectors of a size in a tile."""
    return max(1, min(limit, TILE_BYTES // (8 * size)))


def _tiled(folded: DataFrame, limit: int, distance: float) -> tuple[DataFrame, DataFrame]:
    """folded + tile, and the pairs (i, j) of different tiles that are near enough to compare.

    A tile is a range of the first projection, or, of a range that ties keep over-full, a
    share of its vectors by a hash; all shares of a range are compared. The driver sees the
    ranges; pairs are made of them on Spark.
    """
    sizes = folded.groupBy("size").count().collect()  # one row per vector size
    first, last, ranges, full = 0, [], {}, []
    for size, count in sorted(map(tuple, sizes)):
        parts = max(1, math.ceil(count / _limit(size, limit)))
        shares = [k / parts for k in range(1, parts)]
        own = folded.filter(F.col("size") == size)
        cuts = own.agg(F.percentile_approx("along", shares, 100 * parts)).first()[0] if shares else []
        ranges[size] = (first, cuts)
        # range i ends at its cut, range j begins behind the cut before it
        last += [first + max(i, bisect_right(cuts, cuts[i] + distance + 1e-9)) if i < len(cuts) else first + i for i in range(parts)]
        full += [_limit(size, limit)] * parts
        first += parts

    def place(along, size):
        both = zip(along.to_pylist(), size.to_pylist())
        return [pa.array([ranges[n][0] + bisect_left(ranges[n][1], x) for x, n in both], pa.int64())]

    ranged = add_columns(folded, ["along", "size"], [T.StructField("range", T.LongType())], place)
    tiles, done = {}, 0
    for k, count in sorted(map(tuple, ranged.groupBy("range").count().collect())):  # as many rows as there are ranges
        shares = 1 if count <= 1.5 * full[k] else math.ceil(count / full[k])
        tiles[k] = range(done, done + shares)
        done += shares

    def share(k, mixed):
        return [pa.array([tiles[r][h % len(tiles[r])] for r, h in zip(k.to_pylist(), mixed.to_pylist())], pa.int64())]

    tiled = add_columns(ranged.withColumn("mixed", F.xxhash64("node")), ["range", "mixed"], [T.StructField("tile", T.LongType())], share)
    rows = [(k, last[k], t.start, t.stop - 1) for k, t in tiles.items()]
    known = folded.sparkSession.createDataFrame(rows, "r bigint, last bigint, first bigint, final bigint")
    left = known.selectExpr("explode(sequence(r, last)) as q", "first", "final")
    right = known.selectExpr("r as q", "first as first_q", "final as final_q")
    pairs = left.join(right, "q").selectExpr("explode(sequence(first, final)) as i", "first_q", "final_q")
    pairs = pairs.selectExpr("i", "explode(sequence(first_q, final_q)) as j").filter("i < j")
    return tiled.drop("range", "mixed"), pairs


def near_duplicates(
    df: DataFrame, ident: str = "vec_id", vector: str = "embedding", least: float = 0.95, limit: int | None = None
) -> DataFrame:
    """One row per row of df: ident, n_links (other rows linked directly), component_id, kept.

    Rows link when the cosine of their vectors is at least `least` and the vectors have
    equal sizes. A vector that is null, empty, zero, or holds a null or a non-finite number
    links with nothing, not even a copy. Copies of a vector, and repeated rows, link with
    each other. component_id is the smallest ident reachable (null if none has one), and a
    row is kept if that is its own. Other columns are not read; an empty table gives none.
    Ids are taken as long.
    """
    work = Workspace(df.sparkSession)
    kind = "array<float>" if df.schema[vector].dataType == T.ArrayType(T.FloatType(), True) else "array<double>"
    wide = 4 if kind == "array<float>" else 8
    rows = df.select(F.col(f"`{ident}`").cast("long").alias("_id"), F.col(f"`{vector}`").cast(kind).alias("_in"))
    rows = add_columns(rows, ["_in"], [T.StructField("_vec", T.BinaryType())], lambda v: [pa.array(_packed(v), pa.binary())])
    rows = work.stage(rows.select("_id", "_vec"), "vectors")
    folded = rows.filter("_vec is not null").groupBy("_vec").agg(F.count("*").alias("weight"), F.min("_id").alias("least"))
    folded = folded.withColumns({"node": F.monotonically_increasing_id(), "size": F.expr(f"cast(length(_vec) / {wide} as int)")})
    folded = add_columns(folded, ["_vec", "size"], [T.StructField("along", T.DoubleType())], _first_projection)
    folded = work.stage(folded, "folded")
    total = folded.count()
    limit = min(1 << 15, limit or max(1 << 11, 32 * math.isqrt(total)))
    tiled, pairs = _tiled(folded, limit, math.sqrt(2 - 2 * least))
    members = F.collect_list(F.struct("node", "weight", F.col("_vec").alias("vector"))).alias("rows")
    tiles = tiled.groupBy("tile", "size").agg(members)
    inner = "tile bigint, size int, node bigint, weight bigint, vector binary, root bigint, links bigint"
    own = work.stage(tiles.repartition(max(1, math.ceil(total / limit))).mapInArrow(_inside(least), inner), "inside")
    again = own.groupBy("tile", "size").agg(F.collect_list(F.struct("node", "weight", "vector", "root")).alias("rows"))
    todo = work.stage(pairs, "near_tiles")
    wide = side_by_side(again, todo, "tile", max(1, todo.count()))
    found = work.stage(wide.mapInArrow(_across(least), "node bigint, links bigint, other bigint"), "across")
    degrees = own.select("node", "links").union(found.filter("links is not null").select("node", "links"))
    degrees = degrees.groupBy("node").agg(F.sum("links").alias("links"))
    joint = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")), work)
    roots = guarded_join(own.select("node", "root"), joint, [("root", "node")], "left")
    roots = roots.select("node", F.coalesce("component", "root").alias("component"))
    facts = guarded_join(guarded_join(folded.select("node", "_vec", "weight", "least"), degrees, [("node", "node")]), roots, [("node", "node")])
    facts = work.stage(facts.withColumn("_of", F.col("component")), "facts")
    smallest = facts.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = guarded_join(facts, smallest, [("_of", "component")]).selectExpr("_vec", "links + weight - 1 as links", "component_id", "true as _some")
    joined = guarded_join(rows, facts, [("_vec", "_vec")], "left")
    component = F.when(F.col("_some"), F.col("component_id")).otherwise(F.col("_id"))
    return joined.select(
        F.col("_id").alias(ident),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("_id")).alias("kept"),
    )
