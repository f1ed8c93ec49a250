"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are cut into tiles that are boxes in the space of the population
counts of their four 16-bit quarters. The sum of the quarters' differences never
exceeds the number of differing bits, so a pair of tiles whose boxes lie further apart
than the radius is skipped; every other pair is compared whole, with exclusive-or and
bit counts. The cut follows a histogram of population counts, at most 17^4 rows
whatever the input. No comparison returns all pairs: inside a tile every fingerprint gets
one root, and a pair of tiles returns just enough links to connect its roots.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm.components import components
from amendry.llm.rows import add_columns, meet, side_by_side, sides
from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace

SEED = 42
QUARTERS = ["p0", "p1", "p2", "p3"]
BLOCK = 1 << 16  # shingles whose bits are unpacked at once


def _hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()
    joined = b" ".join(words)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    after = list(itertools.accumulate(len(w) + 1 for w in words))
    starts, digest = [0, *after], xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts, after[shingle - 1 :])], np.uint64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit SimHash, as a signed long; no words give zero."""
    hashes = _hashes(text or b"", shingle)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int(bits.view(">i8")[0])


def add_fingerprint(df: DataFrame, text: str, name: str, shingle: int) -> DataFrame:
    """df + bigint `name`. ASCII letters are lower-cased and words end at ASCII white space."""

    def compute(texts):
        raw = texts.cast(pa.binary())
        return [pa.array([fingerprint(t, shingle) for t in raw.to_pylist()], pa.int64())]

    return add_columns(df, [text], [T.StructField(name, T.LongType())], compute)


# ---- tiles


def _cut(classes: np.ndarray, counts: np.ndarray, limit: int) -> list[np.ndarray]:
    """Rows of classes grouped to boxes of at most `limit` fingerprints, or of one class."""
    done, todo = [], [np.arange(len(classes))] if len(classes) else []
    while todo:
        rows = todo.pop()
        if len(rows) == 1 or counts[rows].sum() <= limit:
            done.append(rows)
            continue
        spread = np.ptp(classes[rows], axis=0)
        axis = int(spread.argmax())
        order = rows[np.argsort(classes[rows, axis], kind="stable")]
        values = classes[order, axis]
        half = np.cumsum(counts[order]) >= counts[rows].sum() / 2
        border = values[int(half.argmax())]
        cut = int(np.searchsorted(values, border, "left")) or int(np.searchsorted(values, border, "right"))
        todo += [order[:cut], order[cut:]]
    return done


def tile_plan(histogram: list[tuple], limit: int) -> tuple[list[tuple], list[tuple]]:
    """Rows (p0..p3, first tile, number of tiles), and of every tile (tile, lowest and highest counts)."""
    classes = np.array([h[:4] for h in histogram], np.int64).reshape(-1, 4)
    counts = np.array([h[4] for h in histogram], np.int64)
    assigned, boxes = [], []
    for rows in _cut(classes, counts, limit):
        parts = max(1, math.ceil(int(counts[rows].sum()) / limit))
        assigned += [(*map(int, classes[r]), len(boxes), parts) for r in rows]
        ends = [*map(int, classes[rows].min(axis=0)), *map(int, classes[rows].max(axis=0))]
        boxes += [(len(boxes) + k, *ends) for k in range(parts)]
    return assigned, boxes


def near_tiles(boxes: DataFrame, radius: int) -> DataFrame:
    """(i, j) for each pair of different tiles whose boxes lie within the radius, by a range join on the first quarter.

    A tile meets those whose lowest count lies from its own lowest up to its highest and the
    radius, at most 17 values whatever the number of tiles.
    """
    names = [f"{e}{k}" for e in ("l", "h") for k in range(4)]
    left = boxes.selectExpr("tile as i", *[f"{n} as a_{n}" for n in names], f"explode(sequence(l0, h0 + {radius})) as at")
    right = boxes.selectExpr("tile as j", *[f"{n} as b_{n}" for n in names], "l0 as at")
    gap = " + ".join(f"greatest(0, b_l{k} - a_h{k}, a_l{k} - b_h{k})" for k in range(4))
    return left.join(right, "at").filter(f"(a_l0 < b_l0 or i < j) and i <> j and {gap} <= {radius}").select("i", "j")


def _merge(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Give all nodes joined by links u-v the smallest of their labels."""
    while True:
        least = np.minimum(labels[u], labels[v])
        if (labels[u] == least).all() and (labels[v] == least).all():
            return
        for end in (u, v):
            np.minimum.at(labels, labels[end], least)
            np.minimum.at(labels, end, least)
        while (labels != (jumped := labels[labels])).any():
            labels[:] = jumped


def local_roots(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint of a tile, one that stands for all it is connected with inside the tile."""
    labels = np.arange(len(fps))
    for at, u, v in _close(fps, fps, radius):
        if len(u) > at.stop - at.start:  # more than each with itself
            _merge(labels, u, v)
    return fps[labels]


def root_links(left, left_roots, right, right_roots, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the roots of two tiles, no more than connect them."""
    nodes, of = np.unique(np.concatenate([left_roots, right_roots]), return_inverse=True)
    labels = np.arange(len(nodes))
    for _, u, v in _close(left, right, radius):
        if len(u):
            _merge(labels, of[u], of[v + len(left)])
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def _close(left: np.ndarray, right: np.ndarray, radius: int):
    """Pairs within the radius, for one block of rows of the left tile at a time."""
    lines = max(1, (1 << 21) // max(1, len(right)))
    for at in range(0, len(left), lines):
        block = left[at : at + lines]
        u, v = np.nonzero(np.bitwise_count(block[:, None] ^ right[None, :]) <= radius)
        yield slice(at, at + len(block)), u + at, v


def _longs(x) -> np.ndarray:
    return np.asarray(x.values).astype(np.int64).view(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _within(radius: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                fps = _longs(batch.column("fps")[k])
                roots = local_roots(fps, radius)
                lists = [pa.array([x.view(np.int64)], pa.list_(pa.int64())) for x in (fps, roots)]
                yield pa.RecordBatch.from_arrays([batch.column("tile").slice(k, 1), *lists], names=["tile", "fps", "roots"])

    return run


def _between(radius: int):
    def run(batches):
        for pair in sides(batches):
            parts = [_longs(batch.column(c)[0]) for batch in pair for c in ("fps", "roots")]
            a, b = root_links(*parts, radius)
            yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], names=["a", "b"])

    return run


def connected(fingerprints: DataFrame, name: str, radius: int, work: Workspace, limit: int | None = None) -> DataFrame:
    """(name, component) for distinct fingerprints, where chains of links within the radius make a component.

    A tile grows with the root of the number of fingerprints, so that what is sent to
    pairs of tiles stays near the input's size. The driver sees the histogram and one row
    for each tile; pairs of tiles are joined on Spark. Each tile is compared with itself first;
    pairs of tiles then only link the groups found inside them.
    """
    spark = fingerprints.sparkSession
    quarters = [F.bit_count(F.shiftrightunsigned(name, 48 - 16 * i).bitwiseAND(65535)).alias(p) for i, p in enumerate(QUARTERS)]
    classed = fingerprints.select(name, *quarters)
    histogram = [tuple(r) for r in classed.groupBy(*QUARTERS).count().collect()]
    total = sum(h[4] for h in histogram)
    limit = limit or min(1 << 16, max(1 << 11, 16 * math.isqrt(total)))
    assigned, boxes = tile_plan(histogram, limit)
    plan = spark.createDataFrame(assigned, ", ".join(f"{p} int" for p in QUARTERS) + ", first bigint, parts int")
    tiled = classed.join(plan, QUARTERS).withColumn("tile", F.expr(f"first + pmod(xxhash64(`{name}`), parts)"))
    tiles = tiled.groupBy("tile").agg(F.collect_list(name).alias("fps"))
    width = 4 * spark.sparkContext.defaultParallelism
    tiles = tiles.repartition(max(1, min(width, total // limit + 1))).mapInArrow(
        _within(radius), "tile bigint, fps array<bigint>, roots array<bigint>"
    )
    tiles = work.stage(tiles, "tiles")
    ends = ", ".join(f"{e}{k} int" for e in ("l", "h") for k in range(4))
    todo = work.stage(near_tiles(spark.createDataFrame(boxes, f"tile bigint, {ends}"), radius), "near_tiles")
    pairs = todo.count()
    wide = side_by_side(tiles, todo, "tile", max(1, min(pairs, width + pairs // 64)))
    found = components(wide.mapInArrow(_between(radius), "a bigint, b bigint"), work)
    members = tiles.select(F.explode(F.arrays_zip("fps", "roots")).alias("m")).select(F.col("m.fps").alias(name), "m.roots")
    joined = guarded_join(members, found, [("roots", "node")], "left")
    return joined.select(name, F.coalesce("component", "roots").alias("component"))


def grouped(df: DataFrame, ident: str, name: str, radius: int, work: Workspace) -> DataFrame:
    """(fingerprint, component, component_id) for every distinct fingerprint of a table staged before.

    component is one of the fingerprints connected, component_id the smallest non-null
    `ident` among the rows of all that are connected; null if they have none.
    """
    distinct = df.groupBy(name).agg(F.min(ident).alias("_least"))
    distinct = work.stage(distinct, "fingerprints")
    found = connected(distinct.select(name), name, radius, work)
    joined = work.stage(guarded_join(distinct, found, [(name, name)], "inner"), "members")
    least = joined.groupBy("component").agg(F.min("_least").alias("component_id"))
    full = joined.select(name, "component", F.col("component").alias("_of"))
    return guarded_join(full, least, [("_of", "component")], "left").drop("_of")


def near_duplicates(
    df: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 3
) -> DataFrame:
    """One row per row of df: ident, `fingerprint` (16 hex digits), `component_id`.

    Null and empty texts, and texts without words, have fingerprint zero and link like any
    other. Rows with equal fingerprints always share a component; repeated rows stay
    repeated. component_id is the smallest ident reachable, null only if no row of the
    component has one. An empty table gives an empty result. Other columns are not read. Ids
    are taken as long; a text of any length is hashed whole.
    """
    work = Workspace(df.sparkSession)
    narrow = df.select(F.col(f"`{ident}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    prints = work.stage(add_fingerprint(narrow, "_text", "_fp", shingle).select("_id", "_fp"), "prints")
    groups = grouped(prints, "_id", "_fp", radius, work)
    joined = guarded_join(prints, groups, [("_fp", "_fp")], "left")
    return joined.select(
        F.col("_id").alias(ident), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(
    df: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 3
) -> DataFrame:
    """df with one row of each group of near-duplicates: the smallest ident, nulls last, then by a hash of the row.

    Rows equal in every column count as one document; one of them stays. All columns are
    kept as they are.
    """
    work = Workspace(df.sparkSession)
    key = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    narrow = df.select(F.col(f"`{ident}`").cast("long").alias("_id"), key.alias("_key"), F.col(f"`{text}`").alias("_text"))
    prints = add_fingerprint(narrow, "_text", "_fp", shingle)
    prints = work.stage(prints.groupBy("_id", "_key", "_fp").agg(F.count("*").alias("_rows")), "prints")
    groups = grouped(prints.select("_id", "_fp"), "_id", "_fp", radius, work)
    joined = guarded_join(prints, groups, [("_fp", "_fp")], "left")
    order = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_key").alias("k"))
    best = joined.groupBy("component").agg(F.min_by("_key", order).alias("_best"))
    told = guarded_join(joined.withColumn("_of", F.col("component")), best, [("_of", "component")], "left")
    # only rows that go, and repeated rows of which one stays, need to be told; most rows stay
    told = told.select("_key", F.expr("case when _key <> _best then 0 when _rows > 1 then 1 end").alias("_stay"))
    told = work.stage(told.filter("_stay is not null").groupBy("_key").agg(F.max("_stay").alias("_stay")), "told")
    kept = meet(df.withColumn("_key", key), told, "_key")
    alone = kept.filter("_stay is null").select(*df.columns)
    return alone.union(kept.filter("_stay = 1").select(*df.columns).dropDuplicates())
