"""Links and components against all cosines."""

import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm import embedding_dedup
from amendry.llm.queries import REGISTRY


def plain(rows, least):
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    degree, groups = [0] * len(rows), {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            groups.setdefault(len(v), []).append(k)
    for own in groups.values():
        x = np.array([rows[k][1] for k in own], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for k, near in zip(own, x @ x.T >= least):
            for j in np.flatnonzero(near):
                if own[j] != k:
                    degree[k] += 1
                    a, b = root(k), root(own[j])
                    label[max(a, b)] = min(a, b)
    least_id, used = {}, {k for own in groups.values() for k in own}
    for k in used:
        if rows[k][0] is not None:
            least_id[root(k)] = min(rows[k][0], least_id.get(root(k), rows[k][0]))
    component = [least_id.get(root(k)) if k in used else rows[k][0] for k in range(len(rows))]
    return sorted(((i, degree[k], component[k], component[k] == i) for k, (i, _) in enumerate(rows)), key=str)


def odd_rows():
    draw = np.random.default_rng(1)
    rows = [(None, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [1.0, float("inf")]),
            (6, [1.0, 0.0]), (7, [2.0, -0.0]), (7, [2.0, 0.0]), (None, [1e200, 1e190]), (8, [1.0]), (None, [0.0, 3.0])]
    for _ in range(300):
        centre = draw.normal(size=8)
        for _ in range(draw.integers(1, 4)):
            rows.append((len(rows), (centre + draw.normal(size=8) * draw.choice([0, 0.1, 0.3])).tolist()))
    return [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]


def test_edges_copies_and_several_tiles(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, n_links long")
    for limit in (None, 150):
        found = embedding_dedup.near_duplicates(df, limit=limit)
        assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, found.collect()), key=str) == plain(rows, 0.95)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_no_pair_at_the_border_is_lost():
    draw = np.random.default_rng(5)
    for size in (2, 8, 64, 300, 768, 1100):
        a = embedding_dedup.unit(draw.normal(size=(400, size)))
        side = draw.normal(size=(400, size))
        side -= (side * a).sum(axis=1, keepdims=True) * a
        for cosine, found_all in ((0.95 + 1e-12, True), (0.95 - 1e-9, False)):
            b = cosine * a + np.sqrt(1 - cosine**2) * embedding_dedup.unit(side)
            found = {(int(x), int(y)) for u, v in embedding_dedup.linked_blocks(a, b, 0.95) for x, y in zip(u, v)}
            assert all(((k, k) in found) == found_all for k in range(400))


def test_query_on_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, REGISTRY["op2_embedding_near_dedup"](spark, sf).collect()), key=str) == plain(rows, 0.95)


def test_tiles_beyond_16_bits_keep_all_links():
    right = np.tile([[1.0, 0.0]], (70_000, 1))
    found = sum(len(u) for u, _ in embedding_dedup.linked_blocks(right[:2], right, 0.95))
    assert found == 140_000


def test_scaled_copies_are_spread_over_tiles(spark):
    """Equal directions have equal first projections, so no cut parts them."""
    one = np.random.default_rng(5).standard_normal(8)
    rows = [(k, [float(x) for x in one * (1 + k)]) for k in range(300)]
    rows += [(k, [float(x) for x in np.random.default_rng(k).standard_normal(8)]) for k in range(300, 400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    packed = df.selectExpr("vec_id as node", "embedding")
    folded = embedding_dedup.add_columns(packed, ["embedding"], [T.StructField("_vec", T.BinaryType())], lambda v: [embedding_dedup.pa.array(embedding_dedup._packed(v))])
    folded = embedding_dedup.add_columns(folded.withColumn("size", F.lit(8)), ["_vec", "size"], [T.StructField("along", T.DoubleType())], embedding_dedup._first_projection)
    tiled, pairs = embedding_dedup._tiled(folded, 50, math.sqrt(0.1))
    pairs = [tuple(r) for r in pairs.collect()]
    assert max(r["count"] for r in tiled.groupBy("tile").count().collect()) <= 100
    assert len(set(pairs)) == len(pairs)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, limit=50).collect()}
    assert all(got[k]["n_links"] >= 299 and got[k]["component_id"] == 0 for k in range(300))


def test_windows_suit_the_dimension():
    """Unrelated vectors are told apart at every size by a part of the projections, and all links are found."""
    draw = np.random.default_rng(9)
    for size in (64, 256, 768):
        missed, window, many = embedding_dedup.windows_of(size, 0.95)
        assert many < 0.75 * size and (missed + 1) * window**2 > 0.1  # one more miss lies beyond the distance
        a = embedding_dedup.unit(draw.normal(size=(600, size)))
        a[300:] = embedding_dedup.unit(a[:300] + draw.normal(size=(300, size)) * (0.3 / np.sqrt(size)))
        found = {(int(x), int(y)) for u, v in embedding_dedup.linked_blocks(a, a, 0.95) for x, y in zip(u, v)}
        assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(a @ a.T >= 0.95)))) and len(found) > 600


def test_single_precision_and_tiles_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE_BYTES", 40 * 8 * 16)
    draw = np.random.default_rng(2)
    base = draw.normal(size=(60, 16)).astype(np.float32)
    rows = [(k, [float(x) for x in base[k % 60] + draw.normal(size=16).astype(np.float32) * np.float32(0.05 * (k % 5))]) for k in range(240)]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in rows] + [(300, None), (301, [0.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=str) == plain(rows, 0.95)
