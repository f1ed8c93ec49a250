"""Fingerprints, tiles and components against plain counterparts."""

import random
import re

import numpy as np
import xxhash

from amendry.llm import simhash
from amendry.llm.queries import REGISTRY


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_print(text, shingle):
    w = words(text)
    grams = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    label = list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def expected(rows, shingle, radius):
    prints = [plain_print(t, shingle) for _, t in rows]
    groups = plain_groups(prints, radius)
    least = {}
    for (ident, _), g in zip(rows, groups):
        if ident is not None:
            least[g] = min(ident, least.get(g, ident))
    return sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, groups)), key=str)


TEXTS = [None, "", " \n\t", "One", "one two three", "one two three four", "ONE  two\nthree four five", "é É ü", "a b c d e f g h"]


def test_edges_ties_and_repeated_rows(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, "One"), (None, "zz yy xx"), (None, None), (40, "a b c d e f g h")]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, fingerprint string, component_id long")
    found = simhash.near_duplicates(df, shingle=4, radius=4)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows, 4, 4)


def test_group_without_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "lone words here"), (1, "b")], "doc_id long, text string")
    assert {tuple(r)[2] for r in simhash.near_duplicates(df).collect()} == {None, 1}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.one_per_group(df.limit(0)).count() == 0


def test_chains_across_many_tiles(spark):
    draw = random.Random(4)
    prints = []
    for _ in range(60):
        p = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):
            prints.append(p)
            for b in draw.sample(range(64), draw.randint(0, 4)):
                p ^= 1 << b
    prints = sorted(set(prints))
    from amendry.sources.workspace import Workspace

    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = dict(map(tuple, simhash.connected(df, "fp", 4, Workspace(spark), limit=16).collect()))
    groups = plain_groups(prints, 4)
    assert len(found) == len(prints)
    assert len(set(zip(groups, (found[s] for s in signed)))) == len(set(groups)) == len(set(found.values()))


def test_tiles_skipped_are_too_far_apart(spark):
    draw = np.random.default_rng(3)
    prints = draw.integers(0, 1 << 63, 800, np.uint64)
    quarter = lambda p: tuple(bin(int(p) >> s & 65535).count("1") for s in (48, 32, 16, 0))
    counts = {}
    for p in prints:
        counts[quarter(p)] = counts.get(quarter(p), 0) + 1
    assigned, boxes = simhash.tile_plan([(*k, n) for k, n in counts.items()], 50)
    tile = {r[:4]: r[4] for r in assigned}
    ends = ", ".join(f"{e}{k} int" for e in ("l", "h") for k in range(4))
    pairs = [tuple(r) for r in simhash.near_tiles(spark.createDataFrame(boxes, f"tile bigint, {ends}"), 12).collect()]
    gap = lambda x, y: sum(max(0, y[1 + k] - x[5 + k], x[1 + k] - y[5 + k]) for k in range(4))
    plain = {(x[0], y[0]) for x in boxes for y in boxes if x[0] < y[0] and gap(x, y) <= 12}
    assert sorted((min(p), max(p)) for p in pairs) == sorted(plain)
    near = plain | {(t, t) for t in tile.values()}
    for i, p in enumerate(prints):
        for q in prints[:i]:
            if bin(int(p ^ q)).count("1") <= 12:
                a, b = tile[quarter(p)], tile[quarter(q)]
                assert (min(a, b), max(a, b)) in near


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "a b c d e f", "x"), (3, "A b c d e f", "y"), (3, "A b c d e f", "y"), (9, "q r s t u v w", "z"), (None, "m n o p", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    kept = simhash.one_per_group(df, shingle=4, radius=4)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_very_long_text_is_hashed_whole(spark):
    """A text beyond one slice and one block of shingles, and its copy but for the last word."""
    long = " ".join(f"w{k % 5003}" for k in range(900_000))
    rows = [(1, long), (2, long + " end"), (3, "other words " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.near_duplicates(df, shingle=4, radius=4).collect())) == expected(rows, 4, 4)


def test_query_on_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = REGISTRY["op8_simhash_near_dedup"](spark, sf).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, 4, 4)
