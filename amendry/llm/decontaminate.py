"""Benchmark decontamination with suffix arrays over the training text.

Every task sorts the word suffixes of its documents, shard by shard, and binary-searches
every test suffix in each shard's suffix array, one word deeper at a time. A test suffix
that still matches after a whole window gives the locations of that window; the deepest
match is the longest verbatim one. Documents stay where they are read, and only the test
words travel, in blocks of bounded size. One block at a time is on the driver and in the
tasks: what it finds is staged by text before the next one is read, and the last block's pass
joins it all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm.rows import add_columns, pieces, without
from amendry.llm.words import words_of
from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace

WINDOW = 13
BLOCK_BYTES = 8 << 20  # of test text sent to the tasks at once
SHARD_WORDS = 1 << 20  # suffixes in one suffix array
MATCH = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("item_id", "item_word", "doc_word", "n_words")]
)
RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


# ---- suffix arrays


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of a sequence of ranks (0 or more), in the order of their first `depth` words.

    Suffixes are sorted by their first three words, then those still tied by twice as
    many words in each round.
    """
    n, bits = len(words), max(1, int(words.max(initial=0) + 1).bit_length())
    first = min(3, 62 // bits) or 1
    padded = np.concatenate([words + 1, np.zeros(first, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(first):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key)
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    ranks = np.empty(n + 1, np.int64)
    ranks[n] = -1
    ranks[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    have = first
    tied = np.flatnonzero(~head | ~np.append(head[1:], True))
    while have < depth and len(tied):
        here = order[tied]
        group = ranks[here]
        key = (group << 32) | (ranks[np.minimum(here + have, n)] + 1)
        turn = np.argsort(key)
        here, key = here[turn], key[turn]
        order[tied] = here
        head = np.concatenate([[True], key[1:] != key[:-1]])
        ranks[here] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~head | ~np.append(head[1:], True)]
        have *= 2
    return order


def _narrow(text, order, low, high, depth, word):
    """Parts of the ranges [low, high) of the suffix array whose word at `depth` is `word`."""
    sides = []
    for upper in (False, True):
        a, b = low.copy(), high.copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            seen = text[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, len(text) - 1)]
            less = open_ & ((seen <= word) if upper else (seen < word))
            a = np.where(less, mid + 1, a)
            b = np.where(open_ & ~less, mid, b)
        sides.append(a)
    return sides


# ---- test suffixes


@dataclass
class Tests:
    """Words of the test items, one after another, and where each suffix's item and window end."""

    ids: list  # item ids; None for a null one
    item: np.ndarray  # of each word
    left: np.ndarray  # words from here to the end of the item
    window: np.ndarray  # words of the window that starts here; 0 where none does
    place: np.ndarray  # position of the word in its item
    hashes: tuple[np.ndarray, np.ndarray]
    longest: int


def test_suffixes(rows: list[tuple], window: int) -> Tests:
    item, left, size, place, hashes = [], [], [], [], ([], [])
    for k, (_, text) in enumerate(rows):
        _, *found = words_of(np.frombuffer((text or "").encode(), np.uint8))
        n = len(found[0])
        to_end = np.arange(n, 0, -1)
        size.append(np.where(to_end >= window, window, 0) if n >= window else np.where(to_end == n, n, 0))
        item.append(np.full(n, k))
        left.append(to_end)
        place.append(np.arange(n))
        for side, x in zip(hashes, found):
            side.append(x)
    join = lambda xs: np.concatenate([np.empty(0, np.int64), *xs])
    both = tuple(np.concatenate([np.empty(0, np.uint64), *x]) for x in hashes)
    left = join(left)
    return Tests([r[0] for r in rows], join(item), left, join(size), join(place), both, int(left.max(initial=0)))


def _search(text, check, order, tests: Tests, ranks: np.ndarray, keep: int, size: np.ndarray, source: np.ndarray):
    """Windows found in one suffix array, as (test suffix, starts).

    `size` and `source` get the words of the longest match from a start, and its test
    suffix, the first of several. Starts from `keep` on belong to the next shard.
    """
    n = len(ranks)
    active = np.flatnonzero(ranks >= 0)
    low, high = np.zeros(n, np.int64), np.full(n, len(order))
    found = []
    for depth in range(tests.longest):
        if not len(active):
            break
        a, b = _narrow(text, order, low[active], high[active], depth, ranks[active + depth])
        low[active], high[active] = a, b
        active = active[a < b]
        whole = active[(tests.window[active] > 0) & (tests.window[active] <= depth + 1)]
        for q in whole[::-1].tolist():
            starts = order[low[q] : high[q]]
            starts = starts[starts < keep]
            if tests.window[q] == depth + 1:
                # different words of equal first hash are told apart by the second
                seen = check[starts[:, None] + np.arange(depth + 1)]
                starts = starts[(seen == tests.hashes[1][q : q + depth + 1]).all(axis=1)]
                found.append((q, starts))
            size[starts], source[starts] = depth + 1, q
        more = tests.left[active] > depth + 1
        active = active[more]
        active = active[ranks[active + depth + 1] >= 0]
    return found


def find(texts: list[bytes], tests: Tests) -> list[tuple]:
    """For every text: number of words, merged runs of hit words, items, longest match (item, place, start, words)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    at, first, second = words_of(np.frombuffer(b"\0".join(texts), np.uint8))
    doc = np.searchsorted(begins, at, "right") - 1
    count = np.bincount(doc, minlength=len(texts))
    # a rank of 0 ends every document
    known, inverse = np.unique(first, return_inverse=True)
    where = np.arange(len(at)) + doc
    text = np.zeros(len(at) + len(texts), np.int64)
    text[where] = inverse + 1
    check = np.zeros(len(text) + 1, np.uint64)
    check[where] = second
    owner = np.repeat(np.arange(len(texts)), count + 1)
    offset = np.cumsum(count + 1) - count - 1
    spot = np.searchsorted(known, tests.hashes[0])
    ranks = np.full(len(spot), -1)
    if len(known):
        near = np.minimum(spot, len(known) - 1)
        ranks = np.where(known[near] == tests.hashes[0], near + 1, -1)
    cover = np.zeros(len(text) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    size, source = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    for begin in range(0, len(text), SHARD_WORDS):
        end = min(len(text), begin + SHARD_WORDS + tests.longest)
        part = np.append(text[begin:end], 0)
        order = suffix_array(part, tests.longest)
        own = slice(begin, min(end, begin + SHARD_WORDS))
        found = _search(part, check[begin : end + 1], order, tests, ranks, own.stop - begin, size[own], source[own])
        for q, starts in found:
            np.add.at(cover, starts + begin, 1)
            np.add.at(cover, starts + begin + tests.window[q], -1)
            for d in np.unique(owner[starts + begin]).tolist():
                items[d].add(int(tests.item[q]))
    matched = np.flatnonzero(size)
    matched = matched[np.lexsort((matched, -size[matched], owner[matched]))]
    matched = matched[np.diff(owner[matched], prepend=-1) > 0]
    longest = {
        int(owner[s]): (tests.ids[tests.item[q]], int(tests.place[q]), int(s - offset[owner[s]]), int(size[s]))
        for s, q in zip(matched, source[matched])
    }
    edges = np.diff((np.cumsum(cover)[:-1] > 0).astype(np.int8), prepend=0, append=0)
    runs = [[] for _ in texts]
    for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
        runs[owner[s]].append((s - int(offset[owner[s]]), e - int(offset[owner[s]])))
    return [
        (int(count[d]), runs[d], sorted({tests.ids[i] for i in items[d]} - {None}), longest.get(d))
        for d in range(len(texts))
    ]


# ---- Spark


def _united(old, new):
    merged = []
    for s, e in sorted([*old, *new]):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return [tuple(m) for m in merged]


def _items(benchmark: DataFrame, ident: str, text: str, work: Workspace) -> tuple[DataFrame, int]:
    """Distinct items with the number of their block, and how many blocks there are; a block has about BLOCK_BYTES of text."""
    rows = benchmark.select(F.col(f"`{ident}`").cast("long").alias("i"), F.col(f"`{text}`").alias("t"))
    rows = work.stage(rows.filter("t is not null").distinct(), "items")
    size = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    return rows.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks))), blocks


def _block(items: DataFrame, number: int, window: int) -> Tests:
    """Test suffixes of one block; nothing else of the benchmark is collected."""
    return test_suffixes(sorted(map(tuple, items.filter(F.col("block") == number).drop("block").collect()), key=str), window)


_HITS = T.StructType(
    [T.StructField("hit_runs", RUNS), T.StructField("item_ids", T.ArrayType(T.LongType())), T.StructField("longest_match", MATCH)]
)


def _row(runs, ids, match) -> dict:
    return {
        "hit_runs": [dict(zip(("start", "end"), r)) for r in runs],
        "item_ids": ids,
        "longest_match": dict(zip(MATCH.names, match)) if match else None,
    }


def _joined(found: tuple, earlier: list[dict]) -> tuple:
    """What one block found in a text, and what earlier ones did."""
    n, runs, ids, match = found
    for other in earlier:
        runs = _united([(r["start"], r["end"]) for r in other["hit_runs"]], runs)
        ids = sorted({*ids, *other["item_ids"]})
        old = tuple(other["longest_match"][k] for k in MATCH.names)
        match = max((m for m in (old, match) if m), key=lambda m: (m[3], -m[2]))
    return n, runs, ids, match


def _found(texts, tests: Tests) -> list[tuple]:
    return find([t or b"" for t in texts.cast(pa.binary()).to_pylist()], tests)


def _staged_hits(rows: DataFrame, sent, work: Workspace, name: str) -> DataFrame:
    """(_k1, _k2, hits) of the texts that one block's windows occur in, one for each text."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                found = _found(part.column("_text"), sent.value)
                hit = [k for k, f in enumerate(found) if f[1]]
                keys = [part.column(c).take(pa.array(hit, pa.int64())) for c in ("_k1", "_k2")]
                hits = pa.array([_row(*found[k][1:]) for k in hit], _arrow(_HITS))
                yield pa.RecordBatch.from_arrays([*keys, hits], names=["_k1", "_k2", "hits"])

    schema = T.StructType([rows.schema["_k1"], rows.schema["_k2"], T.StructField("hits", _HITS)])
    hits = rows.select("_k1", "_k2", "_text").mapInArrow(run, schema)
    return work.stage(hits.groupBy("_k1", "_k2").agg(F.first("hits").alias("hits")), name)


def add_matches(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """df + n_words, hit_runs, item_ids and longest_match.

    hit_runs are the merged runs [start, end) of words inside any occurrence of a window;
    longest_match is the earliest of the longest verbatim matches that contain a window.
    A null text has no words. A benchmark row with a null or wordless text matches nothing;
    one with a null id marks words but is listed in no item_ids. Repeated items count once
    per id. Item ids are taken as long. Columns of df with these names are replaced; all rows
    and other columns stay. An empty benchmark leaves every list empty, and an empty table
    stays empty. A text of any length is searched whole, shard by shard.
    """
    spark, work = df.sparkSession, Workspace(df.sparkSession)
    items, blocks = _items(benchmark, item_id, item_text, work)
    fields = [T.StructField("n_words", T.LongType()), *_HITS.fields]
    types = [_arrow(f.dataType) for f in fields]
    columns, using, before = without(df, [f.name for f in fields]).columns, [text], df
    if blocks > 1:
        whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        keys = [F.xxhash64(whole).alias("_k1"), F.xxhash64(F.lit(1), whole).alias("_k2")]
        before = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"), *keys)
        hits = None
        for number in range(blocks - 1):
            sent = spark.sparkContext.broadcast(_block(items, number, window))
            staged = _staged_hits(before, sent, work, f"hits_{number}")
            sent.destroy()
            hits = staged if hits is None else hits.union(staged)
        merged = work.stage(hits.groupBy("_k1", "_k2").agg(F.collect_list("hits").alias("_earlier")), "hits")
        before = guarded_join(before, merged, [("_k1", "_k1"), ("_k2", "_k2")], "left").drop("_k1", "_k2")
        using = ["_text", "_earlier"]
    sent = spark.sparkContext.broadcast(_block(items, blocks - 1, window))

    def compute(texts, earlier=None):
        found = _found(texts, sent.value)
        if earlier is not None:
            found = [_joined(f, e or []) for f, e in zip(found, earlier.to_pylist())]
        rows = [(n, *_row(runs, ids, match).values()) for n, runs, ids, match in found]
        return [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]

    marked = add_columns(before, using, fields, compute)
    if blocks > 1:
        marked = marked.select(*[F.col(f"_row.`{c}`") for c in columns], *[f.name for f in fields])
    return marked


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return pa.int64()


def hit_words() -> F.Column:
    return F.expr("aggregate(hit_runs, 0L, (n, r) -> n + r.end - r.start)")


def contaminated(share: int = 20) -> F.Column:
    """At least one word in `share` is hit."""
    return (hit_words() > 0) & (share * hit_words() >= F.col("n_words"))


def decontaminate(
    df: DataFrame, benchmark: DataFrame, text: str = "text", share: int = 20, **names
) -> DataFrame:
    """Rows of df that are not contaminated, with their own columns only."""
    rows = df.select(F.col(f"`{text}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    marked = add_matches(rows, benchmark, "_text", **names)
    return marked.filter(~contaminated(share)).select("_row.*")
