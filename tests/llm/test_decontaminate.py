"""Suffix arrays and windows against a word-by-word search."""

import hashlib
import random
import re

import numpy as np

from amendry.llm import decontaminate, words
from amendry.llm.queries import REGISTRY


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, window):
    own, hit, ids = plain_words(text), set(), set()
    for ident, other in items:
        w = plain_words(other)
        parts = {tuple(w[k : k + window]) for k in range(max(1, len(w) - window + 1))} - {()}
        for part in parts:
            for s in range(len(own) - len(part) + 1):
                if tuple(own[s : s + len(part)]) == part:
                    hit.update(range(s, s + len(part)))
                    ids.add(ident)
    return len(own), len(hit), sorted(ids - {None})


def test_random_texts_over_small_shards(monkeypatch):
    for seed in range(200):
        draw = random.Random(seed)
        letters = ["a", "b", "é", "C"][: draw.randint(1, 4)]
        make = lambda n: "".join(draw.choice([" ", ". ", "\n"]) + draw.choice(letters) for _ in range(n))  # noqa: B023, E731
        items = [(i, make(draw.randint(0, 9))) for i in range(draw.randint(0, 5))]
        docs = [make(draw.choice([0, 1, 5, 30, 60])) for _ in range(draw.randint(1, 6))]
        window = draw.randint(1, 6)
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", draw.choice([7, 20, 1000]))
        monkeypatch.setattr(words, "SEGMENT", draw.choice([5, 64, 1 << 20]))
        tests = decontaminate.test_suffixes(items, window)
        for doc, found in zip(docs, decontaminate.find([d.encode() for d in docs], tests)):
            n, runs, ids, longest = found
            assert (n, sum(e - s for s, e in runs), ids) == plain(doc, items, window)
            if longest:
                item, place, start, size = longest
                own, other = plain_words(doc), plain_words(dict(items)[item])
                assert own[start : start + size] == other[place : place + size]


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(1)
    for n, kinds in ((1, 1), (50, 2), (300, 3), (300, 200)):
        text = draw.integers(0, kinds, n)
        order = decontaminate.suffix_array(text, n)
        assert [tuple(text[k:]) for k in order] == sorted(tuple(text[k:]) for k in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, item_ids string")


def test_edges_several_blocks_and_clashing_names(spark, monkeypatch):
    long = " ".join(f"w{k}" for k in range(40))
    docs = [(1, None), (2, ""), (3, "x " + long.upper() + " y"), (3, "x " + long.upper() + " y"), (None, "one, two!"), (5, "one"), (6, "..")]
    items = [(1, long), (1, long), (10, long[:60]), (2, "One two"), (None, "one"), (4, None), (5, "?!")]
    df = frame(spark, [(i, t, "old", "old") for i, t in docs])
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        found = decontaminate.add_matches(df, bench)
        got = sorted(
            ((r["doc_id"], r["n_words"], sum(x["end"] - x["start"] for x in r["hit_runs"]), r["item_ids"]) for r in found.collect()), key=str
        )
        assert got == sorted(((i, *plain(t, items, 13)) for i, t in docs), key=str)
    clean = decontaminate.decontaminate(df, bench)
    assert clean.columns == df.columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == [1, 2, 6]
    assert decontaminate.decontaminate(df.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_one_block_at_a_time_and_one_item_as_a_third_of_the_benchmark(spark, monkeypatch):
    draw = random.Random(3)
    words_ = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(draw.choice(words_) for _ in range(20))) for k in range(60)] + [(500, "same words again and again " * 4)] * 30
    docs = [(k, " ".join(items[(k * 7 + j) % len(items)][1] for j in range(k % 4)) + " tail") for k in range(40)] + [(90, items[-1][1])] * 25
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    sizes, block = [], decontaminate.test_suffixes
    monkeypatch.setattr(decontaminate, "test_suffixes", lambda rows, window: sizes.append(sum(len(t) for _, t in rows)) or block(rows, window))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    found = decontaminate.add_matches(df, bench)
    got = sorted((r["doc_id"], r["n_words"], sum(x["end"] - x["start"] for x in r["hit_runs"]), r["item_ids"]) for r in found.collect())
    assert got == sorted((i, *plain(t, set(items), 13)) for i, t in docs)
    assert len(sizes) > 5 and max(sizes) < 2500  # the repeated item is in one block, once


def test_very_long_text_goes_through_in_shards(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 5000)
    long = " ".join(f"x{k % 977}" for k in range(60_000))
    item = " ".join(f"x{k}" for k in range(100, 130))
    found = decontaminate.add_matches(spark.createDataFrame([(1, long)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    (row,) = found.collect()
    assert (row["n_words"], sum(x["end"] - x["start"] for x in row["hit_runs"]), row["item_ids"]) == plain(long, [(7, item)], 13)


def test_query_on_whole_table(spark, sf):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = REGISTRY["op4_benchmark_decontamination"](spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, ids = plain(docs[r["doc_id"]], items, 13)
        listed = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(ids), listed)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
