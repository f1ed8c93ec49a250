"""Counts, near words, forms and roots against plain loops."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from amendry.llm import spelling
from amendry.llm.queries import REGISTRY


def plain_words(rows, often=3):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= often}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_near(words):
    """Near words by the strings that losing one letter leaves; each pair is checked."""
    sharing = {}
    for w in words:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            sharing.setdefault(key, []).append(w)
    near = {w: set() for w in words}
    for group in sharing.values():
        for a in group:
            near[a].update(b for b in group if b not in near[a] and is_near(a, b))
    return near


def plain(rows):
    counts = plain_words(rows)
    near = plain_near(counts)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    result = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(result)


def as_rows(found):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect())


def test_one_apart_equals_the_plain_test():
    draw = random.Random(4)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(2, 9))) for _ in range(220)] + ["ab" * 300, "ab" * 300 + "a", "ab" * 299 + "aé"]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    known = spelling.Words(words)
    got = spelling.one_apart(known, i, known, j)
    assert got.tolist() == [is_near(words[a], words[b]) for a, b in zip(i.tolist(), j.tolist())]
    assert got.any()


def test_search_visits_every_vector_in_the_budget(monkeypatch):
    monkeypatch.setattr(spelling, "FRONTIER", 50)
    rows = np.random.default_rng(1).integers(0, 4, (300, 5)).astype(np.uint8)
    trie, leaf = spelling.build(rows, np.full(len(rows), 5))
    assert (rows[leaf] == rows).all()
    found = {(int(r), int(x)) for row, end in spelling.search(trie, rows) for r, x in zip(row, end)}
    gap = rows[None].astype(int) - rows[:, None]
    fits = (np.maximum(gap, 0).sum(axis=2) <= 1) & (np.maximum(-gap, 0).sum(axis=2) <= 1)
    assert found == {(a, int(leaf[b])) for a, b in zip(*np.nonzero(fits))}


def corpus():
    draw = random.Random(9)
    parts = ["ver", "ein", "the", "ing", "é", "ñ", "ation", "s", "un", "a", "ÿ"]
    words = ["".join(draw.choice(parts) for _ in range(draw.randint(2, 4))) for _ in range(150)]
    texts = [(k, " ".join(draw.choice(words[: 10 + 3 * k]) for _ in range(60))) for k in range(60)]
    texts += [(None, " ".join(words)), (None, " ".join(words)), (900, None), (901, ""), (902, "Œuvre Straße STRASSE ×÷×÷×÷ a1b2 Naïve " * 3)]
    return texts + [(903, ("hot" + "xyzzy " * 3) * 2000), (904, ("y" * 3000 + " " + "y" * 2999 + " ") * 4), (905, "abcde abcdf abcdg " * 3),
                    (906, "chainaa " * 3 + "chainab " * 6 + "chainbb " * 12 + "chaimbb " * 30 + "chaimbx " * 4)]


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "visits": 5}, {"block": 40, "visits": 1000}])
def test_whole_results_equal_plain_ones(spark, sizes):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(3)
    got = as_rows(spelling.variants(df, **sizes))
    assert got == plain(rows)
    assert any(r[1] for r in got) and any(r[2] != r[1] and r[1] for r in got)


def test_empty_table_and_words_without_neighbours(spark):
    df = spark.createDataFrame([(1, "alone alone alone")], "doc_id long, text string")
    assert as_rows(spelling.variants(df.limit(0))) == []
    assert as_rows(spelling.variants(df)) == [("alone", None, "alone", 3, 0, None)]


def test_anagrams_share_a_leaf_that_is_split(spark, monkeypatch):
    """Words of one vector fill a block that no level can cut."""
    words = ["".join(p) for p in {tuple(random.Random(k).sample("abcdefg", 7)) for k in range(400)}]
    rows = [(k, f"{w} {w} {w} {w[:-1]}h {w[:-1]}h {w[:-1]}h") for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(spelling.variants(df, block=50, visits=100)) == plain(rows)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_on_whole_table(spark, scale):
    sf = f"/root/testdata/{scale}"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert as_rows(REGISTRY["op11_spelling_variants"](spark, sf)) == plain(rows)
