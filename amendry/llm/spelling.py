"""Spelling variants of the words of a corpus, by a trie of frequency vectors.

A word's vector counts its letters by groups of letters. Words at most one insertion,
deletion or replacement apart have vectors that differ by a surplus of at most one and a
deficit of at most one. The trie arranges words by the counts of one group after another;
a depth-first search spends that budget on its way down, and the words of the leaves it
comes to are verified letter by letter.

The top of the trie is cut where a node has few enough words below it, and is sent to all
tasks. Every word goes down it and on to the blocks, sub-tries of bounded size, that it can
still reach; there it meets the block's words. A task returns how many near words it found
for a word and the most frequent one, never the pairs.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.llm.rows import pieces
from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace

LETTERS = "a-zÀ-ÿ"  # after A-Z are lower-cased
LEAST = 5  # code points of a word
OFTEN = 3  # occurrences of a word
TIMES = 2  # a form is so many times as frequent as the word, or more
GROUPS = 20  # of letters, levels of the trie
WIDE = 16  # counts of one group beyond this less one are not told apart in the trie
BLOCK = 1 << 15  # words in a block
BLOCKS = 1 << 14  # with more words than so many blocks hold, blocks grow, so that what all tasks are sent is bounded
VISITS = 1 << 16  # words that look for near ones in a block in one task
HELD = 200_000  # words that a task counts before it passes them on
FRONTIER = 1 << 20  # places in the trie that are gone on from at once
CELLS = 1 << 22  # letters of words compared at once
TOGETHER = 1 << 14  # words that search together


# ---- counting


def garbled(ident: bytes, word: str) -> str:
    """The word, without one letter if the hash of id and word says so."""
    h = zlib.crc32(word.encode(), ident)
    if h % 97:
        return word
    return word[: h % len(word)] + word[h % len(word) + 1 :]


def _counted(batches):
    counts: Counter = Counter()

    def out():
        words, n = pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())
        counts.clear()
        return pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

    find = re.compile(f"[{LETTERS}]{{{LEAST},}}").findall
    for batch in batches:
        for part in pieces(batch):
            texts = part.column("_text").cast(pa.binary()).to_pylist()
            for ident, text in zip(part.column("_id").to_pylist(), texts):
                own = zlib.crc32(f"{'' if ident is None else ident}:".encode())
                for word, n in Counter(find((text or b"").lower().decode("utf-8", "replace"))).items():
                    word = garbled(own, word)
                    if len(word) >= LEAST:
                        counts[word] += n
                if len(counts) > HELD:
                    yield out()
    yield out()


def vocabulary(df: DataFrame, ident: str = "doc_id", text: str = "text", often: int = OFTEN) -> DataFrame:
    """(word, n): words that occur `often` times or more, after letters are lost as `garbled` says."""
    narrow = df.select(F.col(f"`{ident}`").cast("string").alias("_id"), F.col(f"`{text}`").alias("_text"))
    counted = narrow.mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


# ---- vectors


def letter_groups(frequencies: dict[str, int], groups: int) -> dict[str, int]:
    """Letters dealt to groups, the most frequent first, there and back."""
    ranked = sorted(frequencies, key=lambda c: (-frequencies[c], c))
    turn = [*range(groups), *range(groups - 1, -1, -1)]
    return {c: turn[k % (2 * groups)] for k, c in enumerate(ranked)}


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words side by side, and the words' lengths."""
    sizes = np.array([len(w) for w in words], np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), sizes


def vectors(words: list[str], group: dict[str, int], groups: int) -> np.ndarray:
    """Counts per group, at most WIDE - 1 each, a row for every word; letters without a group are in the last."""
    codes, sizes = letter_codes(words)
    table = np.full(int(codes.max(initial=0)) + 1, groups - 1, np.int64)
    for c, g in group.items():
        if ord(c) < len(table):
            table[ord(c)] = g
    cells = np.repeat(np.arange(len(words)), sizes) * groups + table[codes]
    counts = np.bincount(cells, minlength=len(words) * groups)
    return np.minimum(counts, WIDE - 1).astype(np.uint8).reshape(len(words), groups)


# ---- the trie


@dataclass
class Trie:
    """Levels of children: children[d][node * WIDE + count] is a node of the next level, or -1."""

    children: list[np.ndarray]
    ends: list[np.ndarray]  # ends[d][node] is a leaf, or -1


def build(prefixes: np.ndarray, sizes: np.ndarray) -> tuple[Trie, np.ndarray]:
    """Trie of the rows' first `sizes` counts, none of which begins another, and each row's leaf: the first equal row."""
    children, ends = [], []
    node, many, leaf = np.zeros(len(prefixes), np.int64), 1, np.empty(len(prefixes), np.int64)
    rows = np.arange(len(prefixes))
    for level in range(prefixes.shape[1] + 1):
        done = sizes[rows] == level
        own = np.full(many, -1, np.int64)
        last, first = np.unique(node[done], return_index=True)
        own[last] = rows[done][first]
        ends.append(own)
        leaf[rows[done]] = own[node[done]]
        rows, node = rows[~done], node[~done]
        if level == prefixes.shape[1]:
            break
        keys, new = np.unique(node * WIDE + prefixes[rows, level], return_inverse=True)
        table = np.full(many * WIDE, -1, np.int32)
        table[keys] = np.arange(len(keys))
        children.append(table)
        node, many = new, len(keys)
    return Trie(children, ends), leaf


def search(trie: Trie, rows: np.ndarray, budget: int = 3):
    """Every (row, leaf) whose counts on the way differ by a surplus of one and a deficit of one at most.

    Bit 0 of the budget is the surplus that a leaf may have, bit 1 its deficit. Places are
    gone on from in batches, the deepest first, so that no more than a few batches for
    each level wait.
    """
    start = np.arange(len(rows), dtype=np.int32)
    todo = [(0, start, np.zeros(len(rows), np.int32), np.full(len(rows), budget, np.uint8))]
    while todo:
        level, row, node, left = todo.pop()
        if len(row) > FRONTIER:
            half = len(row) // 2
            todo += [(level, row[half:], node[half:], left[half:]), (level, row[:half], node[:half], left[:half])]
            continue
        leaf = trie.ends[level][node]
        over = leaf >= 0
        if over.any():
            yield row[over], leaf[over]
            row, node, left = row[~over], node[~over], left[~over]
        if not len(row):
            continue
        spot = node * np.int32(WIDE) + rows[row, level]
        table = trie.children[level]
        more, less = np.flatnonzero(left & 1), np.flatnonzero(left & 2)
        up, down = spot[more], spot[less]
        inside_up, inside_down = up % WIDE < WIDE - 1, down % WIDE > 0
        more, up, less, down = more[inside_up], up[inside_up] + 1, less[inside_down], down[inside_down] - 1
        found = [table[spot], table[up], table[down]]
        keep = [np.flatnonzero(f >= 0) for f in found]
        who = [row[keep[0]], row[more[keep[1]]], row[less[keep[2]]]]
        rest = [left[keep[0]], left[more[keep[1]]] & 2, left[less[keep[2]]] & 1]
        todo.append(
            (level + 1, np.concatenate(who), np.concatenate([f[k] for f, k in zip(found, keep)]), np.concatenate(rest))
        )


# ---- verification


class Words:
    """Words side by side, for comparing pairs of them."""

    def __init__(self, words: list[str]):
        codes, self.size = letter_codes(words)
        self.codes = np.concatenate([codes, np.zeros(2, np.uint32)])
        self.begin = np.cumsum(self.size) - self.size
        self.first, self.last = self._ends(self.begin), self._ends(self.begin + self.size - 2)

    def _ends(self, at: np.ndarray) -> np.ndarray:
        return self.codes[at].astype(np.uint64) << np.uint64(32) | self.codes[at + 1]


def one_apart(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[j], of two letters or more, differ by exactly one insertion, deletion or replacement.

    They do if what they share at both ends covers all but one letter of the longer one.
    """
    short = np.minimum(a.size[i], b.size[j])
    gap = np.abs(a.size[i] - b.size[j])
    good = gap <= 1
    # of words with five letters or more, two at either end are the same
    good &= (a.first[i] == b.first[j]) | (a.last[i] == b.last[j]) | (short < 5)
    rows = np.flatnonzero(good)
    rows = rows[np.argsort(short[rows], kind="stable")]
    done = 0
    while done < len(rows):
        width = int(short[rows[min(len(rows) - 1, done + 4096)]])
        part = rows[done : done + max(1, min(4097, CELLS // max(1, width)))]
        done += len(part)
        size, x, y = short[part], i[part], j[part]
        width = int(size[-1])
        place = np.arange(width)
        inside = place < size[:, None]
        ahead = (a.codes[np.where(inside, a.begin[x][:, None] + place, 0)] == b.codes[np.where(inside, b.begin[y][:, None] + place, 0)]) & inside
        ends = [(w.begin[k] + w.size[k] - 1)[:, None] for w, k in ((a, x), (b, y))]
        behind = (a.codes[np.where(inside, ends[0] - place, 0)] == b.codes[np.where(inside, ends[1] - place, 0)]) & inside
        shared = [np.where(same.all(axis=1), width, np.argmin(same, axis=1)) for same in (ahead, behind)]
        longer = size + gap[part]
        good[part] = (shared[0] + shared[1] >= longer - 1) & ~((gap[part] == 0) & (shared[0] == size))
    return good


class Index:
    """The words of a block, to be asked for words one apart."""

    def __init__(self, words: list[str], counts: np.ndarray, rows: np.ndarray):
        self.words, self.counts = words, counts
        self.best_first = np.array(sorted(range(len(words)), key=lambda k: (-int(counts[k]), words[k])), np.int64)
        self.rank = np.empty(len(words), np.int64)  # the smaller, the better as a form
        self.rank[self.best_first] = np.arange(len(words))
        self.trie, leaf = build(rows, np.full(len(words), rows.shape[1]))
        self.by_leaf = np.argsort(leaf, kind="stable")
        self.many = np.bincount(leaf, minlength=len(words))
        self.first = np.cumsum(self.many) - self.many
        self.known = Words(words)

    def near(self, words: list[str], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word, the number of words one apart, and the most frequent of them (ties: the smallest), or -1."""
        asked, n_near, form = Words(words), np.zeros(len(words), np.int64), np.full(len(words), len(self.words))
        for row, leaf in search(self.trie, rows):
            size = self.many[leaf]
            ends = np.cumsum(size)
            cut = 0
            while cut < len(leaf):  # candidates in parts
                stop = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + FRONTIER, "right")))
                part, own = slice(cut, stop), size[cut:stop]
                who = np.repeat(row[part], own)
                spot = np.arange(len(who)) - np.repeat(np.cumsum(own) - own, own)
                word = self.by_leaf[spot + np.repeat(self.first[leaf[part]], own)]
                fit = one_apart(asked, who, self.known, word)
                who, word = who[fit], word[fit]
                n_near += np.bincount(who, minlength=len(words))
                np.minimum.at(form, who, self.rank[word])
                cut = stop
        return n_near, np.append(self.best_first, -1)[form]


# ---- the top of the trie


@dataclass
class Top:
    """Prefixes that end in blocks, how many parts a block's words are dealt to, and those that visit it."""

    group: dict[str, int]
    trie: Trie
    parts: np.ndarray
    turns: np.ndarray


def _vectors(group: dict[str, int]):
    def run(batches):
        for batch in batches:
            rows = vectors(batch.column("word").to_pylist(), group, GROUPS)
            raw = rows.tobytes()
            column = pa.array([raw[k : k + GROUPS] for k in range(0, len(raw), GROUPS)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "vector"])

    return run


def top_of(words: DataFrame, group: dict[str, int], total: int, block: int) -> Top:
    """Cuts the trie of a staged table (word, n, vector) where at most `block` words are below a node.

    The driver sees the children of nodes with more words than that, so no more than WIDE
    for each block's worth of words and level.
    """
    spark = words.sparkSession
    done, open_ = [], [b""] if total else []
    for depth in range(GROUPS + 1):
        if not open_:
            break
        wanted = spark.createDataFrame([(bytearray(p),) for p in open_], "above binary")
        cut = words.select(F.substring("vector", 1, max(0, depth - 1)).alias("above"), F.substring("vector", 1, depth).alias("prefix"))
        found = cut.join(F.broadcast(wanted), "above", "left_semi").groupBy("prefix").count().collect()
        found = sorted((bytes(r["prefix"]), r["count"]) for r in found)
        done += [(p, n) for p, n in found if n <= block or depth == GROUPS]
        open_ = [p for p, n in found if n > block and depth < GROUPS]
    rows = np.zeros((len(done), GROUPS), np.uint8)
    for k, (p, _) in enumerate(done):
        rows[k, : len(p)] = list(p)
    trie, _ = build(rows, np.array([len(p) for p, _ in done], np.int64))
    parts = np.array([-(-n // block) for _, n in done], np.int64)
    return Top(group, trie, parts, np.ones(len(done), np.int64))


def _visits(top: Top, rows: np.ndarray):
    """(row, block) for every block that a row's word may have near words in."""
    found = list(search(top.trie, rows))
    return [np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 2


def _counted_visits(sent):
    def run(batches):
        for batch in batches:
            _, block = _visits(sent.value, vectors(batch.column("word").to_pylist(), sent.value.group, GROUPS))
            blocks, n = np.unique(block, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(n, pa.int64())], names=["block", "n"])

    return run


_PLACE = ["block", "part", "turn"]


def _routed(sent):
    """Rows of words at home in a block, for every turn of it, and of words that visit it, for every part."""

    def run(batches):
        top = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                words, counts = part.column("word").to_pylist(), part.column("n").to_numpy()
                rows = vectors(words, top.group, GROUPS)
                drawn = np.array([zlib.crc32(w.encode()) for w in words], np.int64)
                home_row, home = (np.concatenate(x) for x in zip(*search(top.trie, rows, 0)))
                row, block = _visits(top, rows)
                found = []
                for who, where, many, is_home in ((home_row, home, top.turns, True), (row, block, top.parts, False)):
                    copies = many[where]
                    k = np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
                    who, where = np.repeat(who, copies), np.repeat(where, copies)
                    drawn_to = drawn[who] % (top.parts if is_home else top.turns)[where]
                    found.append((where, drawn_to if is_home else k, k if is_home else drawn_to, np.full(len(who), is_home), who))
                where, parts, turns, homes, who = (np.concatenate(x) for x in zip(*found))
                texts = part.column("word").take(pa.array(who))
                columns = [pa.array(where), pa.array(parts), pa.array(turns), pa.array(~homes), texts, pa.array(counts[who])]
                yield pa.RecordBatch.from_arrays(columns, names=[*_PLACE, "visits", "word", "n"])

    return run


def _met(group: dict[str, int]):
    """Near words within each (block, part, turn); rows come sorted, words at home first."""

    def answer(index, words):
        n_near, best = index.near(words, vectors(words, group, GROUPS))
        hit = np.flatnonzero(n_near)
        forms = [index.words[k] for k in best[hit].tolist()]
        columns = [
            pa.array([words[k] for k in hit.tolist()], pa.string()),
            pa.array(n_near[hit]),
            pa.array(forms, pa.string()),
            pa.array(index.counts[best[hit]], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "form", "form_n"])

    def run(batches):
        place, index, home, counts, words = None, None, [], [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in _PLACE], axis=1)
            visits = batch.column("visits").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (visits[1:] != visits[:-1])) + 1
            for a, b in itertools.pairwise([0, *edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if place != (place := tuple(keys[a])):
                    if words:
                        yield answer(index, words)
                    index, home, counts, words = None, [], [], []
                texts = batch.column("word").slice(a, b - a).to_pylist()
                if not visits[a]:
                    home += texts
                    counts.append(batch.column("n").slice(a, b - a).to_numpy())
                    continue
                if index is None:
                    index = Index(home, np.concatenate(counts), vectors(home, group, GROUPS))
                words += texts
                while len(words) >= TOGETHER:
                    yield answer(index, words[:TOGETHER])
                    words = words[TOGETHER:]
        if words:
            yield answer(index, words)

    return run


# ---- Spark


def near_forms(words: DataFrame, work: Workspace, block: int = BLOCK, visits: int = VISITS) -> DataFrame:
    """(word, n_near, form, form_n) for the words of a staged table (word, n) that have words one apart."""
    spark = words.sparkSession
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").groupBy("letter").count()
    group = letter_groups({r["letter"]: r["count"] for r in letters.collect()}, GROUPS)
    placed = work.stage(words.mapInArrow(_vectors(group), "word string, n long, vector binary"), "vectors")
    total = placed.count()
    top = top_of(placed, group, total, max(block, total // BLOCKS))
    sent = spark.sparkContext.broadcast(top)
    counted = placed.select("word").mapInArrow(_counted_visits(sent), "block long, n long").groupBy("block").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        top.turns[r["block"]] = -(-r["n"] // visits)
    sent = spark.sparkContext.broadcast(top)
    places = ", ".join(f"{c} long" for c in _PLACE)
    routed = placed.select("word", "n").mapInArrow(_routed(sent), f"{places}, visits boolean, word string, n long")
    tasks = max(1, int((top.parts * top.turns).sum()))
    dealt = routed.repartition(tasks, *_PLACE).sortWithinPartitions(*_PLACE, "visits")
    met = dealt.mapInArrow(_met(group), "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    found = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return found.select("word", "n_near", "_best.form", (-F.col("_best.n")).alias("form_n"))


def with_roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """(word, form, ...) + root: the last word that following forms comes to. Each round doubles the way gone."""
    base = work.stage(forms, "forms")
    now = base.select("word", F.coalesce("form", "word").alias("root"))
    for turn in itertools.count():
        after = now.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        moved = guarded_join(now, after, [("root", "_word")], "left")
        moved = moved.select("word", F.coalesce("_next", "root").alias("root"), (F.col("_next") != F.col("root")).alias("moved"))
        moved = work.stage(moved, f"roots_{turn}")
        now = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return guarded_join(base, now.withColumnRenamed("word", "_word"), [("word", "_word")], "left")


def variants(
    df: DataFrame, ident: str = "doc_id", text: str = "text", often: int = OFTEN, times: int = TIMES, **sizes: int
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    n_near counts the words that differ by exactly one inserted, deleted or replaced code
    point. form is the most frequent of them, of several the smallest in code-point order,
    if it is at least `times` as frequent as the word; root is the last word that following
    forms comes to, the word itself if it has none. Null and empty texts have no words,
    repeated rows count each, a null id is spelt as nothing, a text or word of any length is
    taken whole, and an empty table gives an empty result. Other columns are not read.
    """
    work = Workspace(df.sparkSession)
    words = work.stage(vocabulary(df, ident, text, often), "words")
    near = near_forms(words, work, **sizes)
    joined = guarded_join(words, near.withColumnRenamed("word", "_near"), [("word", "_near")], "left")
    fits: Column = F.col("form_n") >= times * F.col("n")
    forms = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("form")).alias("form"),
        F.when(fits, F.col("form_n")).alias("form_n"),
    )
    return with_roots(forms, work)
