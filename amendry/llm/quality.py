"""Quality scores by Bradley-Terry pairwise ranking.

Every preference pair holds a document labelled good and one labelled bad. The score is
linear in features of the text; it is learnt by logistic loss on the feature differences
of the pairs. A quantile of the learning rows' scores, the share labelled bad, becomes
the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm.rows import add_columns
from amendry.llm.words import words_of

SAMPLE = 20_000  # labelled rows to learn from, about
PAIRS = 200_000  # preference pairs, about
RIDGE = 1e-2  # on standardised features
CUT = 0.3  # score at the threshold
STEEP = 1.0
TOGETHER = 2 << 20  # bytes of text whose features are taken together

# byte classes: white space, digits, capitals, small letters, full stops and commas, other ASCII, beyond ASCII
_KINDS = 7
_KIND = np.full(256, 5, np.uint8)
_KIND[0x80:] = 6
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[0x30:0x3A], _KIND[0x41:0x5B], _KIND[0x61:0x7B] = 1, 2, 3
_KIND[[0x2C, 0x2E]] = 4


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


def _repeats(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of a document's keys that are distinct, and share of the most frequent one."""
    total = np.maximum(1, np.bincount(doc, minlength=n))
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]) if len(k) else np.empty(0, bool)
    sizes = np.diff(np.append(np.flatnonzero(new), len(k)))
    top = np.zeros(n)
    np.maximum.at(top, d[new], sizes)
    return np.bincount(d[new], minlength=n) / total, top / total


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text: shares of byte classes, word lengths, repetition and size."""
    n = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(size + 1) - size - 1
    raw = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)  # a separator behind every text
    kind = _KIND[raw]
    chars = np.maximum(1, size)
    shares = np.zeros((n, _KINDS))
    if len(raw):
        for k in range(_KINDS):
            shares[:, k] = np.add.reduceat(kind == k, begins, dtype=np.int64)
        shares[:, 0] -= 1  # the separators
    shares /= chars[:, None]
    words = raw_words = np.zeros(n)
    lengths = np.zeros((n, 2))
    # words between white space
    if len(raw):
        inside = np.flatnonzero(np.diff(kind != 0, prepend=False, append=False))
        start, length = inside[::2], inside[1::2] - inside[::2]
        doc = np.searchsorted(begins, start, "right") - 1
        raw_words = np.bincount(doc, minlength=n)
        some = np.maximum(1, raw_words)
        lengths[:, 0] = _per_doc(length, doc, n) / some
        lengths[:, 1] = np.sqrt(np.maximum(0, _per_doc(length.astype(float) ** 2, doc, n) / some - lengths[:, 0] ** 2))
        last = raw[start + length - 1]
        bare = _per_doc(_KIND[last] == 5, doc, n) / some  # words that end in a symbol
        alone = _per_doc((length == 1) & (_KIND[raw[start]] == 5), doc, n) / some
    else:
        bare = alone = np.zeros(n)
    at, first, _ = words_of(raw)
    doc = np.searchsorted(begins, at, "right") - 1
    words = np.bincount(doc, minlength=n)
    distinct, top = _repeats(first, doc, n)
    # not a multiplier of the words' own hashes, with which letters could change places unnoticed
    pair = first[:-1] * np.uint64(0xD6E8FEB86659FD93) + first[1:]
    same = doc[:-1] == doc[1:]
    pairs, top_pair = _repeats(pair[same], doc[:-1][same], n)
    logs = np.log1p(np.column_stack([size, words]))
    return np.column_stack(
        [shares, lengths, bare, alone, distinct, top, pairs, top_pair, logs, distinct * logs[:, 1], pairs * logs[:, 1]]
    )


# ---- learning


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, CUT at the threshold."""
        return 1 / (1 + np.exp(-np.clip(STEEP * (self.raw(x) - self.threshold) + np.log(CUT / (1 - CUT)), -700, 700)))


def learn(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS) -> Model:
    """Bradley-Terry scores by Newton's method; without rows of both labels everything is good or bad alike."""
    mean = x.mean(axis=0) if len(x) else np.zeros(features([]).shape[1])
    spread = x.std(axis=0) + 1e-9 if len(x) else np.ones(len(mean))
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(best) or not len(worst):
        return Model(mean, spread, np.zeros(len(mean)), np.inf if len(worst) else -np.inf)
    z = np.clip((x - mean) / spread, -8, 8)
    drawn = np.random.default_rng(7)
    turns = int(np.clip(pairs // max(len(best), len(worst)), 1, 64))
    longer, shorter = (best, worst) if len(best) >= len(worst) else (worst, best)
    lines = np.concatenate([longer] * turns)
    mates = drawn.choice(shorter, len(lines))
    win, lose = (lines, mates) if longer is best else (mates, lines)
    gap = z[win] - z[lose]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(gap @ w, -500, 500)))  # chance that the pair is ranked wrongly
        slope = gap.T @ p / len(gap) - RIDGE * w
        bend = (gap * (p * (1 - p))[:, None]).T @ gap / len(gap) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    scores = np.sort(z @ w)
    k = len(worst)  # the quantile of the share labelled bad, half-way to the next score
    return Model(mean, spread, w, float((scores[k - 1] + scores[k]) / 2))


def held_out(ident: str) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{ident}`").cast("string")), F.lit(5)) == 0, F.lit(False))


def fit(
    df: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """Learn from labelled rows that are not held out.

    Of more than `sample` such labels, about so many are used, chosen by a hash of their id,
    which bounds what is broadcast. Rows with a null id or label teach nothing. Repeated
    labels, and repeated documents of one id, teach once; of several texts under one id the
    one with the smallest features does. Empty texts teach like any other, and equal features
    with different labels both. Only features of the chosen ids reach the driver.
    """
    chosen = labels.select(F.col(f"`{ident}`").alias("_id"), (F.col(f"`{label}`") > 0).cast("int").alias("_label"))
    chosen = chosen.filter("_id is not null and _label is not null").filter(~held_out("_id")).distinct()
    total = chosen.count()
    if total > sample:
        chosen = chosen.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * sample / total))
    docs = df.select(F.col(f"`{ident}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    found = add_features(docs.join(F.broadcast(chosen), "_id"), "_text", "_x")
    rows = found.groupBy("_id", "_label").agg(F.min("_x").alias("_x")).toPandas()
    x = np.array([*features([]), *rows["_x"]], np.float64).reshape(len(rows), features([]).shape[1])
    good = rows["_label"].to_numpy(np.float64) > 0
    order = np.lexsort([*x.T, good])
    return learn(x[order], good[order])


def add_features(df: DataFrame, text: str, name: str) -> DataFrame:
    def compute(texts):
        x = features([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
        flat = pa.array(x.ravel())
        return [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), flat)]

    return add_columns(df, [text], [T.StructField(name, T.ArrayType(T.DoubleType()))], compute, TOGETHER)


def add_score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """df + double `name` from 0 to 1; CUT and above counts as good.

    Null and empty texts get the score of an empty text. Equal texts get equal scores. A
    column of df named `name` is replaced; all rows and other columns stay.
    """

    def compute(texts):
        return [pa.array(model.score(features([t or b"" for t in texts.cast(pa.binary()).to_pylist()])))]

    return add_columns(df, [text], [T.StructField(name, T.DoubleType())], compute, TOGETHER)


def accepted(df: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of df whose score reaches CUT, with their own columns.

    A score at CUT itself stays. Null and empty texts are judged by the score of an empty text,
    copies alike, and a text of any length whole. An empty table stays empty; without labels of
    both kinds, rows are kept or dropped all together.
    """
    model = fit(df, labels, ident, text)
    rows = df.select(F.col(f"`{text}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    return add_score(rows, model, "_text", "_score").filter(F.col("_score") >= CUT).select("_row.*")
