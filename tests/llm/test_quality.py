"""Ranking, threshold and held-out accuracy."""

import zlib

import numpy as np

from amendry.llm import quality
from amendry.llm.queries import REGISTRY


def test_features_do_not_depend_on_neighbours():
    texts = [b"", b"a", "É é\n\nx!! ##".encode(), b"  ", b"one two one two", b"x" * 5000]
    together = quality.features(texts)
    assert np.isfinite(together).all()
    for k, t in enumerate(texts):
        assert np.allclose(together[k], quality.features([t])[0])
    assert quality.features([]).shape == (0, together.shape[1])


def test_ranking_separates_and_threshold_is_the_quantile():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(500, 4))
    good = x[:, 0] + 0.1 * x[:, 1] > -0.8
    model = quality.learn(x, good)
    score = model.score(x)
    assert ((score >= quality.CUT) == good).mean() > 0.97
    assert (score < quality.CUT).sum() == (~good).sum()


def test_one_label_only_or_none():
    x = np.eye(3)
    assert (quality.learn(x, np.ones(3, bool)).score(x) >= quality.CUT).all()
    assert (quality.learn(x, np.zeros(3, bool)).score(x) < quality.CUT).all()
    assert quality.learn(x[:0], np.ones(0, bool)).score(quality.features([b"a"])).shape == (1,)


def frames(spark):
    docs = [(k, ("fine words here and there " * (k % 7 + 1)) if k % 3 else "!!! ### $$$ " * (k % 5 + 1), 9.0) for k in range(200)]
    docs += [(None, None, None), (300, "", 1.0), (1, "fine words", 2.0)]
    labels = [(k, int(k % 3 > 0)) for k in range(200)] + [(None, 1), (5, None), (4, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_scores_and_filter(spark):
    docs, labels = frames(spark)
    scored = quality.add_score(docs, quality.fit(docs, labels))
    assert scored.columns == ["doc_id", "text", "score"]
    rows = scored.collect()
    assert len(rows) == 203 and all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["score"] >= quality.CUT) == (r["doc_id"] % 3 > 0) for r in rows if r["doc_id"] is not None and r["doc_id"] < 200)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] >= quality.CUT for r in rows)
    assert quality.accepted(docs.limit(0), labels).count() == 0
    assert quality.accepted(docs, labels.limit(0)).count() in (0, 203)


def test_bounded_sample_is_enough(spark):
    docs, labels = frames(spark)
    model = quality.fit(docs, labels, sample=60)
    rows = quality.add_score(docs, model).filter("doc_id < 200").collect()
    assert np.mean([(r["score"] >= quality.CUT) == (r["doc_id"] % 3 > 0) for r in rows]) > 0.95


def plain_features(text):
    """The same numbers by a loop over one text."""
    import math
    import re
    from collections import Counter

    kinds = [0] * 7
    for byte in text:
        c = chr(byte)
        kinds[6 if byte > 127 else 0 if c in " \t\n\x0b\x0c\r" else 1 if c.isdigit() else 2 if c.isupper() else 3 if c.islower() else 4 if c in ",." else 5] += 1
    chars = max(1, len(text))
    raw = re.split(rb"[ \t\n\x0b\x0c\r]+", text)
    raw = [w for w in raw if w]
    some = max(1, len(raw))
    mean = sum(map(len, raw)) / some
    spread = math.sqrt(max(0, sum(len(w) ** 2 for w in raw) / some - mean**2))
    symbol = lambda b: b < 128 and not chr(b).isalnum() and chr(b) not in " \t\n\x0b\x0c\r,."
    bare, alone = sum(symbol(w[-1]) for w in raw) / some, sum(len(w) == 1 and symbol(w[0]) for w in raw) / some
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.lower())
    pairs = list(zip(words, words[1:]))
    share = lambda xs: (len(set(xs)) / max(1, len(xs)), max(Counter(xs).values(), default=0) / max(1, len(xs)))
    (distinct, top), (two, top_two) = share(words), share(pairs)
    logs = [math.log1p(len(text)), math.log1p(len(words))]
    return [*[k / chars for k in kinds], mean, spread, bare, alone, distinct, top, two, top_two, *logs, distinct * logs[1], two * logs[1]]


def test_features_equal_a_plain_loop(spark, sf):
    docs = [(r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts = [b"", b" ", b"a", "Été, 12 ## !\n\tété ".encode(), b"x. y. x. y.", b"word " * 40_000, *docs]
    assert np.allclose(quality.features(texts), [plain_features(t) for t in texts], atol=1e-6)


def test_learning_equals_plain_logistic_regression_on_the_same_pairs(monkeypatch):
    """Newton's method against gradient steps on the same pairs and the same penalty."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(160, 5))
    good = x @ np.array([1.0, -2, 0.5, 0, 0]) + draw.normal(size=160) > -0.7
    model = quality.learn(x, good, pairs=4000)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9), -8, 8)
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    longer, shorter = (best, worst) if len(best) >= len(worst) else (worst, best)
    lines = np.concatenate([longer] * int(np.clip(4000 // len(longer), 1, 64)))
    mates = np.random.default_rng(7).choice(shorter, len(lines))
    gap = z[lines] - z[mates] if longer is best else z[mates] - z[lines]
    w = np.zeros(5)
    for _ in range(20_000):
        w += 0.5 * (gap.T @ (1 / (1 + np.exp(gap @ w))) / len(gap) - quality.RIDGE * w)
    assert np.allclose(model.weights, w, atol=1e-4)
    assert (model.score(x) < quality.CUT).sum() == len(worst)


def test_very_long_text_is_scored_whole(spark):
    long = "fine words here and there " * 300_000
    docs = spark.createDataFrame([(1, long), (2, long + "!!! ### " * 300_000), (3, "")], "doc_id long, text string")
    base, labels = frames(spark)
    model = quality.fit(base, labels)
    got = {r["doc_id"]: r["score"] for r in quality.add_score(docs, model).collect()}
    for k, text in ((1, long), (2, long + "!!! ### " * 300_000), (3, "")):
        assert np.isclose(got[k], model.score(quality.features([text.encode()]))[0])
    assert got[2] < got[1]


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = REGISTRY["op10_quality_classifier"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    right = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(right) > 50 and np.mean(right) > 0.97


def test_features_do_not_depend_on_an_empty_last_text():
    alone = quality.features([b"a b"])[0]
    for texts in ([b"a b", b""], [b"a b", b"", b""], [b"", b"a b", b""], [b"a b", b"c"]):
        found = quality.features(texts)
        assert (found[texts.index(b"a b")] == alone).all()
        assert (found[:, 0] >= 0).all()
