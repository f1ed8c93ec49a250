"""Encoding against the library, for a byte-pair file and for the same pieces as a unigram model; exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from amendry.llm import pieces
from amendry.llm.queries import REGISTRY

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    draw = random.Random(3)
    odd = ["", " ", "  ", "a", " a", "a ", "   a  b   ", "\n", "a\n\nb", "😀", "é😀 ü", "▁", "a▁b", "<0x41>", "<s>", "</s>", "<unk>",
           "x" * 300, "\t\t", "ﬁ", "日本語 テキスト", "    def f(x):\n        return x**2\n", "don't", "....", "\x00", "a\x00b"]
    letters = "abcdefghijklmnopqrstuvwxyz     ETAON.,!é\n01"
    odd += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    parts = ["th", "e ", "in", "g", " the", " ", "an", "tion", "ab", "s", " re", "  ", "ing", "es", "hel", "lo"]
    return odd + ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(400)]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_same_ids_as_the_library(vocabulary, library, monkeypatch):
    for cached in (pieces.CACHED, 5):
        monkeypatch.setattr(pieces, "CACHED", cached)
        encoder = pieces.Encoder(vocabulary)
        for part in (texts()[:30], texts()):
            assert [ids(r) for r in encoder(part)] == library.encode(part)


def test_whole_documents_equal_the_library(vocabulary, library, spark, sf):
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    coded = pieces.Encoder(vocabulary)(docs)
    assert [ids(r) for r in coded] == library.encode(docs)
    assert [b.decode() for b in pieces.decode(vocabulary, [np.array(ids(r)) for r in coded])] == docs


def test_round_trip_but_for_the_space_mark(vocabulary):
    coded = pieces.Encoder(vocabulary)(texts())
    back = [b.decode() for b in pieces.decode(vocabulary, [np.array(ids(r), np.int64) for r in coded])]
    assert back == [t.replace("▁", " ") for t in texts()]


def test_unigram_scores_are_maximal(vocabulary):
    """The same search by sums of scores, against a plain search over all segmentations."""
    from dataclasses import replace

    own = replace(vocabulary, bpe=False)
    index = {}
    for k, i in enumerate(own.ids[:-1].tolist()):
        index[own.bytes_[i].decode().replace(" ", "▁")] = own.score[k]
    for word in ("▁the", "▁hello", "▁tionable", "▁a", "▁xyzzy", "▁internationalisation"):
        best = [0.0] + [float("-inf")] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(j):
                if word[i:j] in index:
                    best[j] = max(best[j], best[i] + index[word[i:j]])
        got = ids(pieces.encode_words(own, [word])[0])
        score = {i: own.score[k] for k, i in enumerate(own.ids[:-1].tolist())}
        assert sum(score[i] for i in got) == best[-1]
        assert b"".join(own.bytes_[i] for i in got).decode() == word.replace("▁", " ")


def test_rows_stay_and_names_clash(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "the text", "z"), (None, "the text", "z"), (3, "long " * 30000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    flags = pieces.add_ids(df, MODEL, same="TEXT")
    assert flags.columns == ["doc_id", "ids", "TEXT"] and all(r["TEXT"] for r in flags.collect())
    found = pieces.add_ids(df, MODEL, decoded="text")
    assert found.columns == ["doc_id", "ids", "text"]
    got = sorted(((r["doc_id"], r["ids"], r["text"]) for r in found.collect()), key=str)
    assert got == sorted(((i, library.encode(t or ""), t or "") for i, t, _ in rows), key=str)
    assert pieces.add_ids(df.limit(0), MODEL).count() == 0


def test_very_long_text_is_encoded_whole(spark, library):
    long = " ".join(f"wort{k % 9973}é" for k in range(1_200_000))
    (row,) = pieces.add_ids(spark.createDataFrame([(1, long)], "doc_id long, text string"), MODEL, same="same").collect()
    assert row["same"] and row["ids"] == library.encode(long)


def test_query_on_whole_table(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = REGISTRY["op9_sentencepiece"](spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r["round_trip"] and r["ids"] == library.encode(docs[r["doc_id"]]) and r["n_ids"] == len(r["ids"]) for r in rows)


def test_decoding_in_parts(vocabulary, monkeypatch):
    coded = [np.array(ids(r), np.int64) for r in pieces.Encoder(vocabulary)(texts())]
    whole = pieces.decode(vocabulary, coded)
    for held in (1, 7, 100):
        monkeypatch.setattr(pieces, "DECODED", held)
        assert pieces.decode(vocabulary, coded) == whole
    assert pieces.decode(vocabulary, []) == []
