"""Planes, words and files against the tokenizers library and exact round trips."""

import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from amendry.llm import token_files
from amendry.llm.queries import REGISTRY

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def words():
    return token_files.WordTokenizer(Path(FILE).read_text(encoding="utf-8"))


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 3), max_size=200), st.booleans())
def test_planes_come_back(values, bits):
    ids = np.array(values, np.uint32)
    assert token_files.unpack(token_files.pack(ids, bits), len(ids), bits).tolist() == values


PARTS = ["a", "B", "é", "É", "ß", "'s", "'t", " ", "  ", "\n", ",", ".", "!!", "1", "23", "😀", "e\u0301", "İ", "Σ", "ς", "\x1c", "\x85",
         "\xa0", "\u200b", "<|endoftext|>", "<|startoftext|", "|>", "µ", "ª", "$$$", "-", "don't", "the", "tion", "\x00", "ﬁ", "\t", "\x0b",
         "\u3000", "日本"]


def test_words_have_the_ids_of_whole_texts(words, library, monkeypatch):
    assert words.apart
    draw = random.Random(5)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for cached in (token_files.CACHED, 10):
        monkeypatch.setattr(token_files, "CACHED", cached)
        assert [np.frombuffer(r, words.kind).tolist() for r in words([t.encode() for t in texts])] == expected


def test_other_tokenizers_get_whole_texts():
    file = public_tokenizers.path("byte_bpe_50k.json")
    other = token_files.WordTokenizer(Path(file).read_text(encoding="utf-8"))
    assert not other.apart
    text = "Two  words\n\n and more"
    assert np.frombuffer(other([text.encode()])[0], other.kind).tolist() == Tokenizer.from_file(file).encode(text).ids


@pytest.mark.parametrize("bits", [False, True])
def test_files(spark, tmp_path, library, settings, monkeypatch, bits):
    settings(spark__sql__shuffle__partitions="3", spark__sql__adaptive__enabled="false")
    rows = [(k * 7 % 50, f"text number {k} " * (k % 9)) for k in range(50)]
    rows += [(7, None), (7, "again"), (7, "again"), (None, "no id"), (99, ""), (100, "word " * 20000)]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, start long")
    token_files.write(df, str(tmp_path / "t"), FILE, 2, bits=bits)
    found = token_files.read(spark, str(tmp_path / "t")).collect()
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    expected = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in found), key=str) == sorted(expected, key=str)
    index = token_files.index_of(spark, str(tmp_path / "t")).agg({"n_ids": "sum", "n_docs": "sum"}).first()
    assert sorted(index) == sorted([at, len(rows)])


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write(df, str(tmp_path / "t"), FILE, 2)
    assert token_files.read(spark, str(tmp_path / "t")).count() == 0


def test_query_on_whole_table(spark, sf, library):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    at, expected = 0, []
    for (i, _), e in zip(docs, library.encode_batch([t for _, t in docs], add_special_tokens=False)):
        ids = np.array([*e.ids, 2], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, REGISTRY["op5_token_files"](spark, sf).collect())) == expected
