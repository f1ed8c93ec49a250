"""Token ids in binary tables: byte or bit planes, compressed one by one, with a chunk index.

A chunk holds whole documents. Its ids are cut into blocks of a fixed size; each block is
transposed, so that the n-th byte (or bit) of all its ids lies side by side, and every
plane is compressed with zstandard. Chunks are rows of a Parquet table that Spark writes
and commits, one shard per task, in ascending order of documents. The chunk index is a
second, small table with the place of every chunk's first id among all ids.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amendry.llm.rows import pieces

BLOCK = 1 << 16  # ids transposed together
CHUNK = 1 << 18  # ids after which a chunk ends with the document
LEVEL = 1
CACHED = 1_000_000  # words whose ids a task remembers before it starts anew

# ---- planes


def pack(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Compressed planes of a block of unsigned 32-bit ids, lowest first, less the zero planes at the end."""
    wide = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(wide, axis=1, bitorder="little").T, axis=1)
    else:
        planes = np.ascontiguousarray(wide.T)
    used = np.flatnonzero(planes.any(axis=1))
    press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    return [press.compress(p.tobytes()) for p in planes[: used[-1] + 1 if len(used) else 0]]


def unpack(planes: list[bytes], n: int, bits: bool = False) -> np.ndarray:
    full = np.zeros((32, -(-n // 8)) if bits else (4, n), np.uint8)
    expand = zstandard.ZstdDecompressor()
    for k, p in enumerate(planes):
        full[k] = np.frombuffer(expand.decompress(p), np.uint8)
    if bits:
        wide = np.packbits(np.unpackbits(full, axis=1, count=n).T, axis=1, bitorder="little")
    else:
        wide = np.ascontiguousarray(full.T)
    return wide.reshape(-1).view("<u4")


# ---- the tokenizer


class WordTokenizer:
    """A tokenizer of the tokenizers library, with the ids of words remembered.

    A tokenizer that drops white space and lets no token cross it gives a text the ids of
    its words, one after another. Such words are looked up; words never met are encoded by
    the library, many in one call. Any other tokenizer encodes whole texts.
    """

    # letters with one small form, stable under composition; marks behind them are a token of their own
    _PLAIN = re.compile("[a-zß-öø-ÿ]+")
    _MARKS = re.compile(
        rb"([!-&(-/:-@\[-`{-~](?:(?<=[a-z].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))[!-&(-/:-@\[-`{-~]*)(?=[\t-\r ]|\Z)"
    )

    def __init__(self, json_text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(json_text)
        self.bare = Tokenizer.from_str(json_text)  # for plain small words between single spaces
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.kind = np.dtype("<u2" if len(self.last) <= 1 << 16 else "<u4")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = ["ab", "c,", "Dé", ".", "1", "'s", "x"]
        self.added = [a.encode() for a in added]
        self.apart = bool(suffix) and not any(c.isspace() for a in added for c in a) and all(
            self._plain([text])[0] == b"".join(self._plain(probe))
            for text in (space.join(probe) for space in (" ", "  ", "\n", "\t", "\r\n", "\v\f"))
        ) and self._plain(["Word,", "dé..", "w%%%"]) == [b"".join(self._plain(p)) for p in (["word", ","], ["dé", ".."], ["w", "%%%"])]
        self.known: dict[bytes, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _small(self, words: list[str]) -> list[bytes]:
        """Ids of words of small letters, each ending where a token ends a word."""
        out = []
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            ids = np.array(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):
                out += self._plain(part)
                continue
            flat, cuts = ids.tobytes(), [0, *(ends * self.kind.itemsize).tolist()]
            out += [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _learn(self, new: list[bytes]) -> None:
        words = [w.decode("utf-8", "replace") for w in new]
        plain = self._PLAIN.fullmatch
        sure = [k for k, w in enumerate(words) if plain(w)]
        self.known.update(zip([new[k] for k in sure], self._small([words[k] for k in sure])))
        odd = sorted(set(range(len(words))).difference(sure))
        self.known.update(zip([new[k] for k in odd], self._plain([words[k] for k in odd])))

    def _cut(self, text: bytes) -> list[bytes]:
        """Words, less their marks; capitals only where a special token could come of them."""
        small = text.lower()
        if any(a in small for a in self.added):
            return text.split()
        return self._MARKS.sub(rb" \1", small).split()

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as numbers of type `kind`."""
        if not self.apart:
            return self._plain([t.decode("utf-8", "replace") for t in texts])
        cut = [self._cut(t) for t in texts]
        new = list(set().union(*cut).difference(self.known))
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
            new = list(set().union(*cut))
        self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in cut]


# ---- tables

_last: dict[str, WordTokenizer] = {}


def _tokenizer(sent, name: str) -> WordTokenizer:
    """The tokenizer a worker process used last, with the words it knows, or a new one."""
    if name not in _last:
        _last.clear()
        _last[name] = WordTokenizer(sent.value)
    return _last[name]


CHUNKS = (
    "shard int, chunk int, first bigint, n_ids bigint, bits boolean, doc_ids array<bigint>, doc_ends array<bigint>, "
    "blocks array<struct<n: int, planes: array<binary>>>"
)
_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.bool_()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))]))),
    ]
)


def _chunk_rows(sent, digest: str, end: int, bits: bool):
    def run(batches):
        encoder = _tokenizer(sent, digest)
        tail = np.array([end], encoder.kind).tobytes()
        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        names, ids, held = [], [], 0

        def close():
            flat = np.frombuffer(b"".join(ids), encoder.kind)
            ends = np.cumsum([len(i) // encoder.kind.itemsize for i in ids])
            blocks = [
                {"n": len(part), "planes": pack(part, bits)}
                for part in (flat[k : k + BLOCK] for k in range(0, len(flat), BLOCK))
            ]
            row = [[shard], [chunk], [first], [len(flat)], [bits], [list(names)], [ends.tolist()], [blocks]]
            return len(flat), pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            for part in pieces(batch):
                texts = [t or b"" for t in part.column("_text").cast(pa.binary()).to_pylist()]
                for name, found in zip(part.column("_id").to_pylist(), encoder(texts)):
                    names.append(name)
                    ids.append(found + tail)
                    held += len(ids[-1]) // encoder.kind.itemsize
                    if held >= CHUNK:
                        n, row = close()
                        yield row
                        names, ids, held = [], [], 0
                        chunk, first = chunk + 1, first + n
        if names:
            yield close()[1]

    return run


def write(
    df: DataFrame, folder: str, tokenizer_file: str, end: int, ident: str = "doc_id", text: str = "text", bits: bool = False
) -> None:
    """Write the ids of every text, followed by `end`, in ascending order of `ident`.

    Nulls come first; equal idents are ordered by a hash of the text, and a hot one can
    span shards. Null and empty texts have only the end id, repeated rows are written each,
    and a text of any length is encoded whole and cut into blocks with the others. An empty
    table gives files without documents. Ids of documents are taken as long. Other columns
    are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{ident}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    order = ["_id", "_hash", "_part"]
    keyed = rows.withColumns({"_hash": F.xxhash64("_text"), "_part": F.spark_partition_id()})
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")
    settings = Path(tokenizer_file).read_text(encoding="utf-8")
    sent, digest = spark.sparkContext.broadcast(settings), hashlib.sha256(settings.encode()).hexdigest()
    chunks = ranged.mapInArrow(_chunk_rows(sent, digest, end, bits), CHUNKS)
    chunks.write.mode("overwrite").option("compression", "none").parquet(f"{folder}/chunks")
    own = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks").select("shard", "chunk", "first", "n_ids", F.size("doc_ids").alias("n_docs"))
    totals = own.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per writing task
    earlier = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("shard", F.coalesce(earlier, F.lit(0)).alias("base"))
    index = own.join(bases, "shard").select("shard", "chunk", (F.col("first") + F.col("base")).alias("first"), "n_ids", "n_docs")
    index.write.mode("overwrite").parquet(f"{folder}/index")


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """One row per chunk: shard, chunk, place of its first id among all ids, number of ids and documents."""
    return spark.read.schema("shard int, chunk int, first bigint, n_ids bigint, n_docs int").parquet(f"{folder}/index")


def _documents(digest: bool):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row] for n in batch.schema.names}
                bits = one["bits"].as_py()
                parts = [unpack([p.as_py() for p in b["planes"]], b["n"].as_py(), bits) for b in one["blocks"]]
                flat = np.concatenate([np.empty(0, np.uint32), *parts]).astype("<u4")
                ends = np.asarray(one["doc_ends"].values).astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                if digest:
                    last = pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64())
                else:
                    offsets = pa.array(np.append(starts, len(flat)).astype(np.int32))
                    last = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int64)))
                base = one["base"].as_py() + one["first"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [one["doc_ids"].values, pa.array(starts + base), pa.array(ends - starts), last],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return run


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """doc_id, start among all ids, n_tokens and ids of every document, or their crc32 instead of the ids."""
    starts = index_of(spark, folder).filter("chunk = 0").select("shard", F.col("first").alias("base"))
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks").join(starts, "shard")
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    return chunks.mapInArrow(_documents(digest), f"doc_id bigint, start bigint, n_tokens bigint, {last}")
