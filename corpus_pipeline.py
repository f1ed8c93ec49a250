"""The corpus pipeline: stages that turn `documents` into training data.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amendry.llm import decontaminate, pieces, quality, queries, secret_scan, simhash
from amendry.sources.workspace import Workspace

ORACLE_SQL = None  # hashing and components are beyond SQL; tests compare with brute force


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null or empty text is judged by the score of an empty one; repeated rows and ties go or
    stay together; texts of any length are judged whole; an empty table stays empty.
    """
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, nulls last.

    Texts without words, null ones too, form one group. Repeated rows count as one document,
    texts of any length are hashed whole, and an empty table stays empty.
    """
    return simhash.one_per_group(docs, "doc_id", "text", queries.SHINGLE, queries.BITS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window.

    Null and empty texts have no words and stay; repeated rows go or stay together; texts of any
    length are searched whole; an empty table stays empty.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced and their length counted anew.

    Null texts stay null, with a null length; all rows stay, repeated ones too; texts of any
    length are scanned whole; an empty table stays empty.
    """
    clean = secret_scan.redacted(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, token ids and number of tokens of every document left, and whether they decode to its text.

    Null and empty texts have no ids; all rows stay, repeated ones too; texts of any length are
    encoded whole; an empty table gives no rows.
    """
    coded = pieces.add_ids(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), same="round_trip")
    return coded.select("doc_id", "ids", F.size("ids").alias("n_tokens"), "round_trip")


STAGES = [
    ("quality classifier", good),
    ("simhash near-dedup", dedup),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("sentencepiece encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read back."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for turn, (_, stage) in enumerate(STAGES):
        docs = work.stage(stage(spark, docs, sf_dir), f"stage_{turn}")
    return docs
