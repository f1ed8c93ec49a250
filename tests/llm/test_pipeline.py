"""The corpus pipeline against plain counterparts of its stages, each on what the one before kept."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from amendry.llm.queries import REGISTRY
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_secret_scan import plain_redacted
from tests.llm.test_simhash import expected as plain_simhash


def plain_pipeline(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r["doc_id"] for r in REGISTRY["op10_quality_classifier"](spark, sf).collect() if r["predicted"]}
    left = [(i, t) for i, t in docs.items() if i in good]
    yield dict(left)
    first = {i for i, _, c in plain_simhash(left, 4, 4) if i == c}
    left = [(i, t) for i, t in left if i in first]
    yield dict(left)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]

    def contaminated(text):
        n, hit, _ = plain_hits(text, items, 13)
        return hit > 0 and 20 * hit >= n

    left = [(i, t) for i, t in left if not contaminated(t)]
    yield dict(left)
    left = [(i, plain_redacted(t)) for i, t in left]
    yield dict(left)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    yield {i: library.encode(t) for i, t in left}


def test_stages_and_run(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, last = docs.columns, len(corpus_pipeline.STAGES) - 1
    assert [n.split()[0] for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "benchmark", "secret", "sentencepiece"]
    for turn, ((name, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, plain_pipeline(spark, sf), strict=True)):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{turn}")
        docs = spark.read.parquet(f"{tmp_path}/{turn}")
        value = "ids" if turn == last else "text"
        rows = docs.collect()
        assert len(rows) == len(expected), name
        assert {r["doc_id"]: r[value] for r in rows} == expected, name
        if turn < last:
            assert docs.columns == columns
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, rows))


def test_empty_and_odd_documents(spark, tmp_path, sf):
    """Nulls, repeated rows and extra columns go through all stages."""
    import shutil

    for name in ("benchmark", "labels"):
        shutil.copy(f"{sf}/{name}.parquet", tmp_path)
    real = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame(
        [(None, None, None, None, None)] + [(9001, "plain words of a document", "en", "s", 25)] * 2 + [(9002, "", "en", None, 0)], real.schema
    )
    docs = real.limit(20).union(extra).selectExpr("*", "1 as _row", "'x' as spans", "2 as component")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    rows = docs.collect()
    ids = [r["doc_id"] for r in rows]
    assert ids.count(9001) <= 1 and len(ids) == len(set(ids))
    none = real.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
    assert none.count() == 0


def test_last_stage_checks_the_round_trip(spark, sf):
    docs = spark.createDataFrame([(1, "plain words of a document"), (2, ""), (3, None)], "doc_id long, text string")
    rows = corpus_pipeline.encoded(spark, docs, sf).collect()
    assert {r["doc_id"]: (r["n_tokens"] > 0, r["round_trip"]) for r in rows} == {1: (True, True), 2: (False, True), 3: (False, True)}
