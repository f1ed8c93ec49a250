"""Leaves, proofs and roots against a plain tree built in one process."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from amendry.llm import merkle
from amendry.llm.queries import REGISTRY

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    spelt = ""
    for name in COLUMNS:
        value = text if name == "text" else row[name]
        spelt += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(spelt)


def plain_tree(nodes, fanout):
    """Root and, for each node, the siblings left and right of its path."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            first = p - p % fanout
            run = nodes[first : first + fanout]
            paths[k].append(("".join(run[: p - first]), "".join(run[p - first + 1 :])))
            place[k] = p // fanout
        nodes = [h("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain(rows, fanout=16):
    def tampered(r):
        if r["doc_id"] is None or r["text"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5:
            return r["text"]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])

    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r, plain_leaf(r, r["text"]), plain_leaf(r, tampered(r))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        built[s] = plain_tree([x[1] for x in groups[s]], fanout)
    root, upper = plain_tree([built[s][0] for s in order], fanout) if order else (None, [])
    found = []
    for s, above in zip(order, upper):
        for (r, leaf, other), own in zip(groups[s], built[s][1]):
            path = own + above
            folded = other
            for left, right in path:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path))
            found.append((r["doc_id"], leaf, built[s][0], root, proof, folded, folded == root))
    return sorted(found, key=str)


def result(df, **options):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, lower).otherwise(F.col("text"))
    found = merkle.add_proofs(df, COLUMNS, altered={"text": changed}, **options)
    rows = found.withColumn("proof", merkle.path_digest(F.col("path"))).collect()
    return sorted(
        [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"], r["folded_root"] == r["root"]) for r in rows],
        key=str,
    )


def documents(n, groups):
    """A third of the rows in one source; sources of all sizes beside it."""
    rows = [(k, f"Text {k} " * (k % 4), "en", "hot" if k % 3 == 0 else f"s{k % groups}", k % 9) for k in range(n)]
    return rows + [(n, None, None, None, None), (None, "A b", "en", None, 3), (None, "A b", "en", None, 3), (n + 1, "", "", "", 0)]


@pytest.mark.parametrize(("fanout", "height", "n", "groups"), [(2, 1, 101, 7), (2, 2, 140, 23), (3, 1, 90, 40), (16, 1, 700, 30), (16, 3, 60, 4)])
def test_proofs_equal_a_plain_tree(spark, fanout, height, n, groups):
    rows = documents(n, groups)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    names = SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert result(df, fanout=fanout, height=height) == plain([dict(zip(names, r)) for r in rows], fanout)


def test_one_leaf_one_group_and_no_row(spark):
    df = spark.createDataFrame([(5, "One", "en", "s", 3)], SCHEMA)
    (row,) = merkle.add_proofs(df, COLUMNS).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["path"] == []
    assert merkle.add_proofs(df.limit(0), COLUMNS).collect() == []
    copies = spark.createDataFrame([(1, "x", "en", "s", 1)] * 40, SCHEMA)
    found = merkle.add_proofs(copies, COLUMNS, fanout=2, height=1).collect()
    assert len(found) == 40 and {r["folded_root"] for r in found} == {found[0]["root"]}


def test_extra_columns_and_long_texts(spark):
    rows = [(k, "Long " * 400_000 if k == 1 else "x", "en", "s", 1, 7, "z") for k in range(20)]
    df = spark.createDataFrame(rows, SCHEMA + ", _tree long, _rows string")
    found = merkle.add_proofs(df, COLUMNS, fanout=3, height=1).collect()
    assert len(found) == 20 and all(r["folded_root"] == r["root"] for r in found)
    assert found[0].asDict().keys() == {"doc_id", "leaf", "subroot", "root", "path", "folded_root"}


def test_a_changed_hash_beside_the_path_is_noticed(spark):
    df = spark.createDataFrame(documents(80, 5), SCHEMA)
    row = merkle.add_proofs(df, COLUMNS, fanout=4, height=1).filter("doc_id = 7").first()
    path = [(s["left"], s["right"]) for s in row["path"]]
    assert merkle.fold(row["leaf"], path) == row["root"]
    other = [(left.replace(left[:1], "g", 1) if left else left, right) for left, right in path]
    assert other != path and merkle.fold(row["leaf"], other) != row["root"]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_on_whole_table(spark, scale):
    sf = f"/root/testdata/{scale}"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in REGISTRY["op12_merkle_manifest"](spark, sf).collect()), key=str)
    assert got == plain(rows)
    assert {r[6] for r in got} == {True, False}
