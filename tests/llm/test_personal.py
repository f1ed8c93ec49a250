"""Base rules against their patterns; candidates, trees, thresholds and whole results."""

import hashlib
import random
import re

import numpy as np
import pytest

from amendry.llm import personal
from amendry.llm.queries import REGISTRY

# the contract's patterns, matched plainly
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    values = [int(c) for c in digits][::-1]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_rules_equal_the_patterns():
    draw = random.Random(2)
    pieces = ["a", "é", "@", "@@", ".", "-", "_", "%", "+", " ", "(", ")", "1", "12", "255", "256", "007", "1.2.3.4", "x@y.z", "+1 ",
              "4111111111111111", "4111-1111 1111 1111", "555-3824", "\n", "٣"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 30))) for _ in range(20_000)]
    texts += ["a@b.c_d@e.f", "a@b.c@d.e", "a@@b.c", "1.2.3.4.5.6.7.8", "+1 (269) 555-3296 4524132264652876", "0" * 30 + "1.2.3.4", "@", ""]
    hits = 0
    for text in texts:
        assert personal.base_spans(text) == plain(text), repr(text)
        hits += len(plain(text))
    assert hits > 10_000


def test_base_rules_on_documents(spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert [personal.base_spans(t) for t in docs] == [plain(t) for t in docs]


def test_long_texts_take_no_quadratic_time():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "(" * 200_000, "1 " * 50_000, "at " * 100_000):
        assert isinstance(personal.found_spans(text, None)[0], list)
        assert isinstance(personal.candidates(text), list)


def test_candidates_overlap_and_cover_what_base_rules_miss():
    text = "x +1 (269) 555-3296 4524132264652876 y 8[.]8[.]4[.]4 jo.e [at] mail [dot] example.org or j @ x.org j at x dot org"
    spans = personal.candidates(text)
    parts = {(personal.KINDS[k], text[a:b]) for a, k, b in spans}
    assert {("phone", "+1 (269) 555-3296"), ("card", "4524132264652876"), ("ip", "8[.]8[.]4[.]4"), ("email", "jo.e [at] mail [dot] example.org"),
            ("email", "j @ x.org"), ("email", "j at x dot org"), ("phone", "(269) 555-3296")} <= parts
    assert any(a < d and c < b for a, _, b in spans for c, _, d in spans if (a, b) != (c, d))
    assert personal.candidates("token = 0641917ea4e9 and ab12345678cd") == []


def test_trees_follow_a_plain_rule_and_thresholds_keep_the_precision():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4000, 47))  # a number of its own, so that the rows stay the same when features are added
    x[:, : len(personal.KINDS)] = np.eye(len(personal.KINDS))[draw.integers(0, 3, 4000)]
    y = ((x[:, 6] > 0.3) & (x[:, 9] < 1) | (x[:, 12] > 1.2)).astype(float)
    trees = personal.boost(x[:3000], y[:3000])
    scores = trees.score(x[3000:])
    assert ((scores > 0.5) == y[3000:]).mean() > 0.97
    cuts = personal.calibrated(trees, x[3000:], y[3000:], 0.95)
    assert np.isinf(cuts[3])  # no candidate of that kind
    for kind in range(3):
        own = x[3000:, kind] > 0
        taken = own & (scores >= cuts[kind])
        assert y[3000:][taken].mean() >= 0.95 and taken.sum() > 0.9 * y[3000:][own].sum()


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    return personal.fit(docs)


def held_out(spark):
    """Documents of another scale, whose base spans are respelt in the ways of the examples; no span of theirs was learnt from."""
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        for start, kind, end in personal.base_spans(r["text"]):
            own = r["text"][start:end]
            for spelt, parts in personal._respelt(kind, own, random.Random(own[::-1])):
                yield f"some words here {spelt} and more", parts


def test_respelt_data_are_found_and_broken_ones_left(spark, model):
    """What the model adds is judged; of other numbers, one in ten passes the base rule for cards by chance and must stay."""
    right = wrong = missed = 0
    for text, parts in held_out(spark):
        true = {(personal.KINDS[k], p) for k, p in parts}
        base, more = ({(personal.KINDS[k], text[a:b]) for a, k, b in spans} for spans in personal.found_spans(text, model))
        right, wrong, missed = right + len((base | more) & true), wrong + len(more - true), missed + len(true - base - more)
    assert right > 200 and right / (right + missed) > 0.9 and right / (right + wrong) > 0.95


# Written by hand, not by the rules that make the examples: texts and what to find in them.
# After a first version took '978-3-16-148410-0', '3.14159265358979' and 'met at home dot and', such
# numbers and phrases were added to the examples; SECOND was written before it was tried on either version.
FIRST = [
    ("Call me on 020 7946 0958 after six", ["020 7946 0958"]), ("Tel: 0151-23456789", ["0151-23456789"]), ("phone (030) 901820", ["(030) 901820"]),
    ("mobile 07700 900123", ["07700 900123"]), ("fax 44 20 7946 0958", ["44 20 7946 0958"]), ("pay with 5500.0000.0000.0004 today", ["5500.0000.0000.0004"]),
    ("host 10[.]0[.]0[.]12 is down", ["10[.]0[.]0[.]12"]), ("see 192(.)168(.)1(.)1", ["192(.)168(.)1(.)1"]),
    ("write to anna.b (at) uni-mainz (dot) de", ["anna.b (at) uni-mainz (dot) de"]), ("bob AT site DOT co DOT uk", ["bob AT site DOT co DOT uk"]),
    ("mail: carl @example.org please", ["carl @example.org"]), ("order 20240517 shipped", []), ("ISBN 978-3-16-148410-0", []), ("on 12.05.2021 at 10:30", []),
    ("pi 3.14159265358979", []), ("1 000 000 000 people", []), ("2019 2020 2021 2022 2023", []), ("version 10.4.2.1180", []), ("lot 4111111111111112 failed", []),
    ("scores 12 34 56 78 90 11", []), ("we met at home dot and then", []), ("serial 0001-2222-3333-4444-5555", []),
]
SECOND = [
    ("reach Eva under 0664 1234567 or 0043 664 7654321", ["0664 1234567", "0043 664 7654321"]), ("dial (212) 664-7665", ["(212) 664-7665"]),
    ("my cell is 415.555.0132.", ["415.555.0132"]), ("Fax 069/12345678 no", []), ("card: 3782 822463 10005 amex", ["3782 822463 10005"]),
    ("6011-0009 9013-9424 expired", ["6011-0009 9013-9424"]), ("dns 8[dot]8[dot]4[dot]4", ["8[dot]8[dot]4[dot]4"]),
    ("gateway 172 [.] 16 [.] 0 [.] 1", ["172 [.] 16 [.] 0 [.] 1"]), ("contact j_doe[at]firma[dot]com", ["j_doe[at]firma[dot]com"]),
    ("ask max.muster {at} gmx {dot} net", ["max.muster {at} gmx {dot} net"]), ("sara at posteo dot de", ["sara at posteo dot de"]),
    ("EAN 4006381333931", []), ("table 1.25 3.50 4.75 6.00 7.25", []), ("sha 1234567 8901234 commits", []), ("coordinates 48.208174 16.373819", []),
    ("we look at stars dot by dot", []), ("from 1914-1918 and 1939-1945", []), ("population 8 916 845 in 2021", []), ("tax id 12/345/67890", []),
    ("e = 2.718281828459", []), ("room 12-34-56, shelf 78-90-12", []), ("section 10(.)2 of act", []),
]


@pytest.mark.parametrize(("cases", "least"), [(FIRST, 5), (SECOND, 7)])
def test_texts_written_by_hand(model, cases, least):
    """Most are found, and clean texts are left alone; 6 of 11 and 8 of 11 when this was written."""
    found = 0
    for text, wanted in cases:
        got = {text[a:b] for a, _, b in sum(personal.found_spans(text, model), [])}
        assert got <= set(wanted), text
        found += len(got)
    assert found >= least


def test_rows_stay_and_odd_texts(spark, model):
    rows = [(1, None, "x"), (2, "", "y"), (None, "a@b.cd", "z"), (None, "a@b.cd", "z"), (3, "é +1 (269) 555-3296 4524132264652876 " * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = personal.add_spans(df, model)
    assert found.columns == ["doc_id", "text", "spans"]
    got = {(r["doc_id"], len(r["spans"])) for r in found.collect()}
    assert found.count() == 5 and got == {(1, 0), (2, 0), (None, 1), (3, 6000)}
    assert personal.add_spans(df.limit(0), model).count() == 0
    assert personal.fit(df.limit(0)) is None
    assert personal.fit(df.filter("doc_id < 3")) is None
    few = personal.fit(df)  # nothing to set thresholds by, or little
    assert all(r["spans"] is not None for r in personal.add_spans(df, few).collect())
    clash = spark.createDataFrame([("a@b.cd", 1, "k")], "text string, _key long, _text string")
    assert personal.add_spans(clash, personal.fit(clash), name="_text").columns == ["text", "_key", "_text"]


def test_fit_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    one, other = personal.fit(docs.repartition(3)), personal.fit(docs.union(docs).repartition(7))
    assert (one.value == other.value).all() and (one.cut == other.cut).all() and (one.thresholds == other.thresholds).all()


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = REGISTRY["op13_personal_data"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain(docs[r["doc_id"]])
        told = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))
        if not re.search("[0-9@]", docs[r["doc_id"]]):
            assert r["spans"] == ""
