"""Trigram queries and spans against Python's own matching."""

import random
import re

import pytest

from amendry.llm import secret_scan
from amendry.llm.secret_scan import Rule, trigram_query

EITHER = lambda w: "".join(f"[{c}{c.upper()}]" for c in w)
ASSIGN = re.compile(
    "(" + "|".join(map(EITHER, ("password", "passwd", "secret", "token"))) + f"|{EITHER('api')}_?{EITHER('key')})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def plain_redacted(text):
    merged, out, at = [], "", 0
    for s, _, e in plain(text):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out, at = out + text[at:s] + "[SECRET]", e
    return text and out + text[at:]


def texts():
    draw = random.Random(1)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", ":", "=", " ", '"', "'", "abcdef0123456789", "AKIA",
             "ABCDEFGHIJKLMN", "é", "\n", "😀", "x", "deadbeefdeadbeefdead", "K", "ſecret", "password=abc"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    return [None, "", *made, "deadbeefdeadbeef " * 1500, "token: abcdefabcdefabcdef"]


@pytest.mark.parametrize(
    "pattern, query",
    [
        ("AKIA[A-Z0-9]+", [["aki", "kia"]]),
        ("[0-9a-f]+", [[]]),
        ("ab(cd|ef)g", [["abc", "bcd", "cdg"], ["abe", "bef", "efg"]]),
        ("abc.*xyz", [["abc", "xyz"]]),
        ("(abc|x)+", [[]]),
        ("(abc)+d?", [["abc"]]),
        ("abc*", [[]]),
        ("Ab_?c", [["ab_", "b_c"], ["abc"]]),
    ],
)
def test_trigram_queries(pattern, query):
    assert trigram_query(pattern) == query


def test_every_match_satisfies_its_query():
    draw = random.Random(2)
    patterns = ["(foo|ba[rz])+qux?", "a{1}bcd(ef)?", "(?i)Token[:=]", "x(yz|yw)[0-9]{2}end", secret_scan.RULES[0].pattern]
    for pattern in patterns:
        query = trigram_query(pattern)
        for _ in range(3000):
            text = "".join(draw.choice(["foo", "bar", "baz", "qu", "x", "abcd", "ef", "token", ":", "yz", "yw", "1", "end"]) for _ in range(6))
            for m in re.finditer(pattern, text):
                assert any(all(t in m[0].lower() for t in c) for c in query)


def test_spans_and_redaction(spark):
    rows = [(k, t, "old") for k, t in enumerate(texts())] + [(None, "token=0123456789abcdef", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secret_scan.add_spans(df)
    assert found.columns == ["doc_id", "text", "spans"]
    got = [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(((i, plain(t)) for i, t, _ in rows), key=str)
    clean = secret_scan.redacted(df)
    assert clean.columns == df.columns
    assert sorted(map(tuple, clean.collect()), key=str) == sorted(((i, plain_redacted(t), o) for i, t, o in rows), key=str)
    assert secret_scan.add_spans(df.limit(0)).count() == 0


def test_rules_with_and_without_trigrams_only(spark):
    df = spark.createDataFrame([(1, "abcabc 12 34"), (2, "zzz")], "doc_id long, text string")
    for rules in ((Rule("n", "[0-9]+"),), (Rule("abc", "abc"),)):
        got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secret_scan.add_spans(df, rules=rules).collect()}
        assert got == {i: [(m.start(), 0, m.end()) for m in re.finditer(rules[0].pattern, t)] for i, t in ((1, "abcabc 12 34"), (2, "zzz"))}
