"""Verdicts against a rule-by-rule search."""

import random
import re

from amendry.llm import url_filter
from amendry.llm.queries import URL_RULES


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (small(m[1]), m[2]) if m else ("", "")
    verdicts = {}
    for rule, verdict in rules:
        if rule is not None and verdict is not None:
            verdicts[rule] = max(verdict, verdicts.get(rule, ""))
    best = (-1, -1), None, "allow"
    for rule, verdict in verdicts.items():
        cut = rule.find("/") if "/" in rule else len(rule)
        own, start = small(rule[:cut]), rule[cut:]
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            best = max(best, ((len(own) + len(start), len(own)), rule, verdict))
    return host, path, best[1], best[2]


def test_random_rules_over_many_ranges(spark, settings):
    settings(spark__sql__shuffle__partitions="5")
    draw = random.Random(2)
    labels = ["a", "b", "org", "com", "x-1", "é", "A", "", "a\x01org"]
    host = lambda: ".".join(draw.choice(labels) for _ in range(draw.randint(1, 4)))
    path = lambda: "".join(draw.choice(["/", "a", "b", "es/", "en/1"]) for _ in range(draw.randint(0, 5)))
    rules = [(small(host()) + "/" + path(), draw.choice(["allow", "block"])) for _ in range(60)]
    rules += [(None, "block"), ("a/", None), ("org", "block"), ("b/", "allow"), ("b/", "block")]
    urls = [None, "", "x", "://", "http://", "http://a.org", "http://a.org?x/", "http://a.b#"]
    urls += [draw.choice(["http://", "s://", "://x://"]) + host() + path() + draw.choice(["", "?q", "#f"]) for _ in range(800)]
    rows = [(k, u, "old") for k, u in enumerate(urls)] + [(None, "http://a.org/", None)] * 400
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_filter.add_verdicts(df, spark.createDataFrame(rules, "rule string, verdict string"))
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted(((i, u, *plain(u, rules)) for i, u, _ in rows), key=str)


def test_allowed_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://example.org/es/a", "v"), (2, "http://b.com/fr/", "w")], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    kept = url_filter.allowed(df, rules)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(2, "http://b.com/fr/", "w")]
    assert url_filter.allowed(df.limit(0), rules).count() == 0
    assert url_filter.allowed(df, rules.limit(0)).count() == 2
