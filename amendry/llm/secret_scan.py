"""Secret scans through a trigram inverted index, in DataFrame operations only.

From each rule's pattern a Boolean query over trigrams is derived: every match contains
all trigrams of one of its conjunctions. The index holds a posting (trigram, text key)
for each trigram that some rule asks for and each distinct text that contains it,
without regard to case. Postings are intersected by text key, and only the texts that
satisfy a rule's query are verified with the pattern. A rule without a mandatory trigram
is verified on every text.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.llm.rows import meet
from amendry.sources.workspace import Workspace

_parser = re._parser  # the standard library's own parse tree of a pattern


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `group` has at least `least` characters.

    The pattern must mean the same to Java and Python, and match no empty text.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the kinds of secrets, in the order in which equal starts are listed.
# A run shorter than the least length is no match and hides none, so the runs of
# `access` and `hex` have it in the pattern; `assign` drops short values after matching.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)

# ---- Boolean trigram queries

_MOST = 64  # strings that a part of a pattern may stand for to be spelt out


def _spelt(node) -> set[str] | None:
    """All strings, in small letters, that a node of the parse tree matches; None if too many."""
    kind, value = str(node[0]), node[1]
    if kind == "LITERAL":
        return {chr(value).lower()}
    if kind == "IN":
        found = set()
        for what, x in value:
            if str(what) == "LITERAL":
                found.add(chr(x).lower())
            elif str(what) == "RANGE" and x[1] - x[0] < 8:
                found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind == "SUBPATTERN":
        return _all_of(value[-1])
    if kind == "BRANCH":
        parts = [_all_of(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if kind == "MAX_REPEAT" and value[1] in (0, 1):
        one = _all_of(value[2])
        return None if one is None else one | ({""} if value[0] == 0 else set())
    return None


def _all_of(nodes) -> set[str] | None:
    strings = {""}
    for node in nodes:
        more = _spelt(node)
        if more is None or len(strings) * len(more) > _MOST:
            return None
        strings = {a + b for a, b in itertools.product(strings, more)}
    return strings


def _shortest(query: set[frozenset]) -> set[frozenset]:
    """Without conjunctions that ask for all of another one, and more."""
    return {c for c in query if not any(d < c for d in query)}


def _both(a: set[frozenset], b: set[frozenset]) -> set[frozenset]:
    return _shortest({x | y for x in a for y in b})


def _from_strings(strings: set[str]) -> set[frozenset]:
    return _shortest({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _query(nodes) -> set[frozenset]:
    done, run = {frozenset()}, {""}
    for node in nodes:
        more = _spelt(node)
        if more is not None and len(run) * len(more) <= _MOST:
            run = {a + b for a, b in itertools.product(run, more)}
            continue
        done, run = _both(done, _from_strings(run)), {""}
        kind, value = str(node[0]), node[1]
        if more is not None:
            run = more
        elif kind == "SUBPATTERN":
            done = _both(done, _query(value[-1]))
        elif kind == "BRANCH":
            done = _both(done, _shortest(set().union(*[_query(b) for b in value[1]])))
        elif kind == "MAX_REPEAT" and value[0] > 0:
            done = _both(done, _query(value[2]))
    return _both(done, _from_strings(run))


def trigram_query(pattern: str) -> list[list[str]]:
    """Any of these lists of trigrams is in every match, without regard to case; [[]] asks for nothing."""
    return sorted(sorted(c) for c in _query(_parser.parse(pattern)))


# ---- the index


def text_key(text: Column) -> Column:
    """Equal texts share postings; a clash of keys only adds a text to verify."""
    return F.xxhash64(text)


def postings(df: DataFrame, text: str, trigrams: list[str]) -> DataFrame:
    """(trigram, key): one posting, or some equal ones, for each text that contains the trigram."""
    small = df.select(text_key(F.col(f"`{text}`")).alias("key"), F.lower(f"`{text}`").alias("_small"))
    found = F.array_compact(F.array(*[F.when(F.contains("_small", F.lit(t)), F.lit(t)) for t in trigrams]))
    return small.select("key", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """(key, rules): which rules' queries a text's postings satisfy, one bit each, for texts with any."""
    vocabulary = sorted({t for q in queries.values() for c in q for t in c})
    if len(vocabulary) > 8 * 63:
        raise ValueError(f"more than {8 * 63} trigrams in one scan")
    words = [vocabulary[i : i + 63] for i in range(0, len(vocabulary), 63)]
    bits = lambda own, part: sum(1 << own.index(t) for t in part if t in own)
    maps = [
        F.bit_or(
            F.coalesce(F.create_map(*[F.lit(x) for i, t in enumerate(own) for x in (t, 1 << i)])[F.col("trigram")], F.lit(0)).cast("long")
        ).alias(f"_m{k}")
        for k, own in enumerate(words)
    ]
    masks = index.groupBy("key").agg(*maps)
    tests = []
    for name, query in queries.items():
        fits = F.lit(False)
        for part in query:
            whole = F.lit(True)
            for k, own in enumerate(words):
                if need := bits(own, part):
                    whole = whole & (F.col(f"_m{k}").bitwiseAND(F.lit(need)) == need)
            fits = fits | whole
        tests.append(F.when(fits, F.lit(1 << len(tests))).otherwise(0).cast("long"))
    return masks.select("key", sum(tests[1:], tests[0]).alias("rules")).filter("rules > 0")


# ---- verified spans

_PART = 256


def _before(sizes: Column) -> Column:
    """Sum of all earlier elements, for each element of an array of long."""
    step = lambda acc, x: F.struct((acc["n"] + x).alias("n"), F.array_append(acc["a"], acc["n"]).alias("a"))
    start = F.expr("struct(0L as n, cast(array() as array<bigint>) as a)")
    return F.aggregate(sizes, start, step, lambda acc: acc["a"])


def _starts(sizes: Column) -> Column:
    """_before() in parts, so that long arrays are not copied once per element."""
    count = F.ceil(F.size(sizes) / _PART)
    parts = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda k: F.slice(sizes, (k * _PART + 1).cast("int"), _PART))
    totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda n, x: n + x))
    moved = F.zip_with(parts, _before(totals), lambda p, b: F.transform(_before(p), lambda x: x + b))
    return F.when(F.size(sizes) > 0, F.flatten(moved)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _length(x: Column) -> Column:
    return F.char_length(x).cast("long")


NO_SPANS = "cast(array() as array<struct<start: bigint, turn: int, end: bigint>>)"


def _add_spans(df: DataFrame, turn: int, rule: Rule, verify: Column) -> DataFrame:
    """df + _spans_<turn>, from _text; positions follow from the sizes of matches and of what lies between."""
    hits, between, sizes, starts = (f"_{n}_{turn}" for n in ("hits", "between", "sizes", "starts"))
    pattern = F.lit(rule.pattern)
    df = df.withColumn(hits, F.when(verify, F.regexp_extract_all("_text", pattern, F.lit(0))))
    some = F.size(F.coalesce(F.col(hits), F.array())) > 0
    kept = F.regexp_extract_all("_text", pattern, F.lit(rule.group)) if rule.group else F.col(hits)
    df = df.withColumns({between: F.when(some, F.split("_text", rule.pattern, -1)), f"_kept_{turn}": F.when(some, kept)})
    df = df.withColumn(
        sizes,
        F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda b, h: F.struct(_length(b).alias("gap"), _length(h).alias("hit"))),
    )
    df = df.withColumn(starts, F.when(F.col(sizes).isNotNull(), _starts(F.transform(sizes, lambda s: s["gap"] + s["hit"]))))
    spans = F.zip_with(
        F.arrays_zip(F.col(starts).alias("s"), F.col(sizes).alias("z")),
        f"_kept_{turn}",
        lambda p, k: F.struct(
            (p["s"] + p["z"]["gap"]).alias("start"),
            F.lit(turn).alias("turn"),
            (p["s"] + p["z"]["gap"] + p["z"]["hit"]).alias("end"),
            (_length(k) >= rule.least).alias("ok"),
        ),
    )
    spans = F.transform(F.filter(spans, lambda s: s["ok"]), lambda s: F.struct(s["start"], s["turn"], s["end"]))
    empty = F.expr(NO_SPANS)
    return df.withColumn(f"_spans_{turn}", F.coalesce(spans.cast(NO_SPANS[16:-1]), empty)).drop(
        hits, between, sizes, starts, f"_kept_{turn}"
    )


def add_spans(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """df + `name`: array of (start, turn, end), by start, then by the rules' order; code points, end exclusive.

    A null text is an empty one and has no spans. Equal texts have equal spans, repeated
    rows stay repeated, and a column of df named `name` is replaced. A text of any length is
    read whole, its matches placed by sums over them; an empty table stays empty.
    """
    kept = [c for c in df.columns if c.lower() != name.lower()]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text])]).alias("_row")
    base = df.select(row)
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    indexed = {n: q for n, q in queries.items() if [] not in q}
    if indexed:
        index = postings(df.select(whole.alias("_text")), "_text", sorted({t for q in indexed.values() for c in q for t in c}))
        keyed = df.select(row, text_key(whole).alias("_key"))
        found = Workspace(df.sparkSession).stage(candidates(index, indexed).withColumnRenamed("key", "_key"), "candidates")
        base = meet(keyed, found, "_key").drop("_key")
    base = base.withColumn("_text", F.coalesce(F.col("_row").getField(text), F.lit("")))
    for turn, rule in enumerate(rules):
        bit = 1 << list(indexed).index(rule.name) if rule.name in indexed else 0
        fits = F.col("rules").bitwiseAND(F.lit(bit)) > 0 if bit else F.lit(True)
        base = _add_spans(base, turn, rule, fits)
    spans = F.array_sort(F.concat(*[F.col(f"_spans_{k}") for k in range(len(rules))]))
    return base.select(*[F.col(f"_row.`{c}`") for c in kept], spans.alias(name))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(r.name) for r in rules])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["turn"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, turn: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["turn"] == turn)).cast("long")


def redacted(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """df with every span of `text` replaced; spans that overlap or touch become one mark. All rows stay."""
    marked = add_spans(df, text, rules, "_spans")
    body = F.col(f"`{text}`")
    step = lambda acc, s: F.when(
        s["start"] > acc["end"],
        F.struct(
            F.array_append(acc["out"], F.substring(body, (acc["end"] + 1).cast("int"), (s["start"] - acc["end"]).cast("int"))).alias("out"),
            s["end"].alias("end"),
        ),
    ).otherwise(
        F.struct(F.when((F.size(acc["out"]) == 0), F.array(F.lit(""))).otherwise(acc["out"]).alias("out"), F.greatest(acc["end"], s["end"]).alias("end"))
    )
    end = lambda acc: F.concat(F.array_join(acc["out"], mark), F.lit(mark), F.substring(body, (acc["end"] + 1).cast("int"), F.lit(2**31 - 1)))
    start = F.expr("struct(cast(array() as array<string>) as out, 0L as end)")
    text_of = F.when(F.size("_spans") == 0, body).otherwise(F.aggregate("_spans", start, step, end))
    return marked.withColumn(text, text_of).select(*[F.col(f"`{c}`") for c in df.columns])
