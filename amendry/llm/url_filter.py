"""URL filters by a sort-merge range join.

A host's labels are reversed, each with an end mark, so all hosts below a rule's host have
the rule's key as a prefix: a rule is an interval of keys. URLs and rules are dealt to key
ranges, a rule to every range its interval reaches into, sorted by key, and swept in one
pass with a stack of the rules whose intervals are open. Ranges are cut at quantiles of a
sample of (key, row), so a host with very many pages spans several of them; the cuts
decide only where a row is judged. No side is broadcast.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "\x01"  # behind every label of a key; sorts below all letters of a host
PER_RANGE = 64  # sampled rows a range
BLOCK, ALLOW = "block", "allow"

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CAPITALS, _SMALL = (bytes(range(a, a + 26)).decode() for a in (0x41, 0x61))


def host_of(url: Column) -> Column:
    """From behind the first :// to /, ?, # or the end, A-Z in small letters; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), END), F.lit(END))


def _rules(rules: DataFrame, rule: str, verdict: str) -> DataFrame:
    """(rule, verdict, host, path); of equal rules a blocking one counts."""
    named = rules.select(F.col(f"`{rule}`").alias("rule"), F.col(f"`{verdict}`").alias("verdict"))
    named = named.filter("rule is not null and verdict is not null").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    at = F.instr("rule", "/")
    host = F.when(at > 0, F.expr("substring(rule, 1, instr(rule, '/') - 1)")).otherwise(F.col("rule"))
    path = F.when(at > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit(""))
    return named.select("rule", "verdict", F.translate(host, _CAPITALS, _SMALL).alias("host"), path.alias("path"))


def _cuts(keyed: DataFrame, parts: int) -> list[tuple[str, int]]:
    """Lower ends of all ranges but the first, from a sample of about PER_RANGE rows each."""
    total = keyed.count()
    share = min(1.0, parts * PER_RANGE / max(1, total))
    seen = sorted(map(tuple, keyed.select("key", "tie").sample(share, 1).collect()))
    return sorted({seen[len(seen) * k // parts] for k in range(1, parts)}) if seen else []


def _with_part(df: DataFrame, sent, whole: bool) -> DataFrame:
    """df + the range of each row, or (`whole`) df once for every range that its interval reaches into."""
    kept = [c for c in df.columns if c != "tie"]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("part", T.IntegerType())])

    def run(batches):
        cuts = sent.value
        for batch in batches:
            keys = batch.column("key").to_pylist()
            if whole:
                spans = [(bisect_right(cuts, (k, -(1 << 63))), bisect_right(cuts, (k + chr(0x10FFFF), 0))) for k in keys]
                parts = [np.arange(a, b + 1) for a, b in spans]
                rows = np.repeat(np.arange(len(keys)), [len(p) for p in parts])
                part = np.concatenate([np.empty(0, int), *parts])
            else:
                part = [bisect_right(cuts, x) for x in zip(keys, batch.column("tie").to_pylist())]
                rows = np.arange(len(keys))
            table = batch.select(kept).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*table.columns, pa.array(part, pa.int32())], names=[*kept, "part"])

    return df.mapInArrow(run, schema)


class Sweep:
    """Rules whose intervals hold the key now swept, outermost first."""

    def __init__(self):
        self.part, self.stack = None, []

    def to(self, part: int, key: str) -> None:
        if part != self.part:
            self.part, self.stack = part, []
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, host: str, path: str, rule: str, verdict: str) -> None:
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, {}, set()))
        _, _, rules, sizes = self.stack[-1]
        rules[path] = (rule, verdict)
        sizes.add(len(path))

    def judge(self, host: str, path: str) -> tuple[str, str] | None:
        """Longest rule that fits; of equally long ones that of the longer host."""
        best, size = None, -1
        for _, own, rules, sizes in reversed(self.stack):
            if host != own and not host.endswith("." + own):
                continue
            for n in sorted(sizes, reverse=True):
                if n <= len(path) and path[:n] in rules:
                    if len(own) + n > size:
                        best, size = rules[path[:n]], len(own) + n
                    break
        return best


def _sweep(columns: list[str], default: str):
    def run(batches):
        state = Sweep()
        for batch in batches:
            found, pages = [], []
            rows = zip(*[batch.column(c).to_pylist() for c in ("part", "key", "host", "path", "rule", "verdict")])
            for k, (part, key, host, path, rule, verdict) in enumerate(rows):
                state.to(part, key)
                if rule is not None:
                    state.open(key, host, path, rule, verdict)
                else:
                    pages.append(k)
                    found.append(state.judge(host, path) or (None, default))
            kept = batch.select(columns).take(pa.array(pages, pa.int64()))
            new = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], names=[*columns, "rule", "verdict"])

    return run


def add_verdicts(
    df: DataFrame, rules: DataFrame, url: str = "url", rule: str = "rule", verdict: str = "verdict", default: str = ALLOW
) -> DataFrame:
    """df + host, path, rule and verdict ("allow" or "block") of every row.

    A rule is a host, then a path from the first / on; it fits its host and all hosts below,
    if the path starts with its path. The longest rule that fits decides; `rule` is null and
    the verdict is `default` where none fits. A null URL, and one without ://, has an empty
    host and path. Of equal rules with different verdicts "block" counts; null rules are
    left out. Repeated rows stay repeated, columns of df with the new names are replaced,
    and an empty table of rules gives every row the default.
    """
    spark = df.sparkSession
    names = ["host", "path", "rule", "verdict"]
    kept = [c for c in df.columns if c.lower() not in names]
    pages = df.select(
        F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_row"),
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
    )
    pages = pages.withColumns({"key": host_key(F.col("host")), "tie": F.xxhash64(F.monotonically_increasing_id())})
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = spark.sparkContext.broadcast(_cuts(pages, 4 * width))
    dealt = _with_part(pages, sent, False)
    ruled = _with_part(_rules(rules, rule, verdict).withColumn("key", host_key(F.col("host"))), sent, True)
    events = dealt.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")}).unionByName(
        ruled.withColumn("_row", F.lit(None).cast(pages.schema["_row"].dataType))
    )
    order = ["part", "key", F.col("rule").isNull()]
    swept = events.repartition(width, "part").sortWithinPartitions(*order)
    columns = ["_row", "host", "path"]
    schema = T.StructType(
        [events.schema[c] for c in columns] + [T.StructField(n, T.StringType()) for n in ("rule", "verdict")]
    )
    return swept.mapInArrow(_sweep(columns, default), schema).select(*[F.col(f"_row.`{c}`") for c in kept], *names)


def allowed(df: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Rows of df with an allowed URL, with the columns they had."""
    boxed = df.select(F.col(f"`{url}`").alias("_url"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"))
    return add_verdicts(boxed, rules, "_url").filter(F.col("verdict") == ALLOW).select("_all.*")
