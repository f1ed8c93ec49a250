"""All-or-nothing publication of several tables, partition by partition.

A version is one small file that names, for every table, the folders its rows are in. A run
writes new folders only for the partitions it changed; the others are carried over by
name. Once the checks pass, the run claims the next version: it moves the file to a name
that must not exist yet, which is the only step readers can see. A run that fails before it,
whose checks fail, or whose version another run has claimed meanwhile leaves the published
tables as they were.

Tables that rows are added to get a folder with every run. As soon as a partition has FAN
folders of about the same size they become one, so a row is written again once for each power
of FAN that its partition grows by.

The shared file system must move files atomically, and refuse to move one onto another.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections import defaultdict
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.sources import schema

FAN = 8  # folders of about one size that are written together
RANGES = 64  # of keys that a filter on changed partitions names, for the files' own statistics
PART, RUN = "_part", "run"
Check = Callable[[dict[str, DataFrame]], bool]


class CheckFailed(Exception):
    """A batch was written but not published."""


class VersionTaken(Exception):
    """Another run has published since this one read its tables."""


class Folder(NamedTuple):
    """Rows of one partition that one run wrote; `part` is None in a table that has no partitions."""

    run: str
    part: str | None
    rows: int


Tables = dict[str, list[Folder]]

# ---- versions


class _Versions:
    """The version files of a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.folder = f"{root}/versions"
        self.files = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def latest(self) -> int:
        if not self.files.exists(self._path("")):
            return 0
        names = [s.getPath().getName() for s in self.files.listStatus(self._path(""))]
        return max((int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n)), default=0)

    def read(self, version: int) -> Tables:
        return {name: [Folder(*f) for f in own] for name, own in self._content(version).get("tables", {}).items()}

    def made_from(self, version: int) -> dict[str, int]:
        return self._content(version).get("made_from", {})

    def exists(self, version: int) -> bool:
        return self.files.exists(self._path(f"{version:010d}.json"))

    def _content(self, version: int) -> dict:
        if not version:
            return {}
        stream = self.files.open(self._path(f"{version:010d}.json"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def claim(self, version: int, tables: Tables, made_from: dict[str, int]) -> None:
        draft, final = self._path(f".{uuid.uuid4().hex}"), self._path(f"{version:010d}.json")
        out = self.files.create(draft, False)
        try:
            text = json.dumps({"version": version, "tables": tables, "made_from": made_from})
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        fs = self.jvm.org.apache.hadoop.fs
        keep = self.gateway.new_array(getattr(fs, "Options$Rename"), 0)  # without the option to overwrite
        try:
            fs.FileContext.getFileContext(self.files.getUri(), self.conf).rename(draft, final, keep)
        except Py4JJavaError as error:
            self.files.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                raise VersionTaken(f"version {version} was published by another run") from None
            raise


def latest_version(spark: SparkSession, root: str) -> int:
    """Number of the last published version; 0 before the first."""
    return _Versions(spark, root).latest()


def folders(spark: SparkSession, root: str, table: str, version: int | None = None) -> list[Folder]:
    """Folders that make up a version of a table, by default the latest one."""
    versions = _Versions(spark, root)
    return versions.read(versions.latest() if version is None else version).get(table, [])


# ---- partitions


def _layout(table: str) -> tuple[str | None, Column | None]:
    """Name of the column a table is partitioned by, and what it holds."""
    if table in schema.DAYS:
        return schema.DAYS[table], None
    if table in schema.SPANS:
        key, span = schema.SPANS[table]
        return PART, F.expr(f"coalesce(({key} - pmod({key}, {span}L)) div {span}L, -1L)")
    return None, None


def _in_parts(table: str, parts: list[int]) -> Column:
    """Rows of these partitions. Ranges of keys around them let the files' statistics skip the rest."""
    key, span = schema.SPANS[table]
    exact = _layout(table)[1].isin(parts)
    ends = sorted(p for p in parts if p != -1)
    if not ends:
        return exact
    gaps = [k for k in range(1, len(ends)) if ends[k] - ends[k - 1] > 1]
    cuts = [0, *sorted(sorted(gaps, key=lambda k: ends[k - 1] - ends[k])[: RANGES - 1]), len(ends)]
    near = F.col(key).isNull() if -1 in parts else F.lit(False)
    for a, b in zip(cuts, cuts[1:]):
        near = near | F.col(key).between(ends[a] * span, (ends[b - 1] + 1) * span - 1)
    if -1 in parts:  # also holds the keys just below zero
        near = near | F.col(key).between(-span, -1)
    return near & exact


def _base(root: str, table: str) -> str:
    return f"{root}/data/{table}"


def _frame(spark: SparkSession, root: str, table: str, own: list[Folder]) -> DataFrame | None:
    """Rows of these folders. The columns a table is partitioned by are read from the folders' names."""
    known, column = table in {**schema.TABLES, **schema.LAYOUTS}, _layout(table)[0]
    if not own:
        return spark.createDataFrame([], schema.struct_of(table)) if known else None
    paths = [f"{_base(root, table)}/{RUN}={f.run}" + (f"/{f.part}" if f.part else "") for f in own]
    reader = spark.read.option("basePath", _base(root, table))
    if not known:
        return reader.parquet(*paths).drop(RUN, *([PART] if column == PART else []))
    fields = schema.struct_of(table).fields
    extra = [T.StructField(PART, T.LongType())] * (column == PART) + [T.StructField(RUN, T.StringType())]
    return reader.schema(T.StructType([*fields, *extra])).parquet(*paths).select(*[f.name for f in fields])


class _Writer:
    """Writes folders of one run and counts what is in them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, df: DataFrame, table: str) -> tuple[list[Folder], dict[str, int]]:
        """Folders written, and how often columns that must not be NULL are.

        Nulls are counted while rows are written; row numbers come from the files' footers.
        """
        run, (column, value) = uuid.uuid4().hex, _layout(table)
        path = f"{_base(self.root, table)}/{RUN}={run}"
        required = schema.required(table)
        seen = Observation()
        if required:
            df = df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        if column:
            df = df.withColumn(column, value) if value is not None else df
            df.hint("rebalance", column).write.partitionBy(column).parquet(path)
            back = self.spark.read.schema(T.StructType([df.schema[column]])).parquet(path)
            counts = {r[0]: r[1] for r in back.groupBy(column).count().collect()}
            named = {k: "__HIVE_DEFAULT_PARTITION__" if k is None else k for k in counts}
            found = [Folder(run, f"{column}={named[k]}", n) for k, n in sorted(counts.items(), key=lambda x: str(x[0]))]
        else:
            df.write.parquet(path)
            found = [Folder(run, None, self.spark.read.schema(df.schema).parquet(path).count())]
        return found, {c: n for c, n in seen.get.items() if n} if required else {}

    def merged(self, table: str, own: list[Folder]) -> list[Folder]:
        """Folders of about one size written together, as long as a partition has FAN of them."""
        while True:
            tiers = defaultdict(list)
            for f in own:
                tiers[f.part, int(math.log(max(1, f.rows), FAN))].append(f)
            # a partition's smallest crowded tier is merged first; all partitions in one job
            crowded: dict[str | None, list[Folder]] = {}
            for (part, _), group in sorted(tiers.items(), key=lambda t: t[0][1]):
                if len(group) >= FAN and part not in crowded:
                    crowded[part] = group
            if not crowded:
                return own
            old = [f for group in crowded.values() for f in group]
            new, _ = self.write(_frame(self.spark, self.root, table, old), table)
            own = [f for f in own if f not in old] + new


# ---- publication


def publish(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame],
    checks: dict[str, Check],
    added: dict[str, DataFrame] | None = None,
    changed: dict[str, DataFrame] | None = None,
    rows: dict[str, int] | None = None,
    unique: dict[str, list[str]] | None = None,
    base: int | None = None,
    kept_up: list[str] | None = None,
) -> int:
    """Write the tables, check what was written, then switch to all of it together.

    `changed` holds, for tables declared with spans of keys, the keys of the rows that differ
    from the published ones: only their partitions are written. `added` holds rows that join
    those already published instead of replacing them. `rows` is how many rows a table must
    have, `unique` the columns that tell its rows apart, tested on the partitions written: the
    key of a table's spans must be one of them. Columns that a layout requires must not be NULL.
    `base` is the version the tables were made from, by default the latest one, which is
    noted for tables that are `kept_up` with others. Tables with a declared layout are
    brought to it.
    """
    added, changed, unique = added or {}, changed or {}, unique or {}
    versions, writer = _Versions(spark, root), _Writer(spark, root)
    base = versions.latest() if base is None else base
    before = versions.read(base)
    after, wrong, frames = dict(before), [], {}
    for name, df in {**tables, **added}.items():
        df, kept = schema.declared(df, name), before.get(name, []) if name in added else []
        if name in changed and name in schema.SPANS and name in before:
            key, value = schema.SPANS[name][0], _layout(name)[1]
            parts = [r[0] for r in changed[name].select(F.col(changed[name].columns[0]).alias(key)).select(value).distinct().collect()]
            own = {f"{PART}={p}" for p in parts}
            kept = [f for f in before[name] if f.part not in own]
            df = df.filter(_in_parts(name, parts)) if parts else df.filter(F.lit(False))
        new, nulls = writer.write(df, name)
        wrong += [f"{name}.{c} is NULL in {n} rows" for c, n in nulls.items()]
        if name in unique and _repeated(_frame(spark, root, name, new), unique[name]):
            wrong.append(f"{name} has rows of one key")
        after[name] = writer.merged(name, kept + new) if name in added else kept + new
        frames[name] = _frame(spark, root, name, after[name])
    for name, size in (rows or {}).items():
        if (found := sum(f.rows for f in after[name])) != size:
            wrong.append(f"{name} has {found} rows, not {size}")
    wrong += [name for name, check in checks.items() if not check(frames)]
    if wrong:
        raise CheckFailed(f"version {base + 1} not published: {', '.join(wrong)}")
    versions.claim(base + 1, after, {**versions.made_from(base), **dict.fromkeys(kept_up or [], base)})
    return base + 1


def _repeated(df: DataFrame | None, columns: list[str]) -> bool:
    return df is not None and not df.groupBy(*columns).count().filter("count > 1").isEmpty()


def published(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame | None:
    """A published version of a table, by default the latest one; None before the first."""
    versions = _Versions(spark, root)
    tables = versions.read(versions.latest() if version is None else version)
    return _frame(spark, root, table, tables[table]) if table in tables else None


class News(NamedTuple):
    """What has happened to a table since another one was made from it."""

    rows: DataFrame | None  # rows of new folders, and all rows of partitions that were written anew
    anew: list[int]  # those partitions


def news(spark: SparkSession, root: str, table: str, made: str, version: int) -> News | None:
    """News of a table kept by spans, for the table `made` from it; None if only the whole table can tell."""
    versions = _Versions(spark, root)
    since = versions.made_from(version).get(made)
    if since is None or not versions.exists(since) or table not in schema.SPANS:
        return None
    before, now = (set(versions.read(v).get(table, [])) for v in (since, version))
    anew = {f.part for f in before - now}
    fresh = sorted(f for f in now if f not in before or f.part in anew)
    return News(_frame(spark, root, table, fresh), sorted(int(p.partition("=")[2]) for p in anew))


def in_parts(table: str, parts: list[int]) -> Column:
    """Rows of these partitions of a table kept by spans."""
    return _in_parts(table, parts) if parts else F.lit(False)
