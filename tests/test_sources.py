"""Schemas, staging, log and publication."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from amendry.operators.rejects import COLUMNS
from amendry.sources import publish as publishing
from amendry.operators import order
from amendry.sources import ordered, schema, sinks, workspace
from amendry.sources.publish import CheckFailed, VersionTaken, publish, published
from amendry.sources.workspace import Workspace
from tests.conftest import rows


def test_schema_names_labels_and_nullability(spark):
    struct = schema.struct("adh1pacpf")
    assert struct["pactau"].dataType.simpleString() == "decimal(5,3)" and struct["pactau"].nullable
    assert not struct["packro"].nullable
    assert struct["packro"].metadata["comment"].startswith("Identifiant -> PretAssure")


@pytest.mark.parametrize("table", sorted(schema.LAYOUTS))
def test_long_and_short_names_are_inverse(spark, table):
    df = spark.createDataFrame([], schema.struct(table))
    long = schema.to_long(df, table)
    assert "C_taux" in long.columns and "F_idGarGarantieIncluse" in long.columns
    assert schema.to_short(long, table).columns == df.columns
    assert schema.typed(df, table).schema[0].metadata == schema.struct(table)[0].metadata


def test_long_names_of_other_tables(spark):
    loan = spark.createDataFrame([], "prtkro bigint, prtban bigint, prtdrt date")
    long = schema.to_long(loan, "t4pprtpf")
    assert long.columns == ["prtkro", "F_banCode", "C_dateReferenceTarifaire"]
    for table in schema.LONG_NAMES:
        df = spark.createDataFrame([], schema.struct_of(table))
        assert schema.to_short(schema.to_long(df, table), table).columns == df.columns


def test_published_tables_have_their_declared_types(spark):
    root = Workspace(spark).path("typed")
    wage = spark.sql("select 1 as empno, 2 as salary")
    publish(spark, root, {"wage": wage}, {})
    assert published(spark, root, "wage").schema == schema.struct_of("wage")
    with pytest.raises(ValueError, match="other"):
        publish(spark, root, {"wage": wage.withColumn("other", F.lit(1))}, {})


def test_added_rows_are_written_again_a_logarithmic_number_of_times(spark, monkeypatch):
    """200 runs that add three rows each: few folders are named, and each row is written once per power of FAN at most."""
    monkeypatch.setattr(publishing, "FAN", 4)
    written, write = [], publishing._Writer.write

    def counting(self, df, table):
        found = write(self, df, table)
        written.append(sum(f.rows for f in found[0]))
        return found

    monkeypatch.setattr(publishing._Writer, "write", counting)
    root = Workspace(spark).path("added")
    for k in range(200):
        publish(spark, root, {}, {}, added={"kept": spark.range(3 * k, 3 * k + 3, 1, 1)})
        assert len(publishing.folders(spark, root, "kept")) <= 3 * 6
    assert [r[0] for r in rows(published(spark, root, "kept"))] == list(range(600))
    assert sum(written) <= 600 * 6  # 4 ** 5 > 600; all of it every 16 runs would be some 4,000


def test_only_folders_of_one_day_are_merged(spark, monkeypatch):
    monkeypatch.setattr(publishing, "FAN", 3)
    root = Workspace(spark).path("days")
    row = ("s", "1", "*Other", "INFO", 4, "text", 100)
    kinds = "step string, code string, kind string, level string, key bigint, message string, rc int"
    df = spark.createDataFrame([row], kinds)
    publish(spark, root, {}, {}, added={"log": sinks.dated(df, date(2020, 6, 1))})
    first = publishing.folders(spark, root, "log")
    for _ in range(4):
        publish(spark, root, {}, {}, added={"log": sinks.dated(df, date(2020, 6, 2))})
    kept = publishing.folders(spark, root, "log")
    assert [f for f in kept if f.part == "log_date=2020-06-01"] == first
    assert sorted(f.rows for f in kept if f.part == "log_date=2020-06-02") == [1, 3]


def spans(monkeypatch, **sizes):
    monkeypatch.setattr(schema, "SPANS", {t: (schema.SPANS[t][0], n) for t, n in sizes.items()})


def employees(spark, n):
    return spark.range(n).selectExpr(
        "id as empno", "cast(id as string) as lastname", "'f' as firstnme", "date '1990-01-01' as birthdate", "cast(id as decimal(11,2)) as salary"
    )


def test_only_changed_partitions_are_written(spark, monkeypatch):
    spans(monkeypatch, employee=10)
    root = Workspace(spark).path("parts")
    staff = employees(spark, 100).unionByName(employees(spark, 1).withColumn("empno", F.lit(None).cast("long")))
    staff = staff.unionByName(employees(spark, 1).withColumn("empno", F.lit(-3).cast("long")))
    publish(spark, root, {"employee": staff}, {})
    before = publishing.folders(spark, root, "employee")
    assert len(before) == 11 and sum(f.rows for f in before) == 102
    raised = published(spark, root, "employee").withColumn("salary", F.expr("if(empno in (15, 17, 90) or empno is null, 1000, salary)"))
    changed = spark.createDataFrame([(15,), (17,), (90,), (None,)], "k long")
    publish(spark, root, {"employee": raised}, {}, changed={"employee": changed}, rows={"employee": 102})
    after = publishing.folders(spark, root, "employee")
    assert {f.part for f in set(after) - set(before)} == {"_part=1", "_part=9", "_part=-1"}
    assert len(set(after) & set(before)) == 8
    got = published(spark, root, "employee")
    assert rows(got.filter("salary = 1000").select("empno")) == [(None,), (15,), (17,), (90,)]
    assert got.count() == 102 and got.filter("empno = -3").count() == 1
    publish(spark, root, {"employee": raised}, {}, changed={"employee": changed.limit(0)})  # nothing changed, nothing written
    assert publishing.folders(spark, root, "employee") == after


def test_filter_on_changed_partitions_reaches_the_scan(spark, monkeypatch, settings):
    spans(monkeypatch, employee=10)
    settings(spark__sql__maxMetadataStringLength=2000)
    root = Workspace(spark).path("pushed")
    publish(spark, root, {"employee": employees(spark, 100)}, {})
    df = published(spark, root, "employee").filter(publishing._in_parts("employee", [2, 3, 8]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(empno,20)" in plan and "LessThanOrEqual(empno,89)" in plan
    assert [r.empno for r in df.orderBy("empno").collect()] == [*range(20, 40), *range(80, 90)]
    monkeypatch.setattr(publishing, "RANGES", 1)
    wide = published(spark, root, "employee").filter(publishing._in_parts("employee", [2, 8]))
    assert [r.empno for r in wide.orderBy("empno").collect()] == [*range(20, 30), *range(80, 90)]


def test_a_version_is_claimed_once(spark):
    root = Workspace(spark).path("claimed")
    base = publish(spark, root, {"a": spark.range(3)}, {})
    slow = {"another run comes first": lambda written: publish(spark, root, {"a": spark.range(5)}, {}, base=base) == 2}
    with pytest.raises(VersionTaken):
        publish(spark, root, {"a": spark.range(9)}, slow, added={"kept": spark.range(2)}, base=base)
    with pytest.raises(VersionTaken):
        publish(spark, root, {"a": spark.range(9)}, {}, base=base)
    assert published(spark, root, "a").count() == 5 and published(spark, root, "kept") is None
    assert published(spark, root, "a", base).count() == 3  # earlier versions can still be read
    assert publish(spark, root, {"a": spark.range(1)}, {}) == 3


def test_keys_and_required_columns_are_checked_with_the_write(spark):
    root = Workspace(spark).path("keys")
    staff = employees(spark, 5)
    publish(spark, root, {"employee": staff}, {}, unique={"employee": ["empno"]})
    with pytest.raises(CheckFailed, match="one key"):
        publish(spark, root, {"employee": staff.unionByName(staff.limit(1))}, {}, unique={"employee": ["empno"]})
    with pytest.raises(CheckFailed, match="has 4 rows, not 5"):
        publish(spark, root, {"employee": staff.limit(4)}, {}, rows={"employee": 5})
    tier = spark.createDataFrame([], schema.struct("adh1pacpf")).unionByName(
        spark.sql("select 1 as pacpac, 7 as packro"), allowMissingColumns=True
    )
    with pytest.raises(CheckFailed, match="adh1pacpf.pacggi is NULL in 1 rows"):
        publish(spark, root, {"adh1pacpf": tier}, {})
    assert published(spark, root, "employee").count() == 5 and published(spark, root, "adh1pacpf") is None


def test_empty_tables_keep_their_layout(spark):
    root = Workspace(spark).path("empty")
    publish(spark, root, {"employee": employees(spark, 0), "wage": spark.sql("select 1 as empno, 2 as salary").limit(0)}, {})
    for name in ("employee", "wage"):
        assert published(spark, root, name).schema == schema.struct_of(name) and published(spark, root, name).count() == 0


def test_read_table_uses_the_declared_schema_and_pushes_the_worklist_filter(spark, tmp_path):
    typed = schema.typed(spark.createDataFrame([], schema.struct("adh1h43pf")), "adh1h43pf")
    typed.write.parquet(f"{tmp_path}/h43")
    df = schema.read_table(spark, f"{tmp_path}/h43", "adh1h43pf")
    assert [f.name for f in df.schema] == [c[0] for c in schema.PREMIUM_HISTORY]
    plan = df.filter(F.col("h43tau").isNull()).select("h43kmv")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(h43tau)]" in plan
    assert "ReadSchema: struct<h43kmv:bigint,h43tau:decimal(5,3)>" in plan


def test_stage_replaces_and_append_adds(spark):
    work = Workspace(spark)
    assert work.stage(spark.range(3), "t").count() == 3
    assert work.stage(spark.range(2), "t").count() == 2
    assert work.append(spark.range(5), "t").count() == 7
    assert work.append(spark.range(1), "new").count() == 1


class Settings:
    """Only what shared_folder reads of a session."""

    def __init__(self, master, folder=None):
        self.conf = {workspace.SETTING: folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_shared_folder_comes_from_the_session():
    assert workspace.shared_folder(Settings("spark://host", "hdfs://shared/dir/")) == "hdfs://shared/dir"
    for master in ("spark://host", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            workspace.shared_folder(Settings(master))
    assert os.path.isdir(workspace.shared_folder(Settings("local[2]")))


def test_order_of_files_is_verified(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="4")
    by = order.descending("k") + order.ascending("t")
    df = spark.range(3000).selectExpr("if(id % 9 = 0, null, cast(id % 40 as int)) as k", "if(id % 7 = 0, null, cast(id % 500 as string)) as t", "id")
    work = Workspace(spark)
    ordered.write_sorted(df.repartition(6), by, work.path("good"))
    ranges = ordered.file_ranges(spark, work.path("good"), by)
    assert ranges.count() > 1 and ranges.agg(F.sum("rows")).first()[0] == 3000
    assert ordered.violations(ranges, by).count() == 0
    df.repartition(3).sortWithinPartitions(*order.columns(by)).write.parquet(work.path("overlapping"))
    found = ordered.violations(ordered.file_ranges(spark, work.path("overlapping"), by), by)
    assert found.count() == 2 and found.agg(F.sum("wrong")).first()[0] == 0
    df.coalesce(1).write.parquet(work.path("unsorted"))
    assert ordered.violations(ordered.file_ranges(spark, work.path("unsorted"), by), by).first()["wrong"] > 0


def test_insert_select_fills_missing_columns(spark):
    target = spark.createDataFrame([(1, "N", 2.0)], "id bigint, flag string, x double")
    got = sinks.insert_select(target, spark.createDataFrame([(5,)], "id int"))
    assert rows(got) == [(1, "N", 2.0), (5, None, None)] and got.schema == target.schema
    with pytest.raises(ValueError):
        sinks.insert_select(target, spark.createDataFrame([(5,)], "other int"))
    assert rows(sinks.insert_values(spark, target, ["id", "flag"], [(7, "O")]))[1] == (7, "O", None)


def test_log_is_published_and_read_by_day(spark):
    root = Workspace(spark).path("log")
    row = ("s", "1", "*Other", "INFO", 4, "text", 100)
    kinds = "step string, code string, kind string, level string, key bigint, message string, rc int"
    df = spark.createDataFrame([row], kinds)
    assert sinks.read_log(spark, root, date(2020, 6, 3)) is None
    for frame, day in ((df, date(2020, 6, 3)), (df.unionByName(df), date(2020, 6, 4))):
        publish(spark, root, {}, {}, {"log": sinks.dated(frame, day)})
    assert rows(sinks.read_log(spark, root, date(2020, 6, 3))) == [row]
    read = sinks.read_log(spark, root, date(2020, 6, 4))
    assert read.columns == COLUMNS and read.count() == 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan and "PushedFilters: []" in plan


def test_publish_is_all_or_nothing(spark):
    root = Workspace(spark).path("published")
    assert published(spark, root, "a") is None
    keep = {"not empty": lambda t: t["a"].count() > 0}
    assert publish(spark, root, {"a": spark.range(3), "b": spark.range(1)}, keep) == 1
    with pytest.raises(CheckFailed, match="not empty"):
        publish(spark, root, {"a": spark.range(0), "b": spark.range(9)}, keep)
    assert (published(spark, root, "a").count(), published(spark, root, "b").count()) == (3, 1)
    broken = spark.range(2).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        publish(spark, root, {"a": spark.range(8), "b": broken}, {})
    assert published(spark, root, "a").count() == 3
    assert publish(spark, root, {"a": spark.range(4), "b": spark.range(2)}, keep) == 2
    assert (published(spark, root, "a").count(), published(spark, root, "b").count()) == (4, 2)
