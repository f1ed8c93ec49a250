"""Jobs end to end on published tables: read, change, publish, log."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from amendry.run import JOBS, InvalidParameter, Run, main
from amendry.sources import schema
from amendry.sources.publish import VersionTaken, folders, publish, published
from amendry.sources.views import Views
from amendry.sources.workspace import Workspace
from tests.conftest import rows

AS_OF = datetime(2020, 6, 3, 12)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark):
    v = Views(spark, SF_DIR)
    company = spark.createDataFrame([(0, 0), (1, 0), (2, 5)], "ciecie int, cieban int")
    tables = {
        "adh1h43pf": v.history(), "adh1pacpf": v.tier(), "p0amadpf": v.movement(), "t4pprtpf": v.loan(),
        "p1abqepf": v.bank(), "t4ptaxpf": v.rate(), "pretprioritaire": v.priority(), "t4padhpf": v.member(),
        "p0elaepf": v.reference(), "p0egdepf": v.decision(), "sri1ddopf": v.latest_pointer(),
        "p0mdecpf": v.source_decision(), "p0mexcpf": v.exclusion(), "t4pciepf": company, "t4pcorpf": v.letter(),
        "adh1csupf": v.letter_followup(), "employee": v.employee(), "wage": v.wage(),
    }
    folder = Workspace(spark).path("root")
    publish(spark, folder, tables, {})
    return folder


def run(spark, root, **options):
    return Run(spark, root, as_of=AS_OF, **options)


def nulls(spark, root, table, col):
    return published(spark, root, table).filter(F.col(col).isNull()).count()


def logged(spark, root, condition):
    return published(spark, root, "log").filter("log_date = date '2020-06-03'").filter(condition).collect()


def test_every_job_is_a_method():
    assert all(callable(getattr(Run, job)) for job in JOBS)


def test_backfills_and_split(spark, root):
    before = nulls(spark, root, "adh1h43pf", "h43tau")
    run(spark, root, quantity="50").backfill_history()
    middle = nulls(spark, root, "adh1h43pf", "h43tau")
    assert 0 < before - middle <= 50
    run(spark, root).backfill_history()
    assert nulls(spark, root, "adh1h43pf", "h43tau") < middle
    ended = [r.message for r in logged(spark, root, "code = '000200'")]
    assert len(ended) == 2 and any(m.startswith(f"history rows: {before - middle} of 50 done") for m in ended)
    run(spark, root).backfill_priority()
    assert published(spark, root, "pretprioritaire").filter("traite = 'N'").count() == 0
    open_before = nulls(spark, root, "adh1pacpf", "pacmht")
    run(spark, root).split_net_tax()
    assert nulls(spark, root, "adh1pacpf", "pacmht") < open_before
    assert [r.rc for r in logged(spark, root, "code = '000515'")] == [1]


def test_a_limited_run_writes_few_partitions(spark, root, monkeypatch):
    span = 500
    monkeypatch.setattr(schema, "SPANS", {**schema.SPANS, "adh1h43pf": ("h43kmv", span)})
    publish(spark, root, {"adh1h43pf": Views(spark, SF_DIR).history()}, {})
    before, keys = folders(spark, root, "adh1h43pf"), published(spark, root, "adh1h43pf")
    limited = run(spark, root, quantity="30")
    limited.backfill_history()
    after = folders(spark, root, "adh1h43pf")
    first = keys.filter("h43tau is null").orderBy("h43kmv", "h43nli", "h43ggi").limit(30)
    touched = {f"_part={r[0]}" for r in first.selectExpr(f"h43kmv div {span}").distinct().collect()}
    new = {f.part for f in after if f not in before}
    assert new and new <= touched and len(before) > 3 * len(touched)
    assert sum(f.rows for f in after) == sum(f.rows for f in before)
    assert {f.part for f in after} == {f.part for f in before}


def test_latest_batches_are_kept_up_from_new_folders(spark, root, monkeypatch):
    """Batches that arrive, are corrected or go away: only their folders are read, and the result is that of the whole table."""
    monkeypatch.setattr(schema, "SPANS", {**schema.SPANS, "p0egdepf": ("gdekro", 20), "latest_decision": ("gdekro", 20)})
    decision = Views(spark, SF_DIR).decision()
    publish(spark, root, {"p0egdepf": decision}, {})
    run(spark, root, company="1").list_members()

    def check(parts):
        latest, changed = (again := run(spark, root, company="1")).latest_batches()
        read = {f.split("run=")[1].split("/part-")[0] for f in latest.inputFiles() if "/p0egdepf/" in f}
        assert {r.partition("/")[2] for r in read} == parts
        whole = published(spark, root, "p0egdepf").groupBy("gdekro").agg(F.max("gdekrh"))
        again.list_members()
        assert rows(published(spark, root, "latest_decision")) == rows(whole)

    check(set())  # nothing is new
    keys = [r[0] for r in decision.selectExpr("gdekro div 20").distinct().collect()]
    assert len(keys) > 4
    low, high = min(keys), max(keys)
    late = published(spark, root, "p0egdepf").filter(f"gdekro div 20 = {low}").selectExpr(
        "gdekro", "gdekrh + 500 as gdekrh", "gdegar", "gdecdc", "gdedec", "gdecn1", "gdecn2", "gdecn3"
    )
    publish(spark, root, {}, {}, {"p0egdepf": late})  # rows are added
    check({f"_part={low}"})
    now = published(spark, root, "p0egdepf")
    gone = now.filter(f"gdekro div 20 = {high}")
    fewer = now.join(gone.groupBy("gdekro").agg(F.max("gdekrh").alias("gdekrh")), ["gdekro", "gdekrh"], "left_anti")
    publish(spark, root, {"p0egdepf": fewer}, {}, changed={"p0egdepf": gone.select("gdekro")})  # latest batches are taken away
    check({f"_part={high}"} & {f.part for f in folders(spark, root, "p0egdepf")})
    publish(spark, root, {"p0egdepf": decision}, {})


def test_the_second_of_two_runs_is_refused(spark, root):
    one, other = run(spark, root), run(spark, root, quantity="5")
    one.premium_report()
    with pytest.raises(VersionTaken):
        other.sync_salary()


def test_reconciliation_in_three_runs(spark, root):
    with pytest.raises(InvalidParameter, match="compagnie"):
        run(spark, root, company="2").list_members()
    with pytest.raises(InvalidParameter, match="quantite"):
        run(spark, root, company="1", quantity="1x").find_anomalies()
    run(spark, root, company="1").list_members()
    members = published(spark, root, "adhgde2")
    assert members.count() > 0 and members.filter("compagnie <> 1").count() == 0
    assert published(spark, root, "egdederdec").count() == members.select("kronoAdh").distinct().count()
    run(spark, root, company="1", quantity="3").find_anomalies()
    assert published(spark, root, "adhgde2").filter("rechercheAno is not null").count() == 3
    run(spark, root, company="1").find_anomalies()
    wrong = published(spark, root, "adhgde2").filter("garantie is not null").count()
    assert wrong > 0
    # a batch that arrives after the list step changes nothing: the listed one is followed
    listed = published(spark, root, "egdederdec")
    decision = published(spark, root, "p0egdepf")
    late = decision.join(listed, F.col("gdekro") == F.col("derkroAdh"), "left_semi").selectExpr(
        "gdekro", "gdekrh + 1000 as gdekrh", "gdegar + 50 as gdegar", "9 as gdecdc", "gdedec", "gdecn1", "gdecn2", "gdecn3"
    )
    publish(spark, root, {"p0egdepf": decision.union(late)}, {})
    run(spark, root, company="1").correct_anomalies()
    assert published(spark, root, "p0egdepf").filter("gdegar >= 50 and gdecdc <> 9").count() == 0
    assert logged(spark, root, "step = 'correct_anomalies' and code = '001401'")
    stamped = published(spark, root, "adhgde2").filter(f"dateModif = timestamp_ntz '{AS_OF}'")
    assert 0 < stamped.count() <= wrong
    assert rows(published(spark, root, "adhgde2sav")) == rows(stamped)
    first = stamped.count()
    run(spark, root, company="1").correct_anomalies()  # nothing left to correct; the archive keeps its rows and adds
    assert published(spark, root, "adhgde2sav").count() == 2 * first


def test_smaller_jobs(spark, root, capsys):
    main(["open_letters", "--root", root, "--day", "1998-01-01"])
    main(["premium_report", "--root", root])
    assert "premium_report: published version" in capsys.readouterr().out
    with pytest.raises(InvalidParameter, match="day"):
        run(spark, root).open_letters()
    run(spark, root, quantity="20").sync_salary()
    main(["sync_salary", "--root", root])  # without a quantity, all
    assert published(spark, root, "premium_report").count() > 0
    assert published(spark, root, "employee").count() == Views(spark, SF_DIR).employee().count()


def test_nothing_is_published_when_the_log_cannot_be_written(spark, root, monkeypatch):
    before = published(spark, root, "adh1pacpf").inputFiles()
    broken = lambda rows, day: rows.withColumn("rc", F.raise_error(F.lit("no log")).cast("int"))
    monkeypatch.setattr("amendry.run.dated", broken)
    with pytest.raises(Exception):
        run(spark, root).split_net_tax()
    assert published(spark, root, "adh1pacpf").inputFiles() == before
