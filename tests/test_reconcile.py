"""Reconciliation: member list, anomalies, corrections, re-runs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from amendry.plans import reconcile
from amendry.sources.schema import MEMBERS
from amendry.sources.workspace import Workspace
from tests.conftest import rows

AS_OF = datetime(2020, 6, 3, 12)
OB = "00002642739 0000300{:04d}"


@pytest.fixture(scope="module")
def data(spark):
    member = spark.createDataFrame(
        [(k, 2, 4) for k in range(1, 9)] + [(9, 2, 1), (10, 3, 4)], "adhkro bigint, adhcie int, adhcor int"
    )
    reference = spark.createDataFrame(
        [(k, OB.format(k)) for k in range(1, 11) if k != 7]
        + [(7, "00002642739 00003000007 00003001366")],
        "laekro bigint, laeref string",
    )
    decision = spark.createDataFrame(
        [
            # kro, batch, cover, decision; member 5 holds none
            (1, 100, 3, 1), (1, 200, 3, 2), (1, 200, 5, 1), (1, 200, 7, None),
            (2, 100, 3, 1),
            (3, 100, 3, 1),
            (4, 100, 3, 1), (4, 100, 5, 4),
            (6, 100, 3, 1), (6, 100, 5, 0),
            (7, 100, 3, 1),
            (8, 100, 3, 1), (8, 100, 3, 2),
            (9, 100, 3, 1), (10, 100, 3, 1),
        ],
        "gdekro bigint, gdekrh bigint, gdegar int, gdecdc int",
    ).selectExpr("*", "20000101 as gdedec", "8 as gdecn1", "8 as gdecn2", "8 as gdecn3")
    found = [
        # decision id, OB, cover, date, code
        (901, 3000001, 3, date(2019, 3, 4), 5), (902, 3000001, 5, None, 1), (903, 3000001, 7, date(2019, 1, 1), None),
        (904, 3000002, 3, date(2019, 1, 1), 1),
        (906, 3000004, 3, date(2019, 1, 1), 1), (907, 3000004, 3, date(2019, 1, 1), 2), (908, 3000004, 5, date(1, 1, 1), 9),
        (909, 3000006, 3, date(2019, 1, 1), 1),
        (910, 3000007, 3, date(2019, 1, 1), 1),
        (911, 3000008, 3, date(2019, 1, 1), 1),
        (999, 3000001, 3, date(2018, 1, 1), 7),  # superseded: no pointer names it
    ]
    source = spark.createDataFrame(
        [(d, ob, g, day and day.isoformat(), c) for d, ob, g, day, c in found],
        "decdec bigint, decoba bigint, decgar int, day string, dectdp int",
    ).select("decdec", "decoba", "decgar", F.col("day").cast("date").alias("decdat"), "dectdp")
    pointer = source.filter("decdec <> 999").selectExpr("decdec as ddodec", "decoba as ddooba")
    exclusion = spark.createDataFrame(
        [(901, 3, 3000001, 1, 11), (901, 3, 3000001, 1, 12), (901, 3, 3000001, 3, 13), (901, 3, 3000001, 4, 99)],
        "excdec bigint, excgar int, excoba bigint, excord int, exccod int",
    )
    return dict(member=member, reference=reference, decision=decision, pointer=pointer, source=source, exclusion=exclusion)


@pytest.fixture(scope="module")
def members(data):
    return reconcile.list_members(data["member"], data["reference"], data["decision"], company=2, with_decision_only=False)


def tables(members, data):
    latest = data.get("latest") or reconcile.latest_decisions(members, data["decision"])
    return members, latest, data["decision"], data["pointer"], data["source"]


def search(members, data, **options):
    found = reconcile.find_anomalies(*tables(members, data), **options)
    return found.members, found.rejects


def correct(members, data, **options):
    done = reconcile.correct_anomalies(*tables(members, data), data["exclusion"], **{"as_of": AS_OF, **options})
    return done.decisions, done.members


def test_list(spark, data):
    base = (data["member"], data["reference"], data["decision"])
    listed = reconcile.list_members(*base, company=2)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in listed.schema] == MEMBERS.split(", ")
    assert [r.kronoAdh for r in listed.orderBy("kronoAdh").collect()] == [1, 2, 3, 4, 6, 7, 8]
    first = listed.filter("kronoAdh = 1").first()
    assert (first.numDemSR, first.numObaSR, first.garantie) == (2642739, 3000001, None)
    single = reconcile.list_members(*base, company=2, exclude_multi_ob=True)
    assert 7 not in [r.kronoAdh for r in single.collect()]
    assert rows(reconcile.latest_decisions(listed, data["decision"]))[0] == (1, 200)


def test_blank_ob_is_kept_without_number(spark, data):
    reference = spark.createDataFrame([(1, "00002642739            ")], "laekro bigint, laeref string")
    listed = reconcile.list_members(data["member"], reference, data["decision"])
    assert listed.first().numObaSR is None
    assert search(listed, data)[0].first().decisionSR == "not found"


EXPECTED = {
    # garantie, decisionSR, decisionGDE, rechercheAno, correctionAno
    1: ("3/", "5/", "2/", "O", None),  # cover 5 agrees, cover 7 is NULL on both sides
    2: (None, None, None, "O", "N"),
    3: (None, "not found", None, "N", None),
    4: ("5/", "9/", "4/", "O", None),  # cover 3 is ambiguous: neither listed nor corrected
    5: (None, None, "not found", "N", None),
    6: ("5/", "-/", "0/", "O", None),
    7: (None, None, None, "O", "N"),
    8: ("3/", "1/", "2/", "O", None),  # two rows on one cover, one differs
}


def states(members):
    return {
        r.kronoAdh: (r.garantie, r.decisionSR, r.decisionGDE, r.rechercheAno, r.correctionAno) for r in members.collect()
    }


def test_find(members, data):
    searched, rejected = search(members, data)
    assert states(searched) == EXPECTED
    assert sorted((r.key, r.rc) for r in rejected.collect()) == [(3, 100), (4, -811), (6, 100)]


def test_find_limit_leaves_the_rest_unsearched(members, data):
    searched, _ = search(members, data, limit="3")
    got = states(searched)
    assert {k: v for k, v in got.items() if k <= 3} == {k: EXPECTED[k] for k in (1, 2, 3)}
    assert all(v == (None,) * 5 for k, v in got.items() if k > 3)
    # the next run goes on with the others
    assert states(search(searched, data)[0]) == EXPECTED


def test_find_rerun_changes_nothing(members, data):
    searched, _ = search(members, data)
    again, rejected = search(searched, data)
    assert rows(again) == rows(searched) and rejected.count() == 0


def test_correct(spark, members, data):
    work = Workspace(spark)
    searched = work.stage(search(members, data)[0], "searched")
    decisions, done = correct(searched, data, work=work)
    assert decisions.columns == data["decision"].columns
    old = {(r.gdekro, r.gdekrh, r.gdegar, r.gdecdc) for r in data["decision"].collect()}
    got = sorted(tuple(r) for r in decisions.filter("gdecn1 <> 8 or gdedec <> 20000101").collect())
    assert got == [
        # every batch of member 1 and cover 3
        (1, 100, 3, 5, 20190304, 12, 0, 13),
        (1, 200, 3, 5, 20190304, 12, 0, 13),
        (4, 100, 5, 9, 0, 0, 0, 0),  # open date -> 0
        (8, 100, 3, 1, 20190101, 0, 0, 0),
        (8, 100, 3, 1, 20190101, 0, 0, 0),
    ]
    assert decisions.count() == len(old)
    changed = {r.kronoAdh: (r.correctionAno, r.dateModif) for r in done.collect() if r.dateModif is not None}
    # member 6: its listed cover has no decision there and 0 here, so nothing is to correct
    assert changed == {1: ("O", AS_OF), 4: ("O", AS_OF), 8: ("O", AS_OF)}
    again = correct(done, {**data, "decision": decisions}, as_of=datetime(2021, 1, 1))
    assert rows(again[0]) == rows(decisions) and rows(again[1]) == rows(done)


def test_correct_only_one_company(members, data):
    searched, _ = search(members, data)
    decisions, done = correct(searched, data, company=3)
    assert rows(decisions) == rows(data["decision"]) and rows(done) == rows(searched)


def test_decision_without_counterpart_is_zeroed(spark, members, data):
    decision = data["decision"].withColumn("gdecdc", F.expr("case when gdekro = 6 and gdegar = 5 then 2 else gdecdc end"))
    changed = {**data, "decision": decision}
    searched, _ = search(members, changed)
    decisions, _ = correct(searched, changed)
    row = decisions.filter("gdekro = 6 and gdegar = 5").first()
    assert (row.gdecdc, row.gdedec, row.gdecn1, row.gdecn2, row.gdecn3) == (0, 0, 0, 0, 0)


def test_parameters(spark):
    company = spark.createDataFrame([(2, 0), (3, 0), (3, 0), (4, 1)], "ciecie int, cieban int")
    calls = [
        (1, "*lst  ", "2   ", ""), (2, "*ano  ", "2   ", "10"), (3, "*upd  ", "2   ", ""),
        (4, "*xyz  ", "    ", ""), (5, "*ano  ", "2   ", "        "), (6, "*ano  ", "2   ", "1x"),
        (7, "*lst  ", "    ", ""), (8, "*lst  ", "A   ", ""), (9, "*lst  ", "3   ", ""), (10, "*lst  ", "4   ", ""),
        (11, "*lst  ", "77  ", ""),
    ]
    params = spark.createDataFrame(calls, "prm_id int, option string, compagnie string, quantite string")
    got = {r.prm_id: r.parameter for r in reconcile.check_parameters(params, company).collect()}
    assert got == {4: "option", 5: "quantite", 6: "quantite", **{k: "compagnie" for k in (7, 8, 9, 10, 11)}}


def two_obs(spark, data):
    """Member 1 has two OBs that disagree on cover 3; member 2 has two that agree."""
    reference = spark.createDataFrame(
        [(1, OB.format(1)), (1, OB.format(2)), (2, OB.format(2)), (2, OB.format(9))], "laekro bigint, laeref string"
    )
    decision = spark.createDataFrame(
        [(1, 200, 3, 4, 0, 8, 8, 8), (2, 100, 3, 7, 0, 8, 8, 8)],
        "gdekro bigint, gdekrh bigint, gdegar int, gdecdc int, gdedec int, gdecn1 int, gdecn2 int, gdecn3 int",
    )
    listed = reconcile.list_members(data["member"], reference, decision, company=2)
    extra = spark.createDataFrame([(912, 3000009, 3, "2019-01-01", 1)], "decdec bigint, decoba bigint, decgar int, day string, dectdp int")
    source = data["source"].union(extra.selectExpr("decdec", "decoba", "decgar", "cast(day as date)", "dectdp"))
    pointer = data["pointer"].union(extra.selectExpr("decdec", "decoba"))
    return listed, {**data, "decision": decision, "source": source, "pointer": pointer}


def test_lists_are_made_per_ob(spark, data):
    listed, own = two_obs(spark, data)
    got = {(r.kronoAdh, r.numObaSR): (r.garantie, r.decisionSR, r.decisionGDE) for r in search(listed, own)[0].collect()}
    assert got == {
        (1, 3000001): ("3/", "5/", "4/"), (1, 3000002): ("3/", "1/", "4/"),
        (2, 3000002): ("3/", "1/", "7/"), (2, 3000009): ("3/", "1/", "7/"),
    }


def test_conflicts_are_rejected_and_leave_the_member_open(spark, data):
    listed, own = two_obs(spark, data)
    searched = Workspace(spark).stage(search(listed, own)[0], "searched")
    done = reconcile.correct_anomalies(*tables(searched, own), own["exclusion"], as_of=AS_OF)
    assert {(r.gdekro, r.gdecdc) for r in done.decisions.collect()} == {(1, 4), (2, 1)}
    stamps = {(r.kronoAdh, r.numObaSR): (r.correctionAno, r.dateModif) for r in done.members.collect()}
    assert {k: v for k, v in stamps.items() if k[0] == 1} == {(1, 3000001): (None, None), (1, 3000002): (None, None)}
    assert {v for k, v in stamps.items() if k[0] == 2} == {("O", AS_OF)}
    assert [(r.code, r.key, r.rc) for r in done.rejects.collect()] == [("CONFLICT", 1, -811)]


def test_no_step_looks_for_the_latest_batch_again(spark, data, members):
    latest = Workspace(spark).stage(reconcile.latest_decisions(members, data["decision"]), "latest")
    own = {**data, "latest": latest}
    for frame in (search(members, own)[0], correct(search(members, own)[0], own)[0]):
        assert "max(gdekrh" not in frame._jdf.queryExecution().optimizedPlan().toString()
