"""Every registered query against its SQL, on whole tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from amendry.queries import REGISTRY
from oracles import ORACLES
from amendry.plans import premium, reconcile
from amendry.sources.views import Views
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# compared row by row, as far as their SQL names an order that leaves no ties
SORTED = {"limit_n", "limit_large", "top_k", "log_by_day", "job_open_letters"}


# sorted by these keys; rows with equal keys may come in any order, so only the keys are compared one by one
SORTED_BY = {"sort_single": ["h43kmv"], "sort_multi": ["packro", "pacdep"], "sort_desc": ["birthdate"]}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(queries()) >= set(REGISTRY) and set(oracle_sql()) >= set(ORACLES)


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert df.columns == ["h43kmv", "h43nli", "h43ggi", "h43mpb", "h43deb", "h43tau"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    problem = difference(spark, con, name, REGISTRY[name], ORACLES[name], SF_DIR, ordered=name in SORTED)
    assert problem is None, problem  # an empty result counts as one


@pytest.mark.parametrize("name", sorted(SORTED_BY))
def test_sorts_in_order_over_several_partitions(spark, con, settings, name):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="5")
    frame = REGISTRY[name](spark, SF_DIR)
    assert frame.rdd.getNumPartitions() > 1
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    expected = [tuple(r[names.index(c)] for c in SORTED_BY[name]) for r in cursor.fetchall()]
    assert [tuple(r[c] for c in SORTED_BY[name]) for r in frame.collect()] == expected


def test_branches_reached_at_a_known_scale(spark):
    """Row counts obtained independently in SQL for the test tables at scale 0.01."""
    v = Views(spark, "/root/testdata/sf0.01")
    job = premium.backfill_history(v.history(), v.movement(), v.loan(), v.bank(), v.rate())
    assert dict(map(tuple, job.resolved.groupBy("status").count().collect())) == {
        "OK": 15442, "NO_RATE": 3304, "NO_BANK": 489, "AMBIGUOUS_LOAN": 411, "NO_LOAN": 400
    }
    members = reconcile.list_members(v.member(), v.reference(), v.decision(), with_decision_only=False)
    members = members.filter("numObaSR is null or numObaSR = kronoAdh + 3000000")  # first references
    once, latest = v.latest_pointer().distinct(), reconcile.latest_decisions(members, v.decision())
    search = reconcile.find_anomalies(members, latest, v.decision(), once, v.source_decision())
    counts = search.members.selectExpr(
        "count(*)", "count_if(garantie is not null)", "count_if(correctionAno = 'N')",
        "count_if(decisionSR = 'not found')", "count_if(decisionGDE = 'not found')",
    )
    assert tuple(counts.first()) == (1198, 640, 351, 146, 61)
    assert premium.worklist_detail(v.tier(), v.priority()).count() == 3882
