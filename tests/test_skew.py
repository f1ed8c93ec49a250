"""One key holding a third of all rows: joins split it, aggregations shrink it before the shuffle."""

import pytest
from pyspark.sql import functions as F

from amendry.plans import premium, reconcile
from amendry.sources import buckets
from amendry.sources.views import Views
from amendry.sources.workspace import Workspace
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.1"


class Skewed(Views):
    """The test tables with a third of the order lines on one order and of the orders on one customer."""

    def source(self, name):
        df = super().source(name)
        if name == "lineitem":
            return df.repartition(8).withColumn(
                "l_orderkey", F.expr("case when l_partkey % 3 = 0 then 7 else l_orderkey end")
            )
        if name == "orders":
            return df.repartition(8).withColumn(
                "o_custkey", F.expr("case when o_orderkey % 3 = 0 then 777 else o_custkey end")
            )
        return df


@pytest.fixture
def views(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__shuffle__partitions="16",
    )
    return Skewed(spark, SF_DIR)


def joins_of(df):
    """Run, then list the joins of the final plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    return [line for line in plan.splitlines() if "SortMergeJoin" in line]


def is_split(df, key):
    return any(f"SortMergeJoin(skew=true) [~{key}#" in line for line in joins_of(df))


def test_history_join_splits_the_hot_movement(views):
    job = premium.backfill_history(views.history(), views.movement(), views.loan(), views.bank(), views.rate())
    assert is_split(job.table, "h43kmv")


def test_loan_join_splits_the_hot_bank(views):
    assert is_split(premium.loan_context(views.loan(), views.bank()), "prtban")


def test_priority_count_per_loan_splits_the_hot_loan(views):
    """Grouping by the join key afterwards does not prevent the split."""
    worklist = views.priority().withColumn("traite", F.lit("N")).unionByName(
        views.spark.createDataFrame([(7, "N")], "idpret bigint, traite string")
    )
    job = premium.backfill_priority(views.tier(), worklist, views.loan(), views.bank(), views.rate())
    assert is_split(job.per_loan, "packro")


def test_decision_join_splits_the_hot_member(views):
    members = reconcile.list_members(views.member(), views.reference(), views.decision())
    compared = reconcile.compared_decisions(
        members,
        reconcile.latest_decisions(members, views.decision()),
        views.decision(),
        views.latest_pointer(),
        views.source_decision(),
    )
    assert is_split(compared, "gdekro")


def test_no_plan_forces_a_broadcast(views):
    """With the size threshold off, nothing is broadcast: no side carries a hint."""
    job = premium.backfill_history(views.history(), views.movement(), views.loan(), views.bank(), views.rate())
    job.table.collect()
    assert "Broadcast" not in job.table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_bucketed_join_exchanges_no_stored_row(spark, settings, how):
    """A third of all rows on one key, a tenth without a key: the others stay in their buckets, hot ones stay where they are read."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.range(9000).selectExpr("if(id % 10 = 9, null, if(id % 3 = 0, 7, id % 200)) as k", "id as v").repartition(5)
    ref = spark.range(0, 190).selectExpr("id as r", "id * 2 as w")
    folder = Workspace(spark).path("bucketed")
    buckets.write_bucketed(facts, "k", 4, f"{folder}/facts", hot_rows=1000)
    buckets.write_bucketed(ref, "r", 4, f"{folder}/ref")
    stored = buckets.read_bucketed(spark, f"{folder}/facts")
    assert rows(stored.hot_keys) == [(None,), (7,)] and stored.hot.count() + stored.cold.count() == 9000
    expected = rows(facts.join(ref, F.col("k") == F.col("r"), how).drop("r"))
    for partner, exchanges in ((ref, 1), (buckets.read_bucketed(spark, f"{folder}/ref"), 0)):
        joined = buckets.bucketed_join(stored, partner, "r", how)
        assert rows(joined) == expected
        plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == exchanges, plan
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    assert buckets.bucketed_join(stored, ref, "r", how).filter("k = 7").count() == sum(r[0] == 7 for r in expected)
    spark.sql(f"drop table {buckets._name(folder + '/facts')}")  # as another session would find it
    assert rows(buckets.bucketed_join(buckets.read_bucketed(spark, f"{folder}/facts"), ref, "r", how)) == expected
    with pytest.raises(ValueError, match="how"):
        buckets.bucketed_join(stored, ref, "r", "full")
