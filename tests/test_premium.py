"""Premium jobs: every rejection branch, conservation, re-runs, limits."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from amendry.operators.change import reset_null
from amendry.plans import premium
from amendry.sources.schema import struct
from amendry.sources.workspace import Workspace
from tests.conftest import rows

D = Decimal
STAMP = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def ref(spark):
    """Loans 1..8 behind movements 10..80; one branch each."""
    loan_rows = [(k, 25, 500 + k, date(2019, 5, 1)) for k in (1, 2, 3, 4, 6, 7)] + [
        (5, 25, 505, date(2019, 5, 1)),
        (5, 25, 505, date(2019, 5, 1)),  # loan 5 is repeated
        (8, 25, 501, date(2001, 1, 1)),  # before the first rate
    ]
    loan = spark.createDataFrame(loan_rows, "prtkro bigint, prtcie int, prtban bigint, prtdrt date")
    banks = [(501, 71), (502, 71), (505, 71), (506, 71), (506, 72), (507, 99)]
    bank = spark.createDataFrame(banks, "bqeban bigint, bqeptx int")
    movement = spark.createDataFrame(
        [(k * 10, k) for k in range(1, 9)] + [(20, 2), (90, 99)], "madkmv bigint, madkro bigint"
    )
    rate = spark.createDataFrame(
        [
            (25, 71, 15, date(2010, 1, 1), D("7.000")),
            (25, 71, 15, date(2019, 5, 1), D("9.000")),
            (25, 71, 15, date(2019, 5, 2), D("8.000")),
            (25, 71, 3, date(2010, 1, 1), D("1.000")),
            (25, 71, 3, date(2010, 1, 1), D("2.000")),
        ],
        "x_ciecode int, f_idpays int, taxgar int, valid_from date, tau decimal(5,3)",
    )
    return dict(movement=movement, loan=loan, bank=bank, rate=rate)


def history_row(kmv, cover, tau=None, line=1):
    return (STAMP, D("10.00"), date(2019, 1, 1), line, kmv, cover, tau, None, None, None)


@pytest.fixture(scope="module")
def history(spark):
    data = [
        history_row(10, 15),
        history_row(10, 15, D("3.000"), 2),  # already set
        history_row(20, 15),  # movement repeated
        history_row(30, 15),  # bank 503 missing
        history_row(40, 15, line=4),  # bank 504 missing
        history_row(50, 15),  # loan repeated
        history_row(60, 15),  # bank repeated
        history_row(70, 15),  # no rate for country 99
        history_row(80, 15),  # before the first rate
        history_row(10, 3, line=3),  # two rates on one day
        history_row(90, 15),  # movement without loan
        history_row(0, 15),  # no movement
    ]
    return spark.createDataFrame(data, struct("adh1h43pf"))


def test_history_branches(history, ref):
    job = premium.backfill_history(history, **ref)
    statuses = {(r.h43kmv, r.h43ggi): r.status for r in job.resolved.collect()}
    assert statuses == {
        (10, 15): "OK",
        (20, 15): "AMBIGUOUS_LOAN",
        (30, 15): "NO_BANK",
        (40, 15): "NO_BANK",
        (50, 15): "AMBIGUOUS_LOAN",
        (60, 15): "AMBIGUOUS_BANK",
        (70, 15): "NO_RATE",
        (80, 15): "NO_RATE",
        (10, 3): "AMBIGUOUS_RATE",
        (90, 15): "NO_LOAN",
        (0, 15): "NO_LOAN",
    }
    taxed = {(r.h43kmv, r.h43nli): r.h43tau for r in job.table.collect() if r.h43tau is not None}
    assert taxed == {(10, 1): D("9.000"), (10, 2): D("3.000")}
    assert job.table.columns == history.columns and job.table.count() == history.count()
    assert rows(job.summary) == [(11, 1, 10, "01")]
    assert job.rejects.count() == 10
    assert {r.message for r in job.rejects.collect() if r.key == 0} == {"NO_LOAN: no single loan for movement 0"}


def test_history_rerun_changes_nothing(history, ref):
    once = premium.backfill_history(history, **ref).table
    again = premium.backfill_history(once, **ref)
    assert rows(again.table) == rows(once)
    assert rows(again.summary)[0][1] == 0
    # resetting every rate and running again gives the job's own rates
    reset = premium.backfill_history(reset_null(once, "h43tau"), **ref).table
    assert {r.h43tau for r in reset.collect() if r.h43kmv == 10 and r.h43ggi == 15} == {D("9.000")}


def test_staged_run_equals_plain_run(spark, history, ref):
    plain = premium.backfill_history(history, **ref)
    staged = premium.backfill_history(history, **ref, work=Workspace(spark))
    assert rows(staged.table) == rows(plain.table)
    assert rows(staged.rejects) == rows(plain.rejects)


@pytest.mark.parametrize("limit", ["0", "1", "5", "*all", "99999999"])
def test_history_limit_handles_exactly_n(history, ref, limit):
    job = premium.backfill_history(history, **ref, limit=limit)
    todo = history.filter("h43tau is null").count()
    handled = todo if limit == "*all" else min(int(limit), todo)
    assert job.resolved.count() == handled
    assert job.table.count() == history.count()
    if limit == "5":  # in order of movement
        assert sorted(r.h43kmv for r in job.resolved.collect()) == [0, 10, 10, 20, 30]


def tier_row(key, loan, cover, amount="100.00", tau=None, net=None):
    return (key, amount and D(amount), date(2019, 1, 1), STAMP, loan, cover, tau, None, net, "OLD")


@pytest.fixture(scope="module")
def tier(spark):
    data = [
        tier_row(1, 1, 15),
        tier_row(2, 1, 15, tau=D("3.000")),
        tier_row(3, 3, 15),  # no bank
        tier_row(4, 6, 15),  # loan not on the worklist
        tier_row(5, 5, 15),  # loan repeated
        tier_row(6, 1, 15, amount=None),
        tier_row(7, 1, 15, net=D("1.00")),
        tier_row(8, 99, 15),  # no such loan
    ]
    return spark.createDataFrame(data, struct("adh1pacpf"))


@pytest.fixture(scope="module")
def priority(spark):
    return spark.createDataFrame(
        [(1, "N"), (3, "N"), (5, "N"), (6, "O"), (99, "N"), (4295327, "N")], "idpret bigint, traite string"
    )


def backfill(tier, priority, ref, **options):
    return premium.backfill_priority(tier, priority, ref["loan"], ref["bank"], ref["rate"], **options)


def test_priority_branches(tier, priority, ref):
    job = backfill(tier, priority, ref)
    assert {r.pacpac: r.status for r in job.resolved.collect()} == {
        1: "OK", 3: "NO_BANK", 5: "AMBIGUOUS_LOAN", 6: "OK", 7: "OK", 8: "NO_LOAN"
    }
    assert {r.pacpac: r.pactau for r in job.table.collect()} == {
        1: D("9.000"), 2: D("3.000"), 3: None, 4: None, 5: None, 6: D("9.000"), 7: D("9.000"), 8: None
    }
    assert rows(job.per_loan) == [(1, 3), (3, 0), (5, 0), (99, 0)]
    assert rows(job.summary) == [(6, 3, 3, "01")]


def test_priority_flags(tier, priority, ref):
    assert {r.traite for r in backfill(tier, priority, ref).worklist.collect()} == {"O"}
    clean = backfill(tier, priority, ref, only_if_clean=True).worklist
    assert dict(map(tuple, clean.collect())) == {1: "O", 3: "N", 5: "N", 6: "O", 99: "N", 4295327: "O"}


def test_priority_rerun_changes_nothing(tier, priority, ref):
    first = backfill(tier, priority, ref)
    again = backfill(first.table, first.worklist, ref)
    assert rows(again.table) == rows(first.table)
    assert again.resolved.count() == 0 and rows(again.worklist) == rows(first.worklist)


def test_repeated_worklist_loans_do_not_repeat_tiers(tier, priority, ref):
    twice = backfill(tier, priority.unionByName(priority), ref)
    assert twice.table.count() == tier.count()


def test_split_branches(tier, ref):
    job = premium.split_net_tax(tier, ref["loan"], ref["bank"], ref["rate"])
    assert {r.pacpac: r.status for r in job.resolved.collect()} == {
        1: "OK", 2: "OK", 3: "NO_LOAN", 4: "AMBIGUOUS_LOAN", 5: "AMBIGUOUS_LOAN", 6: "NO_AMOUNT", 8: "NO_LOAN"
    }
    got = {r.pacpac: (r.pacmht, r.pacmtx, r.pacpro) for r in job.table.collect()}
    assert got[1] == (D("91.74"), D("8.26"), "A0OAV")  # 100 / 1.09
    assert got[7] == (D("1.00"), None, "OLD") and got[6] == (None, None, "OLD")
    again = premium.split_net_tax(job.table, ref["loan"], ref["bank"], ref["rate"])
    assert rows(again.table) == rows(job.table)
    assert rows(job.summary) == [(7, 2, 5, "01")]


def test_split_loan_with_two_copies_of_which_one_has_a_bank(spark, ref):
    """The joined rows are counted: a second loan row without bank does not make it ambiguous."""
    loan = spark.createDataFrame(
        [(1, 25, 501, date(2019, 5, 1)), (1, 25, 599, date(2019, 5, 1))],
        "prtkro bigint, prtcie int, prtban bigint, prtdrt date",
    )
    tier = spark.createDataFrame([tier_row(1, 1, 15)], struct("adh1pacpf"))
    assert premium.split_net_tax(tier, loan, ref["bank"], ref["rate"]).resolved.first().status == "OK"
