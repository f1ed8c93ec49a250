"""Premium jobs: dated tax-rate backfill and the net/tax split.

A job returns one `resolved` frame (the worklist with looked-up values and a status) and
what follows from it. Pass a workspace to stage `resolved` once, so that table, rejects and
summary read it back instead of repeating the joins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amendry.functions.money import net_amount, tax_amount, tax_factor
from amendry.operators import change
from amendry.operators.asof import asof_lookup
from amendry.operators.joins import guarded_join, having_match
from amendry.operators.lookup import OK, one_per_key
from amendry.operators.order import ALL, ascending, split_first
from amendry.operators.rejects import RC_NULL, End, Reason, end_message, rejects, run_summary, updated_per_key
from amendry.sources.workspace import Workspace

NO_LOAN, AMBIGUOUS_LOAN = "NO_LOAN", "AMBIGUOUS_LOAN"
NO_BANK, AMBIGUOUS_BANK = "NO_BANK", "AMBIGUOUS_BANK"
NO_RATE, AMBIGUOUS_RATE = "NO_RATE", "AMBIGUOUS_RATE"
NO_AMOUNT = "NO_AMOUNT"
PROFILE = "A0OAV"  # fixed value: profile written by the split

# The message codes and kinds. The texts are this library's own.
HISTORY_LOAN = Reason("000303", "no single loan for movement {h43kmv}")
TIER_LOAN = Reason("000480", "no single loan {packro}")
HISTORY_BANK = Reason("000325", "no single bank {prtban}")
TIER_BANK = Reason("000502", "no single bank {prtban}")
HISTORY_RATE = Reason("000376", "no single rate for cover {h43ggi}, country {bqeptx}, company {prtcie}")
TIER_RATE = Reason("000553", "no single rate for cover {pacggi}, country {bqeptx}, company {prtcie}")
SPLIT_AMOUNT = Reason("000379", "a tier of loan {packro} has no amount", "*SQL", rc=RC_NULL)
SPLIT_LOAN = Reason("000419", "no single loan with its bank for {packro}", "*SQL")
SPLIT_RATE = Reason("000458", "no single rate for loan {packro}")
ENDS = {
    "backfill_history": End("000200", "000200", "history rows"),
    "backfill_priority": End("000204", "000204", "tiers of priority loans"),
    "split_net_tax": End("000507", "000515", "tiers split"),
}

HISTORY_REASONS = {
    NO_LOAN: HISTORY_LOAN,
    AMBIGUOUS_LOAN: HISTORY_LOAN,
    NO_BANK: HISTORY_BANK,
    AMBIGUOUS_BANK: HISTORY_BANK,
    NO_RATE: HISTORY_RATE,
    AMBIGUOUS_RATE: HISTORY_RATE,
}
TIER_REASONS = {
    NO_LOAN: TIER_LOAN,
    AMBIGUOUS_LOAN: TIER_LOAN,
    NO_BANK: TIER_BANK,
    AMBIGUOUS_BANK: TIER_BANK,
    NO_RATE: TIER_RATE,
    AMBIGUOUS_RATE: TIER_RATE,
}
SPLIT_REASONS = {
    NO_AMOUNT: SPLIT_AMOUNT,
    NO_LOAN: SPLIT_LOAN,
    AMBIGUOUS_LOAN: SPLIT_LOAN,
    NO_RATE: SPLIT_RATE,
    AMBIGUOUS_RATE: SPLIT_RATE,
}


class JobResult:
    """The handled rows with their status, and what follows from them, each built on first use."""

    step: str
    key: str
    reasons: dict[str, Reason]

    def __init__(self, resolved: DataFrame, untouched: DataFrame, columns: list[str]):
        self.resolved, self.untouched, self.columns = resolved, untouched, columns

    def updated(self) -> DataFrame:
        raise NotImplementedError

    @cached_property
    def table(self) -> DataFrame:
        """The whole table after the job."""
        return self.untouched.unionByName(self.updated().select(*self.columns))

    @cached_property
    def changed(self) -> DataFrame:
        """Keys of the rows that the job changes."""
        return self.resolved.filter(F.col("status") == OK).select(self.key)

    @cached_property
    def rejects(self) -> DataFrame:
        return rejects(self.resolved, self.step, self.key, self.reasons)

    @cached_property
    def summary(self) -> DataFrame:
        return run_summary(self.resolved)

    @cached_property
    def end(self) -> DataFrame:
        return end_message(self.summary, self.step, ENDS[self.step])


class HistoryBackfill(JobResult):
    step, key, reasons = "backfill_history", "h43kmv", HISTORY_REASONS

    def updated(self) -> DataFrame:
        return change.fill_null(self.resolved, "h43tau", F.col("tau"))


class PriorityBackfill(JobResult):
    step, key, reasons = "backfill_priority", "packro", TIER_REASONS

    def __init__(self, looked: DataFrame, untouched, columns, priority: DataFrame, only_if_clean: bool):
        super().__init__(looked.filter("_open"), untouched, columns)
        self.looked, self.priority, self.only_if_clean = looked, priority, only_if_clean

    def updated(self) -> DataFrame:
        # tiers of other loans are among these rows; having no context, they keep their NULL
        return change.fill_null(self.looked, "pactau", F.col("tau"))

    @cached_property
    def open_loans(self) -> DataFrame:
        """Loans of the worklist that were still to do."""
        return self.priority.filter(F.col("traite") == "N").select("idpret")

    @cached_property
    def worklist(self) -> DataFrame:
        """The worklist with handled loans flagged O."""
        if not self.only_if_clean:
            return change.mark_processed(self.priority, "traite")
        failed = self.resolved.filter(F.col("status") != OK).select("packro").distinct()
        failed = failed.withColumn("_failed", F.lit(True))
        flagged = guarded_join(self.priority, failed, [("idpret", "packro")], "left")
        return change.mark_processed(flagged, "traite", F.col("_failed").isNull()).drop("_failed")

    @cached_property
    def per_loan(self) -> DataFrame:
        return updated_per_key(self.resolved, "packro")


class NetTaxSplit(JobResult):
    step, key, reasons = "split_net_tax", "packro", SPLIT_REASONS

    def __init__(self, resolved: DataFrame, untouched, columns, profile: str):
        super().__init__(resolved, untouched, columns)
        self.profile = profile

    def updated(self) -> DataFrame:
        done = F.col("status") == OK
        tax = tax_amount(F.col("pacmpa"), F.col("_net"))
        return self.resolved.withColumns(
            {
                "pacmht": F.col("_net"),
                "pacmtx": F.when(done, tax).otherwise(F.col("pacmtx")),
                "pacpro": F.when(done, F.lit(self.profile)).otherwise(F.col("pacpro")),
            }
        )


def loan_context(loan: DataFrame, bank: DataFrame) -> DataFrame:
    """Per loan: how many loans and banks were found, company, rate date and tax country.

    Bank codes are resolved here, on loans, so that premium rows are shuffled only once.
    """
    loans = one_per_key(loan, ["prtkro"], ["prtcie", "prtdrt", "prtban"], "loan_n")
    banks = one_per_key(bank, ["bqeban"], ["bqeptx"], "bank_n")
    return guarded_join(loans, banks, [("prtban", "bqeban")], "left")


def movement_loans(movement: DataFrame, loans: DataFrame, cols: list[str]) -> DataFrame:
    """Per movement: the loan it belongs to. Loan copies arrive as a count, so rows are never paired up."""
    joined = guarded_join(movement, loans, [("madkro", "prtkro")], "inner")
    return one_per_key(joined, ["madkmv"], cols, "loan_n", weight="loan_n")


def movement_context(movement: DataFrame, loan: DataFrame, bank: DataFrame) -> DataFrame:
    """Per movement: company, rate date, bank and tax country of its loan."""
    return movement_loans(movement, loan_context(loan, bank), ["prtcie", "prtdrt", "prtban", "bqeptx", "bank_n"])


# first lookup of the chain loan -> bank -> rate that failed, or OK
RATE_STATUS = f"""case
    when loan_n is null or loan_n = 0 then '{NO_LOAN}'
    when loan_n > 1 then '{AMBIGUOUS_LOAN}'
    when bank_n is null then '{NO_BANK}'
    when bank_n > 1 then '{AMBIGUOUS_BANK}'
    when rc = 100 then '{NO_RATE}'
    when rc <> 0 then '{AMBIGUOUS_RATE}'
    else '{OK}' end"""


def with_rate(rows: DataFrame, rate: DataFrame, cover: str) -> DataFrame:
    """Add the tax rate in force on the loan's rate date, and the status of the whole chain."""
    keys = [("prtcie", "x_ciecode"), ("bqeptx", "f_idpays"), (cover, "taxgar")]
    rated = asof_lookup(rows, rate, keys, "prtdrt", "valid_from", "tau")
    return rated.withColumn("status", F.expr(RATE_STATUS))


def backfill_history(
    history: DataFrame,
    movement: DataFrame,
    loan: DataFrame,
    bank: DataFrame,
    rate: DataFrame,
    limit: int | str = ALL,
    work: Workspace | None = None,
) -> HistoryBackfill:
    """Fill the tax rate of history rows that have none: movement -> loan -> bank -> dated rate."""
    columns = history.columns
    worklist = history.filter(F.col("h43tau").isNull())
    untouched = history.filter(F.col("h43tau").isNotNull())
    if limit != ALL:
        work = work or Workspace(history.sparkSession)
        worklist, later = split_first(worklist, limit, ascending("h43kmv", "h43nli", "h43ggi"))
        untouched = untouched.unionByName(later)
    context = movement_context(movement, loan, bank)
    resolved = with_rate(guarded_join(worklist, context, [("h43kmv", "madkmv")], "left"), rate, "h43ggi")
    if work is not None:
        resolved = work.stage(resolved, "backfill_history")
    return HistoryBackfill(resolved, untouched, columns)


def backfill_priority(
    tier: DataFrame,
    priority: DataFrame,
    loan: DataFrame,
    bank: DataFrame,
    rate: DataFrame,
    only_if_clean: bool = False,
    work: Workspace | None = None,
) -> PriorityBackfill:
    """Fill the tax rate of tiers of the loans flagged N, then flag those loans O.

    With only_if_clean, loans keep N when one of their tiers was rejected.
    """
    columns = tier.columns
    open_loans = priority.filter(F.col("traite") == "N").select(F.col("idpret").alias("_loan")).distinct()
    # both sides hold one row per loan; tiers then meet them in a single join
    context = open_loans.join(loan_context(loan, bank), F.col("_loan") == F.col("prtkro"), "left").drop("prtkro")
    context = context.withColumn("_open", F.lit(True))
    todo = guarded_join(tier.filter(F.col("pactau").isNull()), context, [("packro", "_loan")], "left")
    looked = with_rate(todo, rate, "pacggi")
    if work is not None:
        looked = work.stage(looked, "backfill_priority")
    untouched = tier.filter(F.col("pactau").isNotNull())
    return PriorityBackfill(looked, untouched, columns, priority, only_if_clean)


def worklist_detail(tier: DataFrame, priority: DataFrame) -> DataFrame:
    """Open tiers (no rate) of the loans still to do."""
    todo = tier.filter(F.col("pactau").isNull())
    return having_match(todo, priority.filter(F.col("traite") == "N"), [("packro", "idpret")])


def bank_loan_context(loan: DataFrame, bank: DataFrame) -> DataFrame:
    """Per loan, the rows of bank joined to loan: their number and, when single, their columns."""
    banks = one_per_key(bank, ["bqeban"], ["bqeptx"], "bank_n")
    loans = loan.select("prtkro", "prtcie", "prtdrt", "prtban")
    joined = guarded_join(loans, banks, [("prtban", "bqeban")], "inner")
    return one_per_key(joined, ["prtkro"], ["prtcie", "prtdrt", "bqeptx"], "loan_n", weight="bank_n")


def split_net_tax(
    tier: DataFrame,
    loan: DataFrame,
    bank: DataFrame,
    rate: DataFrame,
    profile: str = PROFILE,
    work: Workspace | None = None,
) -> NetTaxSplit:
    """Split the gross amount into net and tax on tiers that have no net amount."""
    columns = tier.columns
    todo = guarded_join(
        tier.filter(F.col("pacmht").isNull()), bank_loan_context(loan, bank), [("packro", "prtkro")], "left"
    )
    todo = todo.withColumn("bank_n", F.lit(1))  # bank and loan are one lookup here
    resolved = with_rate(todo, rate, "pacggi")
    status = F.when(F.col("pacmpa").isNull(), NO_AMOUNT).otherwise(F.col("status"))
    net = F.when(F.col("status") == OK, net_amount(F.col("pacmpa"), tax_factor(F.col("tau"))))
    resolved = resolved.withColumn("status", status).withColumn("_net", net)
    if work is not None:
        resolved = work.stage(resolved, "split_net_tax")
    return NetTaxSplit(resolved, tier.filter(F.col("pacmht").isNotNull()), columns, profile)
