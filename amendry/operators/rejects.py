"""Rejected rows with a reason, and run summaries."""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.functions.text import message
from amendry.operators.lookup import AMBIGUOUS, OK

COLUMNS = ["step", "code", "kind", "level", "key", "message", "rc"]

# Return codes of a lookup, and the levels of a run's last message.
RC_NOT_FOUND, RC_AMBIGUOUS, RC_NULL = 100, -811, -305
LEVEL_CLEAN, LEVEL_WITH_ERRORS = "00", "01"


@dataclass(frozen=True)
class Reason:
    """How one status is logged: message code, text with {column} places, kind, level and return code.

    Without a return code of its own, it follows from the status: several rows or none.
    """

    code: str
    text: str
    kind: str = "*Other"
    level: str = "INFO"
    rc: int | None = None

    def message(self) -> Column:
        parts = []
        for label, column, _, _ in Formatter().parse(self.text):
            parts += [label] + ([] if column is None else [F.col(column)])
        return message(*parts, width=None)


def rejects(df: DataFrame, step: str, key: str, reasons: dict[str, Reason], status: str = "status") -> DataFrame:
    """One log row per row whose status has a reason. The status name opens the text."""
    named = F.col(status)

    def per_status(value) -> Column:
        picked = F.lit(None)
        for name, reason in reasons.items():
            picked = F.when(named == name, value(reason)).otherwise(picked)
        return picked

    found = F.when(named.startswith(AMBIGUOUS), RC_AMBIGUOUS).otherwise(RC_NOT_FOUND)
    rc = F.coalesce(per_status(lambda r: F.lit(r.rc)).cast("int"), found)
    return df.filter(named.isin(*reasons)).select(
        F.lit(step).alias("step"),
        per_status(lambda r: F.lit(r.code)).alias("code"),
        per_status(lambda r: F.lit(r.kind)).alias("kind"),
        per_status(lambda r: F.lit(r.level)).alias("level"),
        F.col(key).cast("bigint").alias("key"),
        F.concat(named, F.lit(": "), per_status(lambda r: r.message())).alias("message"),
        rc.cast("int").alias("rc"),
    )


def run_summary(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows read, updated and failed, and the level of the run, in one pass."""
    ok = F.count_if(F.col(status) == OK)
    read = F.count(F.lit(1))
    return df.agg(
        read.alias("n_read"),
        ok.alias("n_updated"),
        (read - ok).alias("n_failed"),
        F.when(read == ok, LEVEL_CLEAN).otherwise(LEVEL_WITH_ERRORS).alias("level"),
    )


@dataclass(frozen=True)
class End:
    """A job's last log row: message codes for a clean run and one with errors, and what was handled."""

    clean: str
    with_errors: str
    what: str


def end_message(summary: DataFrame, step: str, end: End) -> DataFrame:
    """The run's last log row: rows updated out of rows read, and 0 or 1 for a clean run or not."""
    clean = F.col("level") == LEVEL_CLEAN
    count = F.concat(F.col("n_updated").cast("string"), F.lit(" of "), F.col("n_read").cast("string"))
    ending = F.when(clean, F.lit(" done")).otherwise(F.concat(F.lit(" done, "), F.col("n_failed").cast("string"), F.lit(" rejected")))
    return summary.select(
        F.lit(step).alias("step"),
        F.when(clean, end.clean).otherwise(end.with_errors).alias("code"),
        F.lit("*Other").alias("kind"),
        F.lit("INFO").alias("level"),
        F.lit(None).cast("bigint").alias("key"),
        F.concat(F.lit(f"{end.what}: "), count, ending).alias("message"),
        F.col("level").cast("int").alias("rc"),
    )


def updated_per_key(df: DataFrame, key: str, status: str = "status") -> DataFrame:
    return df.groupBy(key).agg(F.count_if(F.col(status) == OK).alias("n_updated"))
