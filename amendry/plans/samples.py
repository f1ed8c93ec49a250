"""Smaller jobs: open letters, salary sync and the premium context report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amendry.functions.dates import is_open
from amendry.functions.text import message
from amendry.operators.change import update_from_table
from amendry.operators.joins import having_match, without_match
from amendry.operators.order import ascending, descending, first_rows, sorted_rows

# Kind of letter, labels and width of the report line.
LETTER_KIND = 250
REPORT_LABELS = ("F_CIECODE: ", " F_BANCODE: ", " F_IDGARGARANTIEINC: ", " C_DATEREFERENCETARIFAIRE: ", ".")
REPORT_WIDTH = 50


def open_letters(letter: DataFrame, followup: DataFrame, loan: DataFrame, day: date) -> DataFrame:
    """Letters of one day still open and never followed up, with their loan."""
    waiting = letter.filter((F.col("cornat") == LETTER_KIND) & is_open(F.col("cordte")) & (F.col("cordat") == F.lit(day)))
    unanswered = without_match(waiting, followup, [("corkro", "csukro")])
    same_loan = (F.col("cornum") == F.col("prtnum")) & (F.col("corord") == F.col("prtord"))
    found = unanswered.join(loan, same_loan, "inner")
    found = found.select("corkro", "cornum", "corord", "cordat", "prtkro", "prtres", "prtmot")
    return sorted_rows(found, ascending("cornum", "corord"))


def youngest(employee: DataFrame, n: int | str) -> DataFrame:
    """First n employees by birth date, latest first (an unknown date ranks highest)."""
    return first_rows(employee, n, descending("birthdate") + ascending("empno"))


def chosen_wages(employee: DataFrame, wage: DataFrame, n: int | str) -> DataFrame:
    """Wage rows of the first n employees."""
    return having_match(wage, youngest(employee, n).select("empno"), [("empno", "empno")])


def with_salary(employee: DataFrame, chosen: DataFrame) -> DataFrame:
    return update_from_table(employee, chosen, [("empno", "empno")], "salary", "salary")


def sync_salary(employee: DataFrame, wage: DataFrame, n: int | str) -> DataFrame:
    """Give the first n employees the salary of their wage row, if they have exactly one."""
    return with_salary(employee, chosen_wages(employee, wage, n))


def premium_context(history: DataFrame, movement: DataFrame, loan: DataFrame) -> DataFrame:
    """History rows without a rate, beside the loan of their movement."""
    # movements meet their loans first, so that the history, the large side, is exchanged once
    loans = movement.join(loan, F.col("madkro") == F.col("prtkro"))
    return history.filter(F.col("h43tau").isNull()).join(loans, F.col("h43kmv") == F.col("madkmv"))


def report_line() -> Column:
    cie, bank, cover, day, end = REPORT_LABELS
    parts = (cie, F.col("prtcie"), bank, F.col("prtban"), cover, F.col("h43ggi"), day, F.col("prtdrt"), end)
    return message(*parts, width=REPORT_WIDTH)


def premium_report(history: DataFrame, movement: DataFrame, loan: DataFrame) -> DataFrame:
    """The premium context as printed lines."""
    return premium_context(history, movement, loan).select("h43kmv", "h43nli", report_line().alias("line"))
