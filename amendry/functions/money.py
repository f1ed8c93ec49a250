"""Tax arithmetic on exact decimals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rule-based rate.
PIVOT_DATE = date(2019, 1, 1)
DEATH_COVER = 3
RATE_BEFORE_PIVOT = 0
RATE_OTHERWISE = 9


def tax_factor(rate: Column) -> Column:
    """rate/100 + 1 kept to three decimals by truncation, never by rounding."""
    thousandths = F.floor((rate / F.lit(100) + F.lit(1)) * F.lit(1000))
    return (thousandths / F.lit(1000)).cast("decimal(5,3)")


def net_amount(gross: Column, factor: Column) -> Column:
    """gross / factor, half-adjusted to cents (ROUND is half-up on decimals)."""
    return F.round(gross / factor, 2).cast("decimal(11,2)")


def tax_amount(gross: Column, net: Column) -> Column:
    return (gross - net).cast("decimal(11,2)")


def rule_rate(created: Column, cover: Column, pivot: date = PIVOT_DATE) -> Column:
    """Death cover on contracts created before the pivot is untaxed, all else takes 9 %."""
    exempt = (created < F.lit(pivot)) & (cover == DEATH_COVER)
    return F.when(exempt, RATE_BEFORE_PIVOT).otherwise(RATE_OTHERWISE).cast("decimal(5,3)")
