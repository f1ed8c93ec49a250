"""Scalar functions against Python's decimal arithmetic and hand-made values."""

from datetime import date, datetime
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings as rules
from hypothesis import strategies as st
from pyspark.sql import functions as F

from amendry.functions import dates, money, text

CENT, MILLI = Decimal("0.01"), Decimal("0.001")


def expected_split(gross: Decimal, rate: Decimal):
    factor = (rate / 100 + 1).quantize(MILLI, ROUND_DOWN)
    net = (gross / factor).quantize(CENT, ROUND_HALF_UP)
    return factor, net, gross - net


@pytest.mark.filterwarnings("ignore")
@rules(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(-99_999_999_999, 99_999_999_999).map(lambda c: Decimal(c) * CENT),
            st.integers(0, 99_999).map(lambda m: Decimal(m) * MILLI),
        ),
        min_size=1,
        max_size=300,
    )
)
def test_split_matches_decimal_arithmetic(spark, pairs):
    df = spark.createDataFrame(pairs, "gross decimal(11,2), rate decimal(5,3)")
    factor = money.tax_factor(F.col("rate"))
    net = money.net_amount(F.col("gross"), factor)
    got = df.select("gross", "rate", factor, net, money.tax_amount(F.col("gross"), net)).collect()
    for gross, rate, *values in got:
        assert tuple(values) == expected_split(gross, rate)


def test_factor_truncates_where_rounding_would_not(spark):
    df = spark.createDataFrame([(Decimal("8.150"),)], "r decimal(5,3)")
    assert df.select(money.tax_factor(F.col("r"))).first()[0] == Decimal("1.081")


def test_rule_rate(spark):
    data = [(date(2018, 12, 31), 3), (date(2019, 1, 1), 3), (date(2018, 12, 31), 4), (date(2019, 1, 1), 4)]
    df = spark.createDataFrame(data, "created date, cover int")
    got = [int(r[0]) for r in df.select(money.rule_rate(F.col("created"), F.col("cover"))).collect()]
    assert got == [0, 9, 9, 9]


def test_numeric_dates(spark):
    df = spark.sql("select * from values (date '2020-06-03'), (date '0001-01-01'), (null) as t(d)")
    got = df.select(dates.date8(F.col("d")), dates.date8_or_zero(F.col("d")), dates.is_open(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(20200603, 20200603, False), (10101, 0, True), (None, 0, None)]


def test_open_date_survives_a_written_table(spark, tmp_path):
    spark.sql("select date '0001-01-01' as d").write.parquet(f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").filter(dates.is_open(F.col("d"))).count() == 1


def test_age_ignores_the_birthday(spark):
    df = spark.createDataFrame([(date(1990, 12, 31),), (None,)], "b date")
    assert [r[0] for r in df.select(dates.age_in_years(F.col("b"), date(2020, 1, 1))).collect()] == [30, None]


def test_on_day_is_half_open(spark):
    stamps = ["2020-06-02 23:59:59.999999", "2020-06-03 00:00:00", "2020-06-03 23:59:59.999999", "2020-06-04 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz"))
    kept = df.filter(dates.on_day(F.col("s"), date(2020, 6, 3))).collect()
    assert [r[0] for r in kept] == [datetime(2020, 6, 3), datetime(2020, 6, 3, 23, 59, 59, 999999)]


def test_text_to_number_never_fails(spark):
    values = [" 00003001366", "   ", "", "12x", None, "123456789012"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    assert [r[0] for r in df.select(text.to_id(F.col("t"))).collect()] == [3001366, None, None, None, None, None]


def test_char_and_message(spark):
    df = spark.createDataFrame([(7, None, "ab  ")], "a int, b int, c string")
    assert df.select(text.message("k: ", F.col("a"), " v: ", F.col("b"), F.col("c"), ".")).first()[0] == "k: 7 v: ab."
    assert df.select(text.message("x" * 60)).first()[0] == "x" * 50
    assert df.select(text.char_n(F.col("c"), 3), text.char_n(F.col("c"), 6)).first()[:] == ("ab ", "ab    ")
    assert df.select(text.is_blank(F.lit("   ")), text.is_blank(F.col("c"))).first()[:] == (True, False)
