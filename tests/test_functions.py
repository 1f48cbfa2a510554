from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import day
from martwright.functions import half_up_ratio, parse_day_month_year, text_after_nth


def test_two_digit_years(spark):
    texts = ["17-NOV-16", "01-JAN-50", "31-DEC-49", "29-FEB-96", "03-Jan-17", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_day_month_year(F.col("t")).alias("d"))
    assert [r.d for r in rows.collect()] == [
        day("2016-11-17"),
        day("1950-01-01"),
        day("2049-12-31"),
        day("1996-02-29"),
        day("2017-01-03"),
        None,
    ]


def test_text_behind_the_second_comma(spark):
    texts = ["A, B, C", "A, B,", "A, B", "", "A, B, C, D", "A,B,"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(text_after_nth(F.col("t"), ",", 2).alias("g"))
    assert [r.g for r in rows.collect()] == [" C", None, None, None, " C, D", None]


def test_ratio_is_exact_on_ties(spark):
    pairs = [("1.005", "1"), ("-1.005", "1"), ("2.675", "1"), ("1", "3"), ("2", "3"), ("1", "0"), ("-1", "8")]
    data = [(Decimal(a).scaleb(2), Decimal(b).scaleb(2)) for a, b in pairs]
    rows = spark.createDataFrame(data, "a decimal(20,2), b decimal(20,2)").select(
        half_up_ratio(F.col("a"), F.col("b")).alias("q")
    )
    assert [None if r.q is None else str(r.q) for r in rows.collect()] == [
        "1.01",
        "-1.01",
        "2.68",
        "0.33",
        "0.67",
        None,
        "-0.13",
    ]


def test_ratio_of_four_decimals_and_large_sums(spark):
    data = [(Decimal("0.0001"), Decimal("0.0002")), (Decimal("9" * 28 + ".9999"), Decimal("8" * 24 + ".0001"))]
    frame = spark.createDataFrame(data, "a decimal(38,4), b decimal(38,4)")
    rows = frame.select(half_up_ratio(F.col("a"), F.col("b")).alias("q"))
    assert [r.q for r in rows.collect()] == [Decimal("0.50"), Decimal("11250.00")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**12)), min_size=20, max_size=40))
def test_ratio_equals_decimal_arithmetic(spark, pairs):
    data = [(i, Decimal(a).scaleb(-2), b) for i, (a, b) in enumerate(pairs)]
    rows = spark.createDataFrame(data, "i int, a decimal(20,2), b bigint").select(
        "i", half_up_ratio(F.col("a"), F.col("b"), times=100).alias("q")
    )
    for row in rows.collect():
        _, a, b = data[row.i]
        assert row.q == (a * 100 / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP)
