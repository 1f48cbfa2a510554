"""Shared access paths of the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def sales_of(star: dict[str, DataFrame], years: list[int], *calendar: str) -> DataFrame:
    """Sales of the given years with the named calendar attributes.

    The calendar decides membership (it is tiny and broadcast by its size); the
    same years also go on the fact's own columns, so the scan prunes year
    partitions, or row groups by date where the table is not partitioned.
    """
    fact = star["sales_fact"]
    if "order_year" in fact.columns:
        fact = fact.where(F.col("order_year").isin(years))
    else:
        day = F.col("order_date")
        spans = [(day >= F.lit(dt.date(y, 1, 1))) & (day <= F.lit(dt.date(y, 12, 31))) for y in years]
        either = spans[0]
        for span in spans[1:]:
            either = either | span
        fact = fact.where(either)
    days = star["dim_date"].where(F.col("cal_year").isin(years)).select("date_key", *calendar)
    return fact.join(days, "date_key")


def sum_when(condition: Column, value: Column) -> Column:
    # No typed zero inside the sum: short decimals are summed as longs, wider ones are not.
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def per_quarter(value: str) -> list[Column]:
    """One conditional sum per quarter: a pivot in a single scan."""
    return [
        sum_when(F.col("cal_quarter") == q, F.col(value)).alias(f"quarter{i}") for i, q in enumerate(QUARTERS, start=1)
    ]
