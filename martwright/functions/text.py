"""Text and date-text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_text(name: str, alias: str | None = None) -> Column:
    return F.upper(F.col(name)).alias(alias or name)


def text_after_nth(value: Column, mark: str, nth: int) -> Column:
    """What follows the nth occurrence of ``mark``; NULL if there are fewer or nothing follows."""
    rest = F.substring_index(value, mark, nth)
    tail = F.substring(value, F.length(rest) + len(mark) + 1, F.length(value))
    return F.nullif(tail, F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """``first || ' ' || last`` where a missing part counts as empty text."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def parse_day_month_year(value: Column) -> Column:
    """``17-NOV-16`` style text to date; two-digit years 50-99 belong to the 1900s."""
    parsed = F.to_date(F.initcap(value), "dd-MMM-yy")
    return F.when(F.year(parsed) >= 2050, F.add_months(parsed, -1200)).otherwise(parsed)
