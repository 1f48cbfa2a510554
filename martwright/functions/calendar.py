"""Calendar attributes as built-in date expressions (all inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(day: Column) -> Column:
    """Full month name in capitals, e.g. ``MAY``."""
    return F.upper(F.date_format(day, "MMMM"))


def month_label_padded(day: Column, capitals: bool = True) -> Column:
    """Month name blank-padded to nine characters, as a fixed-width report shows it."""
    name = F.date_format(day, "MMMM")
    return F.rpad(F.upper(name) if capitals else name, 9, " ")


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of one calendar day; weeks end on Saturday, week numbers are ISO."""
    day_of_week = F.dayofweek(day)
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    return {
        "day_of_week": day_of_week,
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "last_day_in_month_ind": F.when(day == F.last_day(day), "Y").otherwise("N"),
        "cal_week_end_date": F.date_add(day, 7 - day_of_week),
        "cal_week_no_in_year": F.weekofyear(day),
        "cal_month_name": month_label_padded(day),
        "cal_month_no_in_year": F.month(day),
        "cal_year_month": F.date_format(day, "yyyy-MM"),
        "cal_quarter": quarter,
        "cal_year_quarter": F.concat(F.year(day).cast("string"), quarter),
        "cal_year": F.year(day),
        "holiday_ind": F.lit("N"),
        "weekday_ind": F.when(day_of_week.between(2, 6), "Y").otherwise("N"),
    }
