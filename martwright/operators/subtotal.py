"""Totals over the printed rows of a report.

They fold report rows, not facts: a sum of distinct counts is just that sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.money import half_up_ratio

def subtotal(report: DataFrame, aggs: dict[str, list[str]], by: list[str] | None = None) -> DataFrame:
    """One row per ``by`` group (one row in all without it).

    ``aggs`` maps ``sum`` or ``avg`` to report columns; results are named
    ``total_<column>`` and ``average_<column>``. Averages of money are rounded
    to cents from their exact value.
    """

    def average(column: str):
        if isinstance(report.schema[column].dataType, DecimalType):
            return half_up_ratio(F.sum(column), F.count(column))
        return F.avg(column)

    totals = [F.sum(c).alias(f"total_{c}") for c in aggs.get("sum", [])]
    averages = [average(c).alias(f"average_{c}") for c in aggs.get("avg", [])]
    return report.groupBy(*(by or [])).agg(*totals, *averages)
