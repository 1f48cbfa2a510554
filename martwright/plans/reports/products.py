"""Reports with one row per product.

Sales are summed by surrogate key before they meet the wide product rows, so
neither names nor descriptions travel with the facts; a second, small
aggregation joins up versions that share their visible attributes.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.money import half_up_ratio
from .common import per_quarter, sales_of

_ATTRIBUTES = ["product_id", "product_name", "product_description", "product_category"]


_SUMS = {
    "units": F.sum,
    "revenue": F.sum,
    "booked_profit": F.sum,
    "last_sale": F.max,
}


def _by_product_and_cost(sales: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
    """Units, revenue and profit per product and cost.

    ``profit`` needs no sum of its own, as the cost is the same in all of a
    group's lines; ``booked_profit`` adds up the lines' gross profits, rounded to
    cents each. What a report does not use is not read.
    """
    sums = sales.groupBy("product_key", "standard_cost").agg(
        F.sum("item_quantity").alias("units"),
        F.sum("order_total_price").alias("revenue"),
        F.sum("gross_profit").alias("booked_profit"),
        F.max("order_date").alias("last_sale"),
    )
    return (
        sums.join(star["dim_products"].select("product_key", *_ATTRIBUTES), "product_key")
        .groupBy(*_ATTRIBUTES, "standard_cost")
        .agg(*[fold(name).alias(name) for name, fold in _SUMS.items()])
        .withColumn("profit", F.col("revenue") - F.col("units") * F.col("standard_cost"))
    )


def low_margin(star: dict[str, DataFrame], threshold: float = 0.2) -> DataFrame:
    """Products whose gross margin over all sales is below ``threshold``.

    Compared without a division; a negative revenue turns the comparison round, and without revenue there is no margin.
    """
    bound = F.col("revenue") * F.lit(Decimal(str(threshold)))
    below = F.when(F.col("revenue") > 0, F.col("profit") < bound).when(F.col("revenue") < 0, F.col("profit") > bound)
    return (
        _by_product_and_cost(star["sales_fact"], star)
        .where(below)
        .select(
            *_ATTRIBUTES,
            "standard_cost",
            F.col("units").alias("sales_unit"),
            F.col("revenue").alias("sales_revenue"),
            F.round("booked_profit", 0).alias("gross_profit"),
            half_up_ratio(F.col("booked_profit"), F.col("revenue"), times=100).alias("gross_profit_margin"),
        )
        .orderBy("gross_profit_margin", "product_id")
    )


def top_products(star: dict[str, DataFrame], year: int, k: int = 10) -> DataFrame:
    """The ``k`` best-selling products of a year; equal sales go by product id."""
    year_start = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    return (
        _by_product_and_cost(sales_of(star, [year]), star)
        .orderBy(F.desc_nulls_first("revenue"), "product_id")
        .limit(k)
        .select(
            *_ATTRIBUTES,
            F.when(F.col("last_sale") >= year_start, "ACTIVE").otherwise("INACTIVE").alias("product_status"),
            "standard_cost",
            F.col("units").alias("sales_unit"),
            F.col("revenue").alias("sales_amount"),
            F.round("profit", 2).alias("sales_profit"),
            half_up_ratio(F.col("profit"), F.col("revenue"), times=100).alias("profit_contribution"),
        )
    )


def _quarterly(star: dict[str, DataFrame], year: int, profit: str, revenue: str) -> DataFrame:
    return (
        sales_of(star, [year], "cal_quarter")
        .groupBy("product_key")
        .agg(
            *per_quarter(profit),
            F.sum("item_quantity").alias("quantity"),
            F.sum(revenue).alias("total_revenue"),
            F.count_if(F.col("cal_quarter") == "Q1").alias("q1_lines"),
        )
    )


_QUARTERLY_SUMS = ["quarter1", "quarter2", "quarter3", "quarter4", "quantity", "total_revenue", "q1_lines"]


def _quarterly_rows(joined: DataFrame) -> DataFrame:
    quarters = F.col("quarter1") + F.col("quarter2") + F.col("quarter3") + F.col("quarter4")
    return (
        joined.groupBy("product_id", "product_name")
        .agg(*[F.sum(c).alias(c) for c in _QUARTERLY_SUMS])
        .withColumn("total_profit", quarters)
    )


_QUARTERLY_COLUMNS = [
    "product_id",
    "product_name",
    "quarter1",
    "quarter2",
    "quarter3",
    "quarter4",
    "quantity",
    "total_profit",
    "total_revenue",
]


def product_quarterly(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Quarterly profit per product sold in the first quarter.

    Profit and revenue add up per unit, not per line, and a product without
    first-quarter sales does not appear; see ``product_quarterly_all``.
    """
    names = star["dim_products"].select("product_key", "product_id", "product_name")
    joined = _quarterly(star, year, "unit_profit", "unit_price").join(names, "product_key")
    return _quarterly_rows(joined).where(F.col("q1_lines") > 0).select(_QUARTERLY_COLUMNS)


def product_quarterly_all(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Quarterly profit by line totals, for every product, sold or not."""
    names = star["dim_products"].select("product_key", "product_id", "product_name")
    joined = names.join(_quarterly(star, year, "gross_profit", "order_total_price"), "product_key", "left")
    return _quarterly_rows(joined.fillna(0, _QUARTERLY_SUMS)).select(_QUARTERLY_COLUMNS)
