"""Reports with one row per salesman.

The unknown member may hold a third of all lines; it is filtered on the fact's
own key, before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.money import half_up_ratio
from ...functions.text import full_name
from ...operators.dims import UNKNOWN_EMPLOYEE_KEY
from .common import per_quarter, sales_of


def _known(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("employee_key") != UNKNOWN_EMPLOYEE_KEY)


def _people(star: dict[str, DataFrame]) -> DataFrame:
    return star["dim_employees"].select(
        "employee_key",
        "employee_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("employee_name"),
        "job_title",
    )


def employee_quarterly(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Sales per quarter, best seller first, from one scan.

    Quarters add up per employee id; quantity and amount per name and title, which
    differ only if an id has versions.
    """
    quarters = ["quarter1", "quarter2", "quarter3", "quarter4"]
    by_key = (
        _known(sales_of(star, [year], "cal_quarter"))
        .groupBy("employee_key")
        .agg(
            *per_quarter("order_total_price"),
            F.sum("item_quantity").alias("sales_quantity"),
            F.sum("order_total_price").alias("sales_amount"),
        )
    )
    by_person = (
        by_key.join(_people(star), "employee_key")
        .groupBy("employee_id", "employee_name", "job_title")
        .agg(*[F.sum(c).alias(c) for c in [*quarters, "sales_quantity", "sales_amount"]])
    )
    same_id = Window.partitionBy("employee_id")
    return (
        by_person.withColumns({q: F.sum(q).over(same_id) for q in quarters})
        .orderBy(F.desc_nulls_first("sales_amount"), "employee_id")
        .select("employee_id", "employee_name", "job_title", *quarters, "sales_quantity", "sales_amount")
    )


def employee_performance(star: dict[str, DataFrame]) -> DataFrame:
    """Lines, sales, average line, distinct customers and shipped share per salesman.

    Lines shrink to (salesman, customer) pairs first: a salesman with a third of
    all lines is spread over his customers.
    """
    pairs = (
        _known(star["sales_fact"])
        .groupBy("employee_key", "customer_key")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("order_status") == "SHIPPED").alias("shipped"),
            F.sum("order_total_price").alias("amount"),
        )
    )
    by_key = (
        pairs.join(star["dim_customers"].select("customer_key", "customer_id"), "customer_key")
        .groupBy("employee_key")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("shipped").alias("shipped"),
            F.sum("amount").alias("amount"),
            F.count_distinct("customer_id").alias("new_customers_acquired"),
        )
    )
    return (
        by_key.join(_people(star), "employee_key")
        .select(
            "employee_id",
            "employee_name",
            "job_title",
            F.col("lines").alias("order_quantity"),
            F.col("amount").alias("sales_amount"),
            half_up_ratio(F.col("amount"), F.col("lines")).alias("average_order_value"),
            "new_customers_acquired",
            half_up_ratio(F.col("shipped"), F.col("lines"), times=100).alias("conversion_rate"),
        )
        .orderBy(F.desc_nulls_first("sales_amount"), "employee_id")
    )
