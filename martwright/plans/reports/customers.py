"""Reports about customers and their places."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.money import half_up_ratio, null_safe_ratio
from ...operators.ranking import top_k_with_ties
from .common import sales_of, sum_when


def _by_place_and_month(report: DataFrame, *last: str) -> DataFrame:
    """Sorted by name besides, so that the rows of one place and month spread over many tasks."""
    return report.orderBy(F.asc_nulls_last("customer_geography"), "cal_month_no_in_year", "customer_name", *last)


def _monthly_by_customer(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Quantity times price per customer, year and month, unrounded, with place and name.

    Summed by customer key first, so that a customer's name and place join a few
    dozen rows instead of every line.
    """
    sums = (
        sales_of(star, [year, year - 1], "cal_year", "cal_month_no_in_year", "cal_month_name")
        .groupBy("customer_key", "cal_year", "cal_month_no_in_year", "cal_month_name")
        .agg(F.sum(F.col("item_quantity") * F.col("unit_price")).alias("amount"))
    )
    people = star["dim_customers"].select("customer_key", "customer_geography", "customer_name")
    return sums.join(people, "customer_key").withColumn("month", F.initcap("cal_month_name"))


def _revenues(year: int):
    return [
        sum_when(F.col("cal_year") == year, F.col("amount")).alias("revenue"),
        sum_when(F.col("cal_year") == year - 1, F.col("amount")).alias("prev_year_revenue"),
    ]


def geo_monthly(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Monthly revenue by place and customer; each row holds one of the two years."""
    rows = (
        _monthly_by_customer(star, year)
        .groupBy("customer_geography", "customer_name", "month", "cal_month_no_in_year", "cal_year")
        .agg(*_revenues(year))
    )
    return _by_place_and_month(rows, "cal_year").select(
        "customer_geography",
        "customer_name",
        "month",
        F.col("cal_year").cast("string").alias("year"),
        "revenue",
        "prev_year_revenue",
    )


def geo_monthly_yoy(star: dict[str, DataFrame], year: int) -> DataFrame:
    """The same with both years of a month on one row."""
    rows = (
        _monthly_by_customer(star, year)
        .groupBy("customer_geography", "customer_name", "month", "cal_month_no_in_year")
        .agg(*_revenues(year))
    )
    return _by_place_and_month(rows).select(
        "customer_geography", "customer_name", "month", "revenue", "prev_year_revenue"
    )


def cltv_top10(star: dict[str, DataFrame], year: int, k: int = 10) -> DataFrame:
    """The ``k`` customers of highest lifetime value, ties included.

    Value = average line x (orders / order days) x (days from first to last order
    / 365), rounded once from exact integers. The distinct counts come from plain
    sums over ever coarser groups (order, day, customer) rather than from one
    expanded distinct aggregate, and a heavy customer stays spread by order.
    """
    orders = (
        sales_of(star, [year])
        .groupBy("customer_key", "order_date", "order_id")
        .agg(F.sum("order_total_price").alias("amount"), F.count("order_total_price").alias("lines"))
    )
    days = orders.groupBy("customer_key", "order_date").agg(
        F.sum("amount").alias("amount"), F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("orders")
    )
    customers = days.join(
        star["dim_customers"].select("customer_key", "customer_id", "customer_name", "credit_limit"), "customer_key"
    )
    values = (
        customers.groupBy("customer_id", "customer_name", "credit_limit", "order_date")
        .agg(F.sum("amount").alias("amount"), F.sum("lines").alias("lines"), F.sum("orders").alias("orders"))
        .groupBy("customer_id", "customer_name", "credit_limit")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("lines").alias("lines"),
            F.sum("orders").alias("orders"),
            F.count(F.lit(1)).alias("days"),
            F.datediff(F.max("order_date"), F.min("order_date")).alias("span"),
        )
        .where(F.col("orders") > 1)
    )
    whole = "decimal(20,0)"
    worth = F.col("amount") * F.col("orders").cast(whole) * F.col("span").cast("decimal(5,0)")
    parts = F.col("lines").cast(whole) * F.col("days").cast("decimal(5,0)") * F.lit(365)
    report = values.select(
        "customer_id",
        "customer_name",
        "credit_limit",
        half_up_ratio(F.col("amount"), F.col("lines")).alias("avg_purchase_value_per_year"),
        # All orders lie in one year, so orders per year is their number.
        F.col("orders").alias("num_of_purchases_per_year"),
        half_up_ratio(F.col("span"), F.lit(365)).alias("avg_customer_lifespan"),
        half_up_ratio(worth, parts).alias("customer_lifetime_value"),
    )
    return top_k_with_ties(report, "customer_lifetime_value", k, "ranking").orderBy("ranking", "customer_id")


def retention(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Customers by place and category: who bought this year, who the year before.

    "Retained" are buyers of ``year``, "acquired" buyers of the year before,
    neither needs the other. One flag row per customer and category makes the three
    distinct counts plain sums.
    """
    this, last = F.col("cal_year") == year, F.col("cal_year") == year - 1
    flags = (
        sales_of(star, [year - 1, year], "cal_year")
        .join(star["dim_products"].select("product_key", "product_category"), "product_key")
        .groupBy("customer_key", "product_category")
        .agg(
            F.max(F.when(this & (F.col("item_quantity") > 0), 1).otherwise(0)).alias("bought_this"),
            F.max(F.when(last, 1).otherwise(0)).alias("bought_last"),
            sum_when(last, F.col("unit_price")).alias("spent_last"),
        )
    )
    groups = (
        flags.join(star["dim_customers"].select("customer_key", "customer_geography"), "customer_key")
        .groupBy("customer_geography", "product_category")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.sum("bought_last").alias("acquired_customers"),
            F.sum("bought_this").alias("retained_customers"),
            F.sum("spent_last").alias("spent_last"),
        )
        .where((F.col("acquired_customers") > 0) & (F.col("retained_customers") > 0))
    )
    rate = null_safe_ratio(F.col("retained_customers"), F.col("total_customers")) * 100
    by_rate = Window.partitionBy("customer_geography").orderBy(F.desc_nulls_first("retention_rate"))
    ranked = groups.withColumn("retention_rate", rate).select(
        F.dense_rank().over(by_rate).alias("ranking"),
        "customer_geography",
        "product_category",
        "total_customers",
        "acquired_customers",
        "retained_customers",
        "retention_rate",
        null_safe_ratio(F.col("spent_last"), F.col("acquired_customers")).alias("cac"),
    )
    return ranked.orderBy(F.asc_nulls_last("customer_geography"), "ranking", "product_category")
