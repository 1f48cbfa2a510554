"""Reports over product categories and months.

Sales are summed by product key before they meet its category; the groups that
follow are at most categories x months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.calendar import month_label
from ...functions.money import half_up_ratio, null_safe_ratio
from .common import sales_of, sum_when

# How a month compares with the one before.
IMPROVED, CONSTANT, REDUCED = "Improved Performance", "Constant Performance", "Reduced Performance"


def _categories(star: dict[str, DataFrame]) -> DataFrame:
    return star["dim_products"].select("product_key", "product_category")


def _growth(monthly: DataFrame) -> DataFrame:
    """Compare each month (month_no, product_category, sales_amount) with the one listed before it."""
    before = F.lag("sales_amount").over(Window.partitionBy("product_category").orderBy("month_no"))
    change = F.coalesce(F.signum(F.col("sales_amount") - F.col("pre")) * F.signum("pre"), F.lit(0.0))
    month = month_label(F.make_date(F.lit(2000), F.col("month_no"), F.lit(1)))
    return (
        monthly.withColumn("pre", before)
        .orderBy("month_no")
        .select(
            month.alias("sales_month"),
            "product_category",
            F.coalesce("sales_amount", F.lit(0)).alias("sales_amount"),
            F.coalesce("pre", F.lit(0)).alias("pre_sales_amount"),
            F.coalesce(
                half_up_ratio(F.col("sales_amount") - F.col("pre"), F.col("pre"), times=100), F.lit(0)
            ).alias("growth"),
            F.when(change > 0, IMPROVED)
            .when(change == 0, CONSTANT)
            .otherwise(REDUCED)
            .alias("sales_performance"),
        )
    )


def monthly_growth(star: dict[str, DataFrame], year: int, category: str) -> DataFrame:
    """Unit-price sales per month of one category and their growth over the month before."""
    wanted = _categories(star).where(F.col("product_category") == category.upper())
    monthly = (
        sales_of(star, [year], "cal_month_no_in_year")
        .groupBy("product_key", F.col("cal_month_no_in_year").alias("month_no"))
        .agg(F.sum("unit_price").alias("sales_amount"))
        .join(wanted, "product_key")
        .groupBy("month_no", "product_category")
        .agg(F.sum("sales_amount").alias("sales_amount"))
    )
    return _growth(monthly)


def monthly_growth_as_written(star: dict[str, DataFrame], year: int, category: str) -> DataFrame:
    """The literal text, whose calendar join pairs every sale with every day of the year.

    Each month then shows the category's all-time sales times its number of
    days, which needs one sum and a day count instead of the product.
    """
    wanted = _categories(star).where(F.col("product_category") == category.upper())
    by_product = star["sales_fact"].groupBy("product_key").agg(F.sum("unit_price").alias("amount"))
    total = by_product.join(wanted, "product_key").agg(F.sum("amount").alias("total")).scalar()
    monthly = (
        star["dim_date"]
        .where(F.col("cal_year") == year)
        .groupBy(F.col("cal_month_no_in_year").alias("month_no"))
        .agg(F.count(F.lit(1)).alias("days"))
        .withColumn("product_category", F.lit(category.upper()))
        .withColumn("sales_amount", total * F.col("days"))
        .where(F.col("sales_amount").isNotNull())
    )
    return _growth(monthly)


def annual_category(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Orders, sales, profit and average line per category and month."""
    return (
        sales_of(star, [year], "cal_month_name", "cal_month_no_in_year")
        .join(_categories(star), "product_key")
        .groupBy("product_category", "cal_month_name", "cal_month_no_in_year")
        .agg(
            F.count_distinct("order_id").alias("num_orders"),
            F.sum("order_total_price").alias("total_sales"),
            F.sum("gross_profit").alias("total_profit"),
            half_up_ratio(F.sum("order_total_price"), F.count("order_total_price")).alias("avg_sales_amount"),
        )
        .orderBy(F.asc_nulls_last("product_category"), "cal_month_no_in_year")
        .withColumnRenamed("cal_month_name", "sales_month")
        .drop("cal_month_no_in_year")
    )


def market_trend(star: dict[str, DataFrame], year: int, compare_year: int) -> DataFrame:
    """Category sales of two years side by side, ranked by relative difference."""
    this, other = F.col("cal_year") == year, F.col("cal_year") == compare_year
    amounts = {
        "initial_quantity": sum_when(this, F.col("item_quantity")),
        "initial_sales": sum_when(this, F.col("order_total_price")),
        "comparison_quantity": sum_when(other, F.col("item_quantity")),
        "comparison_sales": sum_when(other, F.col("order_total_price")),
    }
    sums = (
        sales_of(star, [year, compare_year], "cal_year")
        .groupBy("product_key")
        .agg(*[amount.alias(name) for name, amount in amounts.items()])
        .join(_categories(star), "product_key")
        .groupBy("product_category")
        .agg(*[F.sum(name).alias(name) for name in amounts])
    )
    diff = null_safe_ratio(100 * (F.col("initial_sales") - F.col("comparison_sales")), F.col("initial_sales"))
    # One row per category is left here, so one task numbers the category list.
    order = Window.orderBy(F.desc_nulls_first("percent_diff"), F.asc_nulls_last("product_category"))
    return (
        sums.withColumn("percent_diff", diff)
        .withColumn("quantity_diff", F.col("comparison_quantity") - F.col("initial_quantity"))
        .select(
            F.row_number().over(order).alias("ranking"),
            "product_category",
            "initial_quantity",
            "initial_sales",
            "comparison_quantity",
            "comparison_sales",
            "quantity_diff",
            "percent_diff",
        )
    )
