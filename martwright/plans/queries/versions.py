"""Slowly changing dimensions on the published star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import operators as op
from ...operators import dims
from .registry import Inputs, query

# After the first orders, so that some lines are older than every version.
FIRST_START = dt.date(1999, 6, 1)
CHANGE, SECOND_CHANGE, STALE = dt.date(2001, 1, 1), dt.date(2001, 7, 1), dt.date(1990, 1, 1)
RUN_DATE = dt.date(2002, 6, 30)


def _holidays(w: Inputs) -> DataFrame:
    """Christmas and New Year of every calendar year, and of the year after the last."""
    years = w.star["dim_date"].select("cal_year").distinct()
    wanted = years.select(F.explode(F.array("cal_year", F.col("cal_year") + 1)).alias("y")).distinct()
    return wanted.select(
        F.explode(F.array(F.make_date("y", F.lit(12), F.lit(25)), F.make_date("y", F.lit(1), F.lit(1)))).alias(
            "calendar_date"
        )
    )


@query("scd1_holidays")
def scd1_holidays(w: Inputs) -> DataFrame:
    return op.mark_holidays(w.star["dim_date"], _holidays(w))[0]


@query("scd1_missing")
def scd1_missing(w: Inputs) -> DataFrame:
    return op.mark_holidays(w.star["dim_date"], _holidays(w))[1]


@query("scd2_init")
def scd2_init(w: Inputs) -> DataFrame:
    return op.scd2_init(w.star["dim_products"], "products_active_flag", FIRST_START)


def _product_changes(w: Inputs) -> DataFrame:
    """Economy products change once, red ones twice; some changes are stale, name unknown ids or differ for one day."""
    economy = w.star["dim_products"].where(F.col("product_category") == "ECONOMY")

    def change(rows: DataFrame, start: dt.date, note: str, product_id=F.col("product_id")) -> DataFrame:
        return rows.select(
            product_id.alias("product_id"),
            F.lit(start).alias("start_date"),
            F.concat("product_description", F.lit(note)).alias("product_description"),
        )

    return (
        change(economy, CHANGE, " REV 2")
        .unionByName(change(economy.where(F.col("product_name").like("RED%")), SECOND_CHANGE, " REV 3"))
        .unionByName(change(economy.where(F.col("product_name").like("RED%")), SECOND_CHANGE, " REV 2B"))
        .unionByName(change(economy.where(F.col("product_name").like("OLD%")), STALE, " REV 0"))
        .unionByName(
            change(economy.where(F.col("product_name").like("BLUE%")), CHANGE, " REV 2", -1 - F.col("product_id"))
        )
    )


def _products(w: Inputs) -> tuple[DataFrame, DataFrame]:
    return op.scd2_apply(
        scd2_init(w), _product_changes(w), "product_id", "product_key", "products_active_flag", dims.PRODUCT_START
    )


@query("scd2_products")
def scd2_products(w: Inputs) -> DataFrame:
    return _products(w)[0]


@query("scd2_rejects")
def scd2_rejects(w: Inputs) -> DataFrame:
    return _products(w)[1]


@query("scd2_customers")
def scd2_customers(w: Inputs) -> DataFrame:
    """European customers get 500 more credit."""
    first = op.scd2_init(w.star["dim_customers"], "customer_active_flag", FIRST_START)
    changes = first.where(F.col("customer_geography") == " EUROPE").select(
        "customer_id",
        F.lit(CHANGE).alias("start_date"),
        (F.col("credit_limit") + 500).cast("decimal(8,2)").alias("credit_limit"),
    )
    return op.scd2_apply(first, changes, "customer_id", "customer_key", "customer_active_flag", dims.CUSTOMER_START)[0]


@query("scd2_employees")
def scd2_employees(w: Inputs) -> DataFrame:
    """One sales team is promoted; days employed are worked out anew."""
    first = op.scd2_init(w.star["dim_employees"], "employee_active_flag", FIRST_START)
    changes = first.where(F.col("job_title") == "SALES 1").select(
        "employee_id", F.lit(CHANGE).alias("start_date"), F.lit("SALES MANAGER").alias("job_title")
    )
    days = F.datediff(F.lit(RUN_DATE), "hire_date").cast("bigint")
    return op.scd2_apply(
        first,
        changes,
        "employee_id",
        "employee_key",
        "employee_active_flag",
        dims.EMPLOYEE_START,
        reserved_key=dims.UNKNOWN_EMPLOYEE_KEY,
        recompute={"no_of_days_employed": days},
    )[0]


@query("scd2_current")
def scd2_current(w: Inputs) -> DataFrame:
    return op.current(scd2_products(w), "products_active_flag")


@query("scd2_as_of_join")
def scd2_as_of_join(w: Inputs) -> DataFrame:
    """Units and lines per product version in force when each line was ordered."""
    lines = w.src["order_items"].join(w.src["orders"].select("order_id", "order_date"), "order_id")
    versioned = op.as_of_join(
        lines.select("product_id", "order_date", "quantity"), scd2_products(w), "product_id", "order_date"
    )
    return versioned.groupBy("product_id", "start_date", "product_description").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units")
    )


@query("scd2_fact_sales")
def scd2_fact_sales(w: Inputs) -> DataFrame:
    """The sales fact over versioned products: each line has the key of the version it was ordered under."""
    return op.fact_sales(w.src, {**w.star, "dim_products": scd2_products(w)})
