"""The twelve reports and their subtotals on the published star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import subtotal
from ...sources.tpch import CATEGORY, COMPARE_YEAR, REPORT_YEAR, WAREHOUSE
from .. import reports as r
from .registry import Inputs, query


@query("rpt_monthly_growth")
def rpt_monthly_growth(w: Inputs) -> DataFrame:
    return r.monthly_growth(w.star, REPORT_YEAR, CATEGORY)


@query("rpt_monthly_growth_as_written")
def rpt_monthly_growth_as_written(w: Inputs) -> DataFrame:
    return r.monthly_growth_as_written(w.star, REPORT_YEAR, CATEGORY)


@query("rpt_employee_quarterly")
def rpt_employee_quarterly(w: Inputs) -> DataFrame:
    return r.employee_quarterly(w.star, REPORT_YEAR)


@query("rpt_low_margin")
def rpt_low_margin(w: Inputs) -> DataFrame:
    return r.low_margin(w.star)


@query("rpt_inventory_status")
def rpt_inventory_status(w: Inputs) -> DataFrame:
    return r.inventory_status(w.star, WAREHOUSE)


@query("rpt_geo_monthly")
def rpt_geo_monthly(w: Inputs) -> DataFrame:
    return r.geo_monthly(w.star, REPORT_YEAR)


@query("rpt_geo_monthly_yoy")
def rpt_geo_monthly_yoy(w: Inputs) -> DataFrame:
    return r.geo_monthly_yoy(w.star, REPORT_YEAR)


@query("rpt_annual_category")
def rpt_annual_category(w: Inputs) -> DataFrame:
    return r.annual_category(w.star, REPORT_YEAR)


@query("rpt_cltv_top10")
def rpt_cltv_top10(w: Inputs) -> DataFrame:
    return r.cltv_top10(w.star, REPORT_YEAR)


@query("rpt_retention")
def rpt_retention(w: Inputs) -> DataFrame:
    return r.retention(w.star, REPORT_YEAR)


@query("rpt_employee_performance")
def rpt_employee_performance(w: Inputs) -> DataFrame:
    return r.employee_performance(w.star)


@query("rpt_top_products")
def rpt_top_products(w: Inputs) -> DataFrame:
    return r.top_products(w.star, REPORT_YEAR)


@query("rpt_market_trend")
def rpt_market_trend(w: Inputs) -> DataFrame:
    return r.market_trend(w.star, REPORT_YEAR, COMPARE_YEAR)


@query("rpt_product_quarterly")
def rpt_product_quarterly(w: Inputs) -> DataFrame:
    return r.product_quarterly(w.star, REPORT_YEAR)


@query("rpt_product_quarterly_all")
def rpt_product_quarterly_all(w: Inputs) -> DataFrame:
    return r.product_quarterly_all(w.star, REPORT_YEAR)


@query("sub_monthly_growth")
def sub_monthly_growth(w: Inputs) -> DataFrame:
    return subtotal(rpt_monthly_growth(w), {"sum": ["sales_amount"], "avg": ["sales_amount"]})


@query("sub_employee_quarterly")
def sub_employee_quarterly(w: Inputs) -> DataFrame:
    columns = ["quarter1", "quarter2", "quarter3", "quarter4", "sales_quantity", "sales_amount"]
    return subtotal(rpt_employee_quarterly(w), {"sum": columns})


@query("sub_low_margin")
def sub_low_margin(w: Inputs) -> DataFrame:
    return subtotal(rpt_low_margin(w), {"sum": ["standard_cost", "sales_unit", "sales_revenue", "gross_profit"]})


@query("sub_geo_monthly")
def sub_geo_monthly(w: Inputs) -> DataFrame:
    return subtotal(rpt_geo_monthly(w), {"sum": ["revenue", "prev_year_revenue"]}, ["customer_geography"])


@query("sub_annual_category")
def sub_annual_category(w: Inputs) -> DataFrame:
    columns = ["num_orders", "total_sales", "total_profit", "avg_sales_amount"]
    return subtotal(rpt_annual_category(w), {"sum": columns}, ["product_category"])


@query("sub_cltv")
def sub_cltv(w: Inputs) -> DataFrame:
    return subtotal(rpt_cltv_top10(w), {"sum": ["avg_purchase_value_per_year"]})


@query("sub_retention")
def sub_retention(w: Inputs) -> DataFrame:
    averages = subtotal(rpt_retention(w), {"avg": ["retention_rate", "cac"]}, ["customer_geography"])
    # Doubles add up in any order; six places are the same in every order.
    return averages.withColumns({c: F.round(c, 6) for c in ("average_retention_rate", "average_cac")})


@query("sub_employee_performance")
def sub_employee_performance(w: Inputs) -> DataFrame:
    return subtotal(rpt_employee_performance(w), {"sum": ["order_quantity", "sales_amount"]})


@query("sub_top_products")
def sub_top_products(w: Inputs) -> DataFrame:
    return subtotal(rpt_top_products(w), {"sum": ["standard_cost", "sales_unit", "sales_amount", "sales_profit"]})


@query("sub_market_trend")
def sub_market_trend(w: Inputs) -> DataFrame:
    return subtotal(rpt_market_trend(w), {"sum": ["initial_sales", "comparison_sales"]})


@query("sub_product_quarterly")
def sub_product_quarterly(w: Inputs) -> DataFrame:
    columns = ["quarter1", "quarter2", "quarter3", "quarter4", "quantity", "total_profit", "total_revenue"]
    return subtotal(rpt_product_quarterly(w), {"sum": columns})
