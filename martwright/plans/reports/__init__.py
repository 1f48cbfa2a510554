"""The twelve business reports, and their registration as SQL views."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ...sources.tables import register_views
from .customers import cltv_top10, geo_monthly, geo_monthly_yoy, retention
from .employees import employee_performance, employee_quarterly
from .inventory import inventory_status
from .products import low_margin, product_quarterly, product_quarterly_all, top_products
from .trends import annual_category, market_trend, monthly_growth, monthly_growth_as_written

__all__ = [
    "annual_category",
    "cltv_top10",
    "employee_performance",
    "employee_quarterly",
    "geo_monthly",
    "geo_monthly_yoy",
    "inventory_status",
    "low_margin",
    "market_trend",
    "monthly_growth",
    "monthly_growth_as_written",
    "product_quarterly",
    "product_quarterly_all",
    "register_reports",
    "retention",
    "top_products",
]


def register_reports(
    star: Mapping[str, DataFrame], year: int, compare_year: int, category: str, warehouse_id: int, prefix: str = ""
) -> None:
    """Make every report a temporary view, planned afresh by each statement that reads it."""
    register_views(
        {
            "monthly_growth": monthly_growth(star, year, category),
            "employee_quarterly": employee_quarterly(star, year),
            "low_margin": low_margin(star),
            "inventory_status": inventory_status(star, warehouse_id),
            "geo_monthly": geo_monthly(star, year),
            "annual_category": annual_category(star, year),
            "cltv_top10": cltv_top10(star, year),
            "retention": retention(star, year),
            "employee_performance": employee_performance(star),
            "top_products": top_products(star, year),
            "market_trend": market_trend(star, year, compare_year),
            "product_quarterly": product_quarterly(star, year),
        },
        prefix,
    )
