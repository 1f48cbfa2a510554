"""Incremental refresh: every function returns the new rows only.

New members are found by anti-joins on natural keys (NULL-free, so no
null-aware join is needed) and get keys behind the highest one in use; running
a refresh twice adds nothing the second time.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..schemas import conform, star_schema
from . import dims as d
from .facts import fact_inventories, fact_sales_of, lines_of, sales_rejects
from .keys import highest_key, with_surrogate_key


def _unseen(rows: DataFrame, current: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(current.select(*on), on, "left_anti")


def _keyed(rows: DataFrame, current: DataFrame, natural_key: str, name: str, start: int, reserved: int | None = None) -> DataFrame:
    after = highest_key(current, name, reserved)
    return with_surrogate_key(rows, [natural_key], name, start, after=after, reserved=reserved)


def refresh_dates(current: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar days of the range that ``current`` lacks."""
    days = d.calendar_days(current.sparkSession, start, end)
    fresh = _unseen(days, current, ["calendar_date"])
    rows = _keyed(fresh, current, "calendar_date", "date_key", d.DATE_START)
    return conform(rows.withColumns(calendar_columns(F.col("calendar_date"))), star_schema("dim_date"))


def refresh_products(current: DataFrame, src: Mapping[str, DataFrame]) -> DataFrame:
    fresh = _unseen(src["products"], current, ["product_id"])
    rows = d.dim_products_rows(fresh, src["product_categories"])
    return _keyed(rows, current, "product_id", "product_key", d.PRODUCT_START)


def refresh_customers(current: DataFrame, src: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """New customers; their activity cut-off is one year before ``as_of``."""
    fresh = _unseen(src["customers"], current, ["customer_id"])
    keyed = _keyed(fresh, current, "customer_id", "customer_key", d.CUSTOMER_START)
    return d.dim_customers_rows(keyed, src["contacts"], src["orders"], as_of, carry=("customer_key",))


def refresh_countries(current: DataFrame, src: Mapping[str, DataFrame]) -> DataFrame:
    rows = d.dim_countries_rows(src["countries"], src["regions"])
    fresh = _unseen(rows, current, ["country_id"])
    return _keyed(fresh, current, "country_id", "country_key", d.COUNTRY_START)


def refresh_warehouses(current: DataFrame, src: Mapping[str, DataFrame], countries_dim: DataFrame) -> DataFrame:
    fresh = _unseen(src["warehouses"], current, ["warehouse_id"])
    rows = d.dim_warehouses_rows(fresh, src["locations"], countries_dim)
    return _keyed(rows, current, "warehouse_id", "warehouse_key", d.WAREHOUSE_START)


def refresh_employees(current: DataFrame, src: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """New employees; the unknown member neither hides a real id nor moves the key sequence."""
    known = current.where(F.col("employee_key") != d.UNKNOWN_EMPLOYEE_KEY)
    rows = d.dim_employees_rows(_unseen(src["employees"], known, ["employee_id"]), as_of)
    return _keyed(rows, current, "employee_id", "employee_key", d.EMPLOYEE_START, reserved=d.UNKNOWN_EMPLOYEE_KEY)


def newest_month(sales: DataFrame) -> DataFrame:
    """The rows of the newest year and month, where ``sales`` are partitioned by them.

    Both are scalar subqueries over partition columns, so only that partition's data is read.
    """
    for column in ("order_year", "order_month"):
        if column in sales.columns:
            sales = sales.where(F.col(column) == sales.agg(F.max(column)).scalar())
    return sales


def _newer_orders(current: DataFrame, src: Mapping[str, DataFrame]) -> DataFrame:
    """Orders after the newest order date on record.

    The mark is a scalar subquery, so it reaches the scan of the orders and old
    orders never take part in a join.
    """
    current = newest_month(current)
    earliest = F.make_date(F.lit(1), F.lit(1), F.lit(1))
    mark = current.agg(F.coalesce(F.max("order_date"), earliest)).scalar()
    return src["orders"].where(F.col("order_date") > mark)


def refresh_sales(current: DataFrame, src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Lines of orders after the newest order date on record."""
    return fact_sales_of(_newer_orders(current, src), src, dims)


def refresh_sales_rejects(current: DataFrame, src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Lines of those orders that find no member; the mark moves past them, so they are to be mended and corrected."""
    newer = _newer_orders(current, src)
    lines = lines_of(src, newer)
    return sales_rejects(ChainMap({"orders": newer, "order_items": lines}, src), dims)


def refresh_inventories(
    current: DataFrame,
    src: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    product_versions: DataFrame | None = None,
) -> DataFrame:
    """Rows for pairs of product and warehouse not on record yet.

    Pairs are compared by natural ids, before any lookup, so only new pairs are
    built; with ``product_versions`` (all versions of the products) a product
    that got a new key by a type 2 change does not look new.
    """
    products = dims["dim_products"] if product_versions is None else product_versions
    seen = (
        current.select("product_key", "warehouse_key")
        .join(products.select("product_key", "product_id"), "product_key")
        .join(dims["dim_warehouses"].select("warehouse_key", "warehouse_id"), "warehouse_key")
    )
    fresh = _unseen(src["inventories"], seen, ["product_id", "warehouse_id"])
    return fact_inventories(ChainMap({"inventories": fresh}, src), dims)


def upsert_facts(
    fact: DataFrame, rebuilt: DataFrame, on: list[str], replaced: DataFrame | None = None
) -> DataFrame:
    """Replace all rows sharing a key with ``rebuilt``; catches corrections below the mark.

    ``replaced`` names the keys to replace where they are known without building
    the new rows (the corrected orders): rows of an order left without lines go too,
    and ``rebuilt`` is worked out once instead of twice.
    """
    keys = (rebuilt if replaced is None else replaced).select(*on)
    kept = fact.join(keys, on, "left_anti")
    return kept.select(fact.columns).unionByName(rebuilt.select(fact.columns))
