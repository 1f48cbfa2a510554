"""The initial build of the star schema and its publication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.contents import Contents
from ..schemas import STAR_DDL
from ..sources.publish import publish, published_contents, read_published, side_by_side, version_of

DIMENSIONS = [name for name in STAR_DDL if name.startswith("dim_")]
#: What is observed of each table while it is written: columns that stand in the source too.
STAR_CONTENTS = {
    "dim_date": Contents(("calendar_date",)),
    "dim_products": Contents(("product_id",)),
    "dim_customers": Contents(("customer_id", "credit_limit")),
    "dim_countries": Contents(("country_id",)),
    "dim_warehouses": Contents(("warehouse_id",)),
    "dim_employees": Contents(("employee_id", "hire_date"), f"employee_key <> {op.UNKNOWN_EMPLOYEE_KEY}"),
    "sales_fact": Contents(("order_id", "item_quantity", "unit_price")),
    "inventories_fact": Contents(("inventory_quantity",)),
}
SALES_PARTITION = ("order_year", "order_month")


def with_order_month(rows: DataFrame) -> DataFrame:
    """Add the columns that sales are partitioned by."""
    return rows.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})


def by_warehouse(inventories: DataFrame) -> DataFrame:
    """Ranges of warehouse and product, so that a report on one warehouse opens the few files that hold it."""
    return inventories.repartitionByRange("warehouse_key", "product_key").sortWithinPartitions("warehouse_key")


def build_dims(
    src: Mapping[str, DataFrame], as_of: dt.date, calendar: tuple[dt.date, dt.date] | None = None
) -> dict[str, DataFrame]:
    """All dimensions; the calendar spans the orders unless a range is given."""
    orders = src["orders"]
    countries = op.dim_countries(src["countries"], src["regions"])
    return {
        "dim_date": op.dim_date(orders.sparkSession, *calendar)
        if calendar
        else op.dim_date_spanning(orders, "order_date"),
        "dim_products": op.dim_products(src["products"], src["product_categories"]),
        "dim_customers": op.dim_customers(src["customers"], src["contacts"], orders, as_of),
        "dim_countries": countries,
        "dim_warehouses": op.dim_warehouses(src["warehouses"], src["locations"], countries),
        "dim_employees": op.with_unknown_employee(op.dim_employees(src["employees"], as_of)),
    }


def build_facts(src: Mapping[str, DataFrame], dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"sales_fact": op.fact_sales(src, dims), "inventories_fact": op.fact_inventories(src, dims)}


def build_star(
    src: Mapping[str, DataFrame], as_of: dt.date, calendar: tuple[dt.date, dt.date] | None = None
) -> dict[str, DataFrame]:
    """The whole star as one lazy plan, nothing written."""
    dims = build_dims(src, as_of, calendar)
    return {**dims, **build_facts(src, dims)}


def publish_star(
    spark: SparkSession,
    root: str,
    src: Mapping[str, DataFrame],
    as_of: dt.date,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """Build and write the star, dimensions first, and return the written tables.

    Facts look their keys up in the written dimensions, so each key is worked
    out once. Sales are partitioned by order year, the filter of most reports, and month.
    """
    dims = build_dims(src, as_of, calendar)
    side_by_side(
        spark, [partial(publish, dims[name], table_root(root, name), contents=STAR_CONTENTS[name]) for name in DIMENSIONS]
    )
    facts = build_facts(src, read_dims(spark, root))
    side_by_side(
        spark,
        [
            partial(publish, rows, table_root(root, name), by, contents=STAR_CONTENTS[name])
            for rows, name, by in [
                (with_order_month(facts["sales_fact"]), "sales_fact", SALES_PARTITION),
                (by_warehouse(facts["inventories_fact"]), "inventories_fact", ()),
            ]
        ],
    )
    return read_star(spark, root)


def table_root(root: str, name: str) -> str:
    return f"{root}/{name}"


def read_dims(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_published(spark, table_root(root, name)) for name in DIMENSIONS}


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_published(spark, table_root(root, name)) for name in STAR_DDL}


def star_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """The version of every table; taken before a star is read, it makes later publications safe against others."""
    return {name: version_of(spark, table_root(root, name)) for name in STAR_DDL}


def star_contents(spark: SparkSession, root: str, names: list[str]) -> dict[str, tuple[int, int]]:
    """Rows and fingerprint of the named tables, as observed while they were written."""
    return {name: published_contents(spark, table_root(root, name), STAR_CONTENTS[name]) for name in names}
