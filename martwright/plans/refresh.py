"""The later loads: new members, changed members, new sales."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import partial, reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..operators import dims as d
from ..operators import scd
from ..sources.publish import publish, publish_delta, publish_parts, read_newest, side_by_side, version_of
from .star import (
    SALES_PARTITION,
    STAR_CONTENTS,
    by_warehouse,
    read_dims,
    read_star,
    star_versions,
    table_root,
    with_order_month,
)

# dimension: (natural key, surrogate key, active flag, first key, default start, reserved key)
VERSIONED = {
    "dim_products": ("product_id", "product_key", "products_active_flag", d.PRODUCT_START, scd.FIRST_START, None),
    "dim_customers": ("customer_id", "customer_key", "customer_active_flag", d.CUSTOMER_START, scd.FIRST_START, None),
    "dim_employees": (
        "employee_id",
        "employee_key",
        "employee_active_flag",
        d.EMPLOYEE_START,
        scd.FIRST_START_EMPLOYEES,
        d.UNKNOWN_EMPLOYEE_KEY,
    ),
}


def current_products(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Products with one row per id, whether versioned yet or not."""
    products, flag = dims["dim_products"], VERSIONED["dim_products"][2]
    return scd.current(products, flag) if flag in products.columns else products


def _as_stored(name: str, dim: DataFrame, new: DataFrame) -> DataFrame:
    """New members with the columns of the stored dimension: a versioned one gives them first versions."""
    if name in VERSIONED:
        _, _, flag, _, start, _ = VERSIONED[name]
        if flag in dim.columns:
            return scd.scd2_init(new, flag, start)
    return new


def _changed(name: str, dim: DataFrame, changes: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    natural, surrogate, flag, first_key, start, reserved = VERSIONED[name]
    versions = dim if flag in dim.columns else scd.scd2_init(dim, flag, start)
    recompute = None
    if name == "dim_employees":
        recompute = {"no_of_days_employed": F.datediff(F.lit(as_of), "hire_date").cast("bigint")}
    return scd.scd2_apply(versions, changes, natural, surrogate, flag, first_key, reserved, recompute)


def refresh_star(
    spark: SparkSession,
    root: str,
    src: Mapping[str, DataFrame],
    as_of: dt.date,
    calendar: tuple[dt.date, dt.date],
    holidays: DataFrame | None = None,
    changes: Mapping[str, DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Bring a published star up to date with the source as it is now.

    New days, members, sales (above the high-water mark) and inventory pairs are
    published as deltas, so neither large dimensions nor facts are rewritten. Only
    a dimension with holidays or type 2 ``changes`` (by dimension name) is published
    anew. Each step leaves a consistent star and adds nothing when repeated, so a
    refresh that broke off is simply run again. So is one that overlapped with another and raised
    ``PublicationClash``: a table is only published if it is still at the version it
    was read at, so that no member and no sale gets in twice. Returns the star and the rejects:
    changes per dimension, holidays outside the calendar under ``dim_date``, and new order
    lines without a day, customer or product under ``sales_fact``.
    """
    versions = star_versions(spark, root)
    star, rejects = read_star(spark, root), {}
    new_countries = op.refresh_countries(star["dim_countries"], src)
    countries = star["dim_countries"].unionByName(new_countries)
    new = {
        "dim_date": op.refresh_dates(star["dim_date"], *calendar),
        "dim_products": op.refresh_products(star["dim_products"], src),
        "dim_customers": op.refresh_customers(star["dim_customers"], src, as_of),
        "dim_countries": new_countries,
        "dim_warehouses": op.refresh_warehouses(star["dim_warehouses"], src, countries),
        "dim_employees": op.refresh_employees(star["dim_employees"], src, as_of),
    }
    deltas = [
        partial(
            publish_delta,
            _as_stored(name, star[name], rows),
            table_root(root, name),
            base=versions[name],
            contents=STAR_CONTENTS[name],
        )
        for name, rows in new.items()
    ]
    versions.update(zip(new, side_by_side(spark, deltas)))

    dims = read_dims(spark, root)
    rewritten = {}
    if holidays is not None:
        rewritten["dim_date"], rejects["dim_date"] = op.mark_holidays(dims["dim_date"], holidays)
    for name, rows in (changes or {}).items():
        rewritten[name], rejects[name] = _changed(name, dims[name], rows, as_of)
    if rewritten:
        whole = [
            partial(publish, frame, table_root(root, name), base=versions[name], contents=STAR_CONTENTS[name])
            for name, frame in rewritten.items()
        ]
        side_by_side(spark, whole)
        dims = read_dims(spark, root)

    newest = read_newest(spark, table_root(root, "sales_fact"))  # the mark needs no other month
    sales = op.refresh_sales(newest, src, dims)
    rejects["sales_fact"] = op.refresh_sales_rejects(newest, src, dims)
    now = {**dims, "dim_products": current_products(dims)}
    stock = op.refresh_inventories(star["inventories_fact"], src, now, dims["dim_products"])
    facts = [
        (with_order_month(sales), "sales_fact", SALES_PARTITION),
        (by_warehouse(stock), "inventories_fact", ()),
    ]
    side_by_side(
        spark,
        [
            partial(publish_delta, rows, table_root(root, name), by, versions[name], STAR_CONTENTS[name])
            for rows, name, by in facts
        ],
    )
    return read_star(spark, root), rejects


def correct_sales(
    spark: SparkSession,
    root: str,
    orders: DataFrame,
    src: Mapping[str, DataFrame],
    before: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Rebuild the lines of corrected orders, also below the high-water mark.

    They get the members in force on their new dates. Only the months such lines
    were in, or are in now, are read and written anew. Which they were in is told by ``before``, these
    orders (``order_date``) as they were loaded; without it, by the ids and partitions of the
    fact, no other column of which is scanned for it.
    """
    base = version_of(spark, table_root(root, "sales_fact"))
    star = read_star(spark, root)
    rebuilt = with_order_month(op.fact_sales_of(orders, src, star))
    if before is None:
        was = star["sales_fact"].join(orders.select("order_id"), "order_id", "left_semi")
    else:
        was = with_order_month(before)
    now = with_order_month(orders)
    touched = was.select(*SALES_PARTITION).unionByName(now.select(*SALES_PARTITION)).distinct()
    months = [tuple(row) for row in touched.where(F.col("order_year").isNotNull()).collect()]
    if months:
        held = reduce(or_, [(F.col("order_year") == y) & (F.col("order_month") == m) for y, m in sorted(months)])
        sales = op.upsert_facts(star["sales_fact"].where(held), rebuilt, ["order_id"], orders)
        publish_parts(sales, table_root(root, "sales_fact"), SALES_PARTITION, months, base, STAR_CONTENTS["sales_fact"])
    return read_star(spark, root)
