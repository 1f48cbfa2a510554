"""The two fact tables.

Order lines are by far the largest input, so everything that depends on the
order alone (day, customer, salesman) is looked up on the orders first: a line
is shuffled at most twice, once by product and once by order. Both product
lookups meet the lines one after the other on the same partitioning. They are
not joined with each other first, because adaptive execution splits a hot key
only where both sides of a join come straight from a shuffle.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import line_total
from ..schemas import conform, star_schema
from .dims import UNKNOWN_EMPLOYEE_KEY
from .scd import in_force_from

# So many that NULLs fill any cluster; more cost nothing.
_RESIDUES = 1 << 16


def is_versioned(dim: DataFrame) -> bool:
    return "start_date" in dim.columns


def look_up(rows: DataFrame, column: str, dim: DataFrame, natural: str, surrogate: str, optional: bool = False) -> DataFrame:
    """Add the surrogate key of the member that ``column`` names.

    In a versioned dimension it is the key of the version in force on the row's
    ``order_date``; days before the first version belong to it. An ``optional``
    reference may be NULL.

    Both cases join on a second column, a residue of the reference. Where that is
    NULL the order stands in, so that many NULLs do not meet in one task. And
    versions, which come partitioned by id from a window, get a shuffle of their own
    by it, without which a hot id could not be split (see above).
    """
    versioned = is_versioned(dim)
    keys = dim.select(F.col(natural).alias("_id"), surrogate)
    match = F.col(column) == F.col("_id")
    if versioned:
        keys = dim.select(
            F.col(natural).alias("_id"), surrogate, in_force_from(natural).alias("_from"), F.col("end_date").alias("_until")
        )
        match &= F.col("order_date").between(F.col("_from"), F.col("_until"))
    if optional or versioned:
        stand_in = F.coalesce(column, F.xxhash64("order_id")) if optional else F.col(column)
        rows = rows.withColumn("_residue", F.pmod(stand_in, F.lit(_RESIDUES)))
        keys = keys.withColumn("_id_residue", F.pmod("_id", F.lit(_RESIDUES)))
        match &= F.col("_residue") == F.col("_id_residue")
    found = rows.join(keys, match, "left" if optional else "inner")
    return found.drop("_id", "_from", "_until", "_residue", "_id_residue")


def _keyed_orders(orders: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Orders with their date, customer and employee keys."""
    days = dims["dim_date"].select("date_key", F.col("calendar_date").alias("order_date"))
    dated = orders.withColumn("order_status", F.upper("status")).join(days, "order_date")
    known = look_up(dated, "customer_id", dims["dim_customers"], "customer_id", "customer_key")
    # The unknown member carries an id that a real employee may have too; no order names it.
    people = dims["dim_employees"].where(F.col("employee_key") != UNKNOWN_EMPLOYEE_KEY)
    sold = look_up(known, "salesman_id", people, "employee_id", "employee_key", optional=True)
    return sold.select("order_id", "order_status", "order_date", "date_key", "customer_key", "employee_key")


def fact_sales(src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], unknown_employee: bool = True) -> DataFrame:
    """One row per order line, with the keys of the members in force on the order date."""
    orders = _keyed_orders(src["orders"], dims)
    costs = src["products"].select("product_id", "standard_cost")
    priced = src["order_items"].join(costs, "product_id")
    products = dims["dim_products"]
    if is_versioned(products):
        # Which version applies depends on the order date, so the order comes first.
        rows = look_up(priced.join(orders, "order_id"), "product_id", products, "product_id", "product_key")
    else:
        rows = look_up(priced, "product_id", products, "product_id", "product_key").join(orders, "order_id")
    margin = F.col("unit_price") - F.col("standard_cost")
    employee = F.col("employee_key")
    if unknown_employee:
        employee = F.coalesce(employee, F.lit(UNKNOWN_EMPLOYEE_KEY))
    filled = rows.withColumn("employee_key", employee).withColumns(
        {
            "item_quantity": F.col("quantity"),
            "unit_profit": margin,
            "order_total_price": line_total(F.col("quantity"), F.col("unit_price")),
            "gross_profit": line_total(F.col("quantity"), margin),
        }
    )
    return conform(filled, star_schema("sales_fact"))


def sales_rejects(src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Order lines that ``fact_sales`` cannot place, with every reason: order_id, item_id, reject_reason.

    The reasons that depend on the order alone are found on the orders, so only lines of such orders and lines
    of unknown products are joined.
    """

    def without(rows: DataFrame, column: str, known: DataFrame, natural: str) -> DataFrame:
        ids = known.select(F.col(natural).alias(column)).distinct()
        return rows.join(ids, column, "left_anti")

    def because(rows: DataFrame, column: str, what: str) -> DataFrame:
        value = F.coalesce(F.col(column).cast("string"), F.lit("(none)"))
        return rows.select("order_id", F.concat(F.lit(f"{what} "), value, F.lit(" has no member")).alias("reject_reason"))

    orders, lines = src["orders"], src["order_items"]
    bad_orders = because(without(orders, "order_date", dims["dim_date"], "calendar_date"), "order_date", "date").unionByName(
        because(without(orders, "customer_id", dims["dim_customers"], "customer_id"), "customer_id", "customer")
    )
    ids = lines.select("order_id", "item_id", "product_id")
    known = src["products"].select("product_id").join(dims["dim_products"].select("product_id"), "product_id", "left_semi")
    value = F.coalesce(F.col("product_id").cast("string"), F.lit("(none)"))
    bad_lines = without(ids, "product_id", known, "product_id").withColumn(
        "reject_reason", F.concat(F.lit("product "), value, F.lit(" has no member"))
    )
    lost = ids.join(orders.select("order_id"), "order_id", "left_anti").withColumn(
        "reject_reason", F.lit("the order does not exist")
    )
    parts = [ids.join(bad_orders, "order_id"), bad_lines, lost]
    return reduce(DataFrame.unionByName, [p.select("order_id", "item_id", "reject_reason") for p in parts])


def lines_of(src: Mapping[str, DataFrame], orders: DataFrame) -> DataFrame:
    """The lines of the given orders.

    A source whose lines are themselves worked out from other tables cuts those, with a ``lines_of`` of
    its own: the optimiser does not move a semi-join below the joins that make the lines.
    """
    if hasattr(src, "lines_of"):
        return src.lines_of(orders)
    return src["order_items"].join(orders.select("order_id"), "order_id", "left_semi")


def fact_sales_of(orders: DataFrame, src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """The fact rows of a small part of the orders.

    Lines are cut down to these orders before anything else is looked up, so the
    bulk of the line table is read but neither joined nor shuffled any further.
    """
    lines = lines_of(src, orders)
    return fact_sales(ChainMap({"orders": orders, "order_items": lines}, src), dims)


def fact_inventories(src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per product and warehouse in stock. ``dims`` must hold one version per product."""
    rows = (
        src["inventories"]
        .withColumnRenamed("quantity", "inventory_quantity")
        .join(src["products"].select("product_id", "standard_cost", "list_price"), "product_id")
        .join(dims["dim_products"].select("product_key", "product_id"), "product_id")
        .join(src["warehouses"].select("warehouse_id"), "warehouse_id")
        .join(dims["dim_warehouses"].select("warehouse_key", "warehouse_id"), "warehouse_id")
    )
    return conform(rows, star_schema("inventories_fact"))
