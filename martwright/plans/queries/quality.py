"""Integrity checks over all tables."""

from __future__ import annotations

from collections import ChainMap
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import operators as op
from ...functions.contents import Contents
from ...schemas import (
    SOURCE_FOREIGN_KEYS,
    SOURCE_PRIMARY_KEYS,
    STAR_DDL,
    STAR_FOREIGN_KEYS,
    STAR_LIMITS,
    STAR_NULLABLE,
    STAR_PRIMARY_KEYS,
    column_names,
)
from ...sources import row_counts
from ..star import star_contents
from .registry import Inputs, query


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query("dq_duplicate_keys")
def dq_duplicate_keys(w: Inputs) -> DataFrame:
    return op.duplicate_keys(w.src["order_items"], ["order_id", "item_id"])


@query("dq_primary_keys")
def dq_primary_keys(w: Inputs) -> DataFrame:
    """How many key values repeat, for every table with a primary key."""
    keys = [(w.src, *k) for k in SOURCE_PRIMARY_KEYS.items()] + [(w.star, *k) for k in STAR_PRIMARY_KEYS.items()]
    return _stack(
        [
            op.duplicate_keys(tables[table], pk)
            .agg(F.count(F.lit(1)).alias("repeated_keys"))
            .select(F.lit(table).alias("table_name"), F.lit(", ".join(pk)).alias("key_columns"), "repeated_keys")
            for tables, table, pk in keys
        ]
    )


@query("dq_null_counts")
def dq_null_counts(w: Inputs) -> DataFrame:
    """NULLs per column of the star, and whether its declaration allows them."""

    def checked(table: str) -> DataFrame:
        allowed = F.col("column_name").isin(list(STAR_NULLABLE.get(table, [])))
        return op.null_counts(w.star[table], column_names(STAR_DDL[table])).select(
            F.lit(table).alias("table_name"),
            "column_name",
            "null_count",
            F.when(allowed | (F.col("null_count") == 0), "Y").otherwise("N").alias("valid"),
        )

    return _stack([checked(table) for table in STAR_DDL])


@query("dq_orphan_rows")
def dq_orphan_rows(w: Inputs) -> DataFrame:
    """Orphans per foreign key, and of the orders once European customers are gone."""
    keys = [(w.src, *k) for k in SOURCE_FOREIGN_KEYS] + [(w.star, *k) for k in STAR_FOREIGN_KEYS]
    checks = [
        (f"{child}.{column}", op.orphan_count(tables[child], tables[parent], column, parent_column))
        for tables, child, column, parent, parent_column in keys
    ]
    others = w.src["customers"].where(~F.col("address").endswith(", EUROPE"))
    checks.append(("orders.customer_id outside EUROPE", op.orphan_count(w.src["orders"], others, "customer_id")))
    return _stack(
        [count.withColumn("reference", F.lit(name)) for name, count in checks]
    )


@query("dq_cascade_delete")
def dq_cascade_delete(w: Inputs) -> DataFrame:
    """Sales left per status once all economy products are deleted."""
    gone = w.star["dim_products"].where(F.col("product_category") == "ECONOMY")
    # Lines of a product and status shrink to one row before they meet the products.
    sold = w.star["sales_fact"].groupBy("product_key", "order_status").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("order_total_price").alias("sales")
    )
    left = op.cascade_delete(sold, gone, "product_key")
    return left.groupBy("order_status").agg(
        F.sum("lines").alias("lines"), F.sum("sales").alias("sales"), F.count("product_key").alias("products")
    )


@query("dq_cascade_customers")
def dq_cascade_customers(w: Inputs) -> DataFrame:
    """Rows left per table, from customers down to lines and facts, once European customers are gone."""
    tables = ChainMap(w.star, w.src)
    # A dimension's member goes with the source row it stands for.
    keys = [*SOURCE_FOREIGN_KEYS, *STAR_FOREIGN_KEYS, ("dim_customers", "customer_id", "customers", "customer_id")]
    gone = w.src["customers"].where(F.col("address").endswith(", EUROPE"))
    return row_counts(op.cascade_delete_all(tables, keys, "customers", "customer_id", gone))


# loaded table: (its source, the source's columns that STAR_CONTENTS observes in the loaded table)
LOADED_FROM = {
    "dim_products": ("products", ("product_id",)),
    "dim_customers": ("customers", ("customer_id", "credit_limit")),
    "dim_countries": ("countries", ("country_id",)),
    "dim_warehouses": ("warehouses", ("warehouse_id",)),
    "dim_employees": ("employees", ("employee_id", "hire_date")),
    "sales_fact": ("order_items", ("order_id", "quantity", "unit_price")),
    "inventories_fact": ("inventories", ("quantity",)),
}


@query("dq_reconcile_counts")
def dq_reconcile_counts(w: Inputs) -> DataFrame:
    """Rows of every source against the rows observed while its target was written."""
    w.star  # published by now
    loaded = star_contents(w.spark, w.star_root, list(LOADED_FROM))
    sources = {name: (w.src[source], Contents(columns), loaded[name]) for name, (source, columns) in LOADED_FROM.items()}
    same = F.when(F.col("expected_rows") == F.col("actual_rows"), "Y").otherwise("N")
    return op.reconcile_contents(sources).withColumn("matches", same).drop("same_contents")


@query("dq_reconcile_contents")
def dq_reconcile_contents(w: Inputs) -> DataFrame:
    """Whether targets hold just the rows of their sources, and whether lines were sold at list prices (as many, not the same)."""
    w.star  # published by now
    loaded = star_contents(w.spark, w.star_root, list(LOADED_FROM))
    at_list = w.src["order_items"].join(w.src["products"].select("product_id", "list_price"), "product_id")
    return op.reconcile_contents(
        {name: (w.src[source], Contents(columns), loaded[name]) for name, (source, columns) in LOADED_FROM.items()}
        | {"sales_fact at list prices": (at_list, Contents(("order_id", "quantity", "list_price")), loaded["sales_fact"])}
    )


@query("dq_width_violations")
def dq_width_violations(w: Inputs) -> DataFrame:
    return _stack(
        [
            op.width_violations(w.star[table], limits).withColumn("table_name", F.lit(table))
            for table, limits in STAR_LIMITS.items()
        ]
    )
