"""Incremental refresh against a warehouse that lacks part of the source.

Products of the PROMO line, Europe's customers, countries and warehouses, and one
sales team count as new; sales from 2001 on are new.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import ChainMap
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import operators as op
from ...session import shared_folder
from ...sources import tpch
from ...streaming.products import read_dimension, start_dimension, stream_products
from ..refresh import correct_sales, refresh_star
from ..star import SALES_PARTITION, publish_star
from .registry import Inputs, query

NEW_CATEGORY, NEW_REGION, NEW_TEAM = "PROMO", "EUROPE", "SALES 4"
CALENDAR_START, CALENDAR_END = dt.date(2000, 7, 1), dt.date(2001, 12, 31)


def _old_countries(w: Inputs) -> DataFrame:
    return w.star["dim_countries"].where(F.col("region_name") != NEW_REGION)


def _old_products(w: Inputs) -> DataFrame:
    return w.star["dim_products"].where(F.col("product_category") != NEW_CATEGORY)


def _old_warehouses(w: Inputs) -> DataFrame:
    return w.star["dim_warehouses"].join(_old_countries(w).select("country_key"), "country_key", "left_semi")


@query("inc_date")
def inc_date(w: Inputs) -> DataFrame:
    old = w.star["dim_date"].where(F.col("calendar_date") < F.lit(tpch.SPLIT_DATE))
    return op.refresh_dates(old, CALENDAR_START, CALENDAR_END)


@query("inc_products")
def inc_products(w: Inputs) -> DataFrame:
    return op.refresh_products(_old_products(w), w.src)


@query("inc_customers")
def inc_customers(w: Inputs) -> DataFrame:
    old = w.star["dim_customers"].where(F.col("customer_geography") != f" {NEW_REGION}")
    return op.refresh_customers(old, w.src, tpch.AS_OF)


@query("inc_countries")
def inc_countries(w: Inputs) -> DataFrame:
    return op.refresh_countries(_old_countries(w), w.src)


@query("inc_warehouses")
def inc_warehouses(w: Inputs) -> DataFrame:
    return op.refresh_warehouses(_old_warehouses(w), w.src, w.star["dim_countries"])


@query("inc_employees")
def inc_employees(w: Inputs) -> DataFrame:
    old = w.star["dim_employees"].where(F.col("job_title") != NEW_TEAM)
    return op.refresh_employees(old, w.src, tpch.AS_OF)


@query("inc_sales")
def inc_sales(w: Inputs) -> DataFrame:
    old = w.star["sales_fact"].where(F.col("order_year") < tpch.SPLIT_DATE.year)
    return op.refresh_sales(old, w.src, w.star)


@query("inc_inventories")
def inc_inventories(w: Inputs) -> DataFrame:
    old = w.star["inventories_fact"].join(_old_warehouses(w).select("warehouse_key"), "warehouse_key", "left_semi")
    return op.refresh_inventories(old, w.src, w.star)


@query("inc_sales_upsert")
def inc_sales_upsert(w: Inputs) -> DataFrame:
    """Orders still pending in 2000 turn out shipped a fortnight later; their lines are replaced."""
    pending = w.src["orders"].where((F.col("status") == "Pending") & (F.year("order_date") == 2000))
    corrected = pending.withColumns({"status": F.lit("Shipped"), "order_date": F.date_add("order_date", 14)})
    rebuilt = op.fact_sales_of(corrected, w.src, w.star)
    return op.upsert_facts(w.star["sales_fact"].drop(*SALES_PARTITION), rebuilt, ["order_id"], corrected)


@query("inc_products_stream")
def inc_products_stream(w: Inputs) -> DataFrame:
    """The PROMO products arrive as a stream of part files."""
    folder = f"{shared_folder(w.spark)}/martwright/stream-{uuid.uuid4().hex}"
    start_dimension(_old_products(w), f"{folder}/dim_products")
    stream = stream_products(
        w.spark,
        f"{w.folder}/part.parquet*",
        f"{folder}/checkpoint",
        f"{folder}/dim_products",
        w.src["product_categories"],
        tpch.part_schema(w.spark, w.folder),
        tpch.products_from_part,
    )
    stream.awaitTermination()  # however long it takes; what it failed of is raised
    if stream.lastProgress is None:  # Spark raises nothing for a stream that was stopped
        raise RuntimeError("the stream was stopped before its products were in the dimension")
    return read_dimension(w.spark, f"{folder}/dim_products").drop("batch")


@query("inc_refresh_all")
def inc_refresh_all(w: Inputs) -> DataFrame:
    """Both loads through the published path: the star of the old source, then the whole source, and that once more.

    Per table the rows and a sum after the second load, and how many rows repeating it has added.
    """
    root = f"{shared_folder(w.spark)}/martwright/refresh-{uuid.uuid4().hex}"
    old_orders = w.src["orders"].where(F.col("order_date") < F.lit(tpch.SPLIT_DATE))
    categories = w.src["product_categories"].where(F.upper("category_name") != NEW_CATEGORY)
    products = w.src["products"].join(categories.select("category_id"), "category_id", "left_semi")
    old = {
        "orders": old_orders,
        "order_items": op.lines_of(w.src, old_orders).join(products.select("product_id"), "product_id", "left_semi"),
        "products": products,
        "inventories": w.src["inventories"].join(products.select("product_id"), "product_id", "left_semi"),
    }
    days = op.dim_date_spanning(w.src["orders"], "order_date").agg(F.min("calendar_date"), F.max("calendar_date")).first()
    publish_star(w.spark, root, ChainMap(old, w.src), tpch.AS_OF)
    once, _ = refresh_star(w.spark, root, w.src, tpch.AS_OF, tuple(days))
    # Lines of new products in old orders lie below the mark: they come as corrections of their orders.
    late = w.src["order_items"].join(products.select("product_id"), "product_id", "left_anti").select("order_id")
    found = old_orders.join(late.distinct(), "order_id", "left_semi")
    found.write.parquet(f"{root}/corrected")  # read several times below
    corrected = w.spark.read.schema(found.schema).parquet(f"{root}/corrected")
    once = correct_sales(w.spark, root, corrected, w.src, before=corrected)
    twice, _ = refresh_star(w.spark, root, w.src, tpch.AS_OF, tuple(days))
    sums = {"sales_fact": "order_total_price", "inventories_fact": "inventory_quantity"}

    def counted(name: str) -> DataFrame:
        amount = F.sum(sums[name]).cast("double") if name in sums else F.lit(None).cast("double")
        before = once[name].agg(F.count(F.lit(1))).scalar()
        return twice[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            amount.alias("amount"),
            (F.count(F.lit(1)) - before).alias("added_again"),
        )

    return reduce(DataFrame.unionByName, [counted(name) for name in twice])
