"""Stock levels of one warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stock status, emptiest first, each with the quantity it stays below, and the reorder level.
OUT_OF_STOCK = "Out of Stock"
LOW_STOCK, LOW_BELOW = "Low Stock", 10
MEDIUM_STOCK, MEDIUM_BELOW = "Medium Stock", 50
HIGH_STOCK = "High Stock"
REORDER_NEEDED, SUFFICIENT_STOCK, REORDER_BELOW = "Reorder Needed", "Sufficient Stock", 20

def inventory_status(star: dict[str, DataFrame], warehouse_id: int) -> DataFrame:
    """Quantity, status and reorder flag per product, emptiest first.

    The warehouse's key is a scalar subquery on its unique id, so the inventory
    scan filters by it and no other warehouse's rows are shuffled.
    """
    warehouse = star["dim_warehouses"].where(F.col("warehouse_id") == warehouse_id)
    place = warehouse.join(star["dim_countries"], "country_key").select(
        "warehouse_key",
        F.concat(F.lit("["), F.col("country_id"), F.lit("] "), F.col("country_name")).alias("country_name"),
        "warehouse_id",
        "warehouse_name",
    )
    stock = (
        star["inventories_fact"]
        .where(F.col("warehouse_key") == warehouse.select("warehouse_key").scalar())
        .groupBy("warehouse_key", "product_key")
        .agg(F.sum("inventory_quantity").alias("quantity"))
    )
    quantity = F.col("total_inventory_quantity")
    labels = ["country_name", "warehouse_id", "warehouse_name", "product_id", "product_name", "product_category"]
    status = (
        F.when(quantity <= 0, OUT_OF_STOCK)
        .when(quantity < LOW_BELOW, LOW_STOCK)
        .when(quantity < MEDIUM_BELOW, MEDIUM_STOCK)
        .otherwise(HIGH_STOCK)
    )
    emptiest_first = F.array_position(
        F.array(*map(F.lit, (OUT_OF_STOCK, LOW_STOCK, MEDIUM_STOCK, HIGH_STOCK))), F.col("inventory_status")
    )
    return (
        stock.join(
            star["dim_products"].select("product_key", "product_id", "product_name", "product_category"), "product_key"
        )
        .join(place, "warehouse_key")
        .groupBy(*labels)
        .agg(F.sum("quantity").alias("total_inventory_quantity"))
        .withColumn("inventory_status", status)
        .withColumn("reorder_level", F.when(quantity < REORDER_BELOW, REORDER_NEEDED).otherwise(SUFFICIENT_STOCK))
        .orderBy(emptiest_first, "product_id")
    )
