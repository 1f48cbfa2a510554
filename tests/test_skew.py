"""Joins of facts to dimensions when one key holds a third of the rows and nothing fits a broadcast."""

from __future__ import annotations

from collections import ChainMap

import pytest
from pyspark.sql import functions as F

from conftest import day
from martwright import operators as op

ORDERS, LINES = 20_000, 120_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcasts(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(spark, src):
    """A third of the orders of customer 1, a third without salesman, a third of the lines of product 1 and order 7."""
    many = F.pmod(F.xxhash64("id"), F.lit(1000))
    orders = spark.range(ORDERS).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(many + 10).cast("bigint").alias("customer_id"),
        F.lit("Shipped").alias("status"),
        F.when(F.col("id") % 3 != 1, F.col("id") % 40 + 1).alias("salesman_id"),
        F.date_add(F.lit(day("2017-01-01")), (F.col("id") % 300).cast("int")).alias("order_date"),
    )
    items = spark.range(0, LINES, 1, 24).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % ORDERS).cast("bigint").alias("order_id"),
        F.col("id").cast("int").alias("item_id"),
        F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 500 + 1).cast("bigint").alias("product_id"),
        # Scattered numbers, for a constant would compress a hot partition to nothing.
        (F.pmod(F.xxhash64("id"), F.lit(99_999)) + 1).cast("decimal(8,2)").alias("quantity"),
        (F.pmod(F.xxhash64(-F.col("id")), F.lit(99_999)) + 1).cast("decimal(8,2)").alias("unit_price"),
    )
    products = spark.range(1, 501).select(
        F.col("id").alias("product_id"), F.lit(7).cast("decimal(9,2)").alias("standard_cost")
    )
    dims = {
        "dim_date": op.dim_date(spark, day("2017-01-01"), day("2017-12-31")),
        "dim_products": products.select((F.col("product_id") + 1000).alias("product_key"), "product_id"),
        "dim_customers": spark.range(1, 1011).selectExpr("id + 100 as customer_key", "id as customer_id"),
        "dim_employees": spark.range(1, 41).selectExpr("id + 500 as employee_key", "id as employee_id"),
    }
    return ChainMap({"orders": orders, "order_items": items, "products": products}, src), dims


def test_hot_keys_are_split_and_nothing_is_lost(skewed, no_broadcasts):
    fact = op.fact_sales(*skewed)
    rows = fact.collect()
    assert len(rows) == LINES
    lines = skewed[0]["order_items"]
    assert sum(r.order_total_price for r in rows) == lines.agg(F.sum(F.col("quantity") * F.col("unit_price"))).first()[0]
    for r in rows[:: LINES // 500]:
        assert r.employee_key == (9999999 if r.order_id % 3 == 1 else r.order_id % 40 + 501)
        assert r.customer_key == 101 or r.order_id % 3
    plan = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("SortMergeJoin(skew=true) [product_id") == 2, "both product lookups"
    assert plan.count("SortMergeJoin(skew=true) [customer_id") == 1
    assert plan.count("SortMergeJoin(skew=true) [order_id") == 1
    assert "BroadcastHashJoin" not in plan


def test_hot_products_are_split_among_versions_too(skewed, no_broadcasts):
    src, dims = skewed
    first = op.scd2_init(dims["dim_products"], "products_active_flag", day("2017-01-01"))
    changes = first.where("product_id <= 3").select("product_id", F.lit(day("2017-05-01")).alias("start_date"))
    versions, _ = op.scd2_apply(first, changes, "product_id", "product_key", "products_active_flag", 1001)
    fact = op.fact_sales(src, {**dims, "dim_products": versions})
    rows = fact.collect()
    assert len(rows) == LINES
    hot = {(r.product_key, r.order_date < day("2017-05-01")) for r in rows if r.product_key in (1001, 1501)}
    assert hot == {(1001, True), (1501, False)}
    plan = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("SortMergeJoin(skew=true) [product_id") == 2, "cost and version"


def test_orders_without_salesman_are_spread(skewed, no_broadcasts):
    text = op.fact_sales(*skewed)._jdf.queryExecution().executedPlan().toString()
    (join,) = [line for line in text.splitlines() if "LeftOuter" in line]
    assert "_residue" in join.split("]")[0], "the second join column must survive optimisation"
