"""What must not grow with the input: broadcasts, rows that meet a small table, tasks that count keys."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from conftest import plan_text
from martwright import operators as op
from martwright.plans.queries.quality import dq_cascade_delete
from martwright.plans.queries.refresh import inc_refresh_all
from martwright.plans.queries.registry import inputs_for
from martwright.session import BROADCAST_BYTES
from martwright.sources.tpch import source_model
from checks import DATA

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.mark.parametrize(
    ("before", "after"),
    [("10485760b", str(BROADCAST_BYTES)), ("10MB", str(BROADCAST_BYTES)), ("2m", str(BROADCAST_BYTES)), ("256k", "256k"), ("-1", "-1")],
)
def test_broadcasts_are_bounded_and_a_lower_limit_stays(spark, before, after):
    kept = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, before)
        inputs_for(spark, f"{DATA}/sf0.001")
        assert spark.conf.get(THRESHOLD) == after
    finally:
        spark.conf.set(THRESHOLD, kept)


def test_cascade_shrinks_lines_before_they_meet_products(spark):
    sales = spark.createDataFrame(
        [(1, "A", 1.5), (1, "A", 2.5), (2, "A", 4.0), (2, "B", 8.0), (None, "A", 16.0), (3, "B", None), (1, None, 32.0)],
        "product_key bigint, order_status string, order_total_price double",
    ).selectExpr("product_key", "order_status", "cast(order_total_price as decimal(18,2)) as order_total_price")
    products = spark.createDataFrame([(1, "CPU"), (2, "ECONOMY"), (3, "CPU")], "product_key bigint, product_category string")
    left = dq_cascade_delete(SimpleNamespace(star={"dim_products": products, "sales_fact": sales}))
    rows = {(r.order_status, r.lines, None if r.sales is None else float(r.sales), r.products) for r in left.collect()}
    assert rows == {("A", 3, 20.0, 1), ("B", 1, None, 1), (None, 1, 32.0, 1)}
    optimized = plan_text(left).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Aggregate [product_key" in optimized.split("Join LeftAnti")[1]


def test_keys_are_counted_in_tasks_that_are_not_merged(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (None, "b"), (2, None)], "k bigint, t string")
    found = op.duplicate_keys(rows, ["k", "t"])
    assert {tuple(r) for r in found.collect()} == {(1, "a", 2), (None, "b", 3)}
    assert "REPARTITION_BY_NUM" in plan_text(found)


def test_lines_of_some_orders_are_cut_before_they_are_priced(spark, tmp_path):
    tables = {
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_discount double",
                     [(1, 1, 7, 2.0, 0.5), (1, 2, 8, 1.0, 0.0), (2, 1, 7, 3.0, 0.0), (None, 1, 7, 4.0, 0.0), (3, 1, None, 5.0, 0.0), (1, 3, 9, 6.0, 0.0)]),
        "part": ("p_partkey bigint, p_retailprice double", [(7, 10.0), (8, 20.0), (8, 30.0), (None, 40.0)]),
    }
    for name, (ddl, rows) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    src = source_model(spark, str(tmp_path))
    orders = spark.createDataFrame([(1,), (1,), (3,), (None,)], "order_id bigint")
    lines = op.lines_of(src, orders)
    found = sorted((r.order_id, r.item_id, r.product_id, float(r.quantity), float(r.unit_price)) for r in lines.collect())
    assert found == [(1, 1, 7, 2.0, 5.0), (1, 2, 8, 1.0, 20.0), (1, 2, 8, 1.0, 30.0)]
    whole = src["order_items"].join(orders, "order_id", "left_semi")
    assert lines.schema == whole.schema and lines.exceptAll(whole).isEmpty() and whole.exceptAll(lines).isEmpty()
    optimized = plan_text(lines).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Join LeftSemi" in optimized.split("Join Inner")[1]
    # A source of its own lines is cut as it is.
    assert op.lines_of({"order_items": src["order_items"]}, orders).exceptAll(whole).isEmpty()


def test_both_loads_need_no_third_star(spark):
    result = inc_refresh_all(SimpleNamespace(spark=spark, src=source_model(spark, f"{DATA}/sf0.001")))
    rows = {r.table_name: (r.row_count, r.added_again) for r in result.collect()}
    assert len(rows) == 8 and all(count > 0 and again == 0 for count, again in rows.values())
