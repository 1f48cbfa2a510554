"""Rows must not vanish, double or change value without a word."""

from __future__ import annotations

import importlib
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, CALENDAR, SHOP, day, shop_tables
from martwright import operators as op
from martwright.plans import build_star, reports
from martwright.streaming.products import _one_per_product

p = importlib.import_module("martwright.sources.publish")


def _shop(**changed):
    return {**SHOP, **changed}


def test_an_employee_with_the_unknown_id_sells_each_line_once(spark):
    staff = SHOP["employees"] + [(9999, "Real", "One", "r@x.com", "1", day("2016-05-05"), 1, "Seller")]
    orders = [(*o[:3], 9999, o[4]) if o[0] in (1, 3) else o for o in SHOP["orders"]]
    src = shop_tables(spark, _shop(employees=staff, orders=orders))
    star = build_star(src, AS_OF, CALENDAR)
    keys = {r.order_id: r.employee_key for r in star["sales_fact"].collect()}
    assert star["sales_fact"].count() == len(SHOP["order_items"])
    assert keys[1] == keys[3] != op.UNKNOWN_EMPLOYEE_KEY


def test_a_change_of_the_unknown_id_leaves_the_unknown_member_alone(spark, star):
    first = op.scd2_init(star["dim_employees"], "flag")
    changes = spark.createDataFrame([(9999, day("2018-01-01"), "BOSS")], "employee_id bigint, start_date date, job_title string")
    dim, rejects = op.scd2_apply(first, changes, "employee_id", "employee_key", "flag", 1000001, op.UNKNOWN_EMPLOYEE_KEY)
    assert dim.count() == first.count() and dim.where("flag = 'N'").count() == 0
    assert [r.reject_reason for r in rejects.collect()] == ["employee_id 9999 does not exist"]


def test_changes_that_are_not_applied_are_rejected(spark, star):
    first = op.scd2_init(star["dim_products"], "flag")
    rows = [
        (1, day("2018-01-01"), "A"),
        (1, day("2018-01-01"), "B"),
        (1, day("2018-01-01"), "B"),
        (2, None, "C"),
        (None, day("2018-01-01"), "D"),
    ]
    changes = spark.createDataFrame(rows, "product_id bigint, start_date date, product_description string")
    dim, rejects = op.scd2_apply(first, changes, "product_id", "product_key", "flag", 1001)
    assert {r.product_description for r in dim.where("product_id = 1").collect()} == {"FAST", "B"}
    assert sorted((r.product_id or 0, r.reject_reason) for r in rejects.collect()) == [
        (0, "product_id (none) does not exist"),
        (1, "another change of the day was preferred"),
        (2, "start date is not after the current version's"),
    ]


def test_lines_without_a_member_are_rejected(spark):
    lines = SHOP["order_items"] + [(1, 3, 99, 1, 1), (77, 1, 1, 1, 1)]
    src = shop_tables(spark, _shop(order_items=lines, orders=SHOP["orders"] + [(6, 42, "Shipped", 2, day("2031-01-01"))]))
    src["order_items"] = src["order_items"].unionByName(
        src["order_items"].where("order_id = 5").withColumn("order_id", F.lit(6).cast("long"))
    )
    star = build_star(src, AS_OF, CALENDAR)
    rejects = sorted((r.order_id, r.item_id, r.reject_reason) for r in op.sales_rejects(src, star).collect())
    assert rejects == [
        (1, 3, "product 99 has no member"),
        (6, 1, "customer 42 has no member"),
        (6, 1, "date 2031-01-01 has no member"),
        (77, 1, "the order does not exist"),
    ]
    assert star["sales_fact"].count() + len({r[:2] for r in rejects}) == src["order_items"].count()


def test_geography_adds_up_unrounded_products(spark):
    src = shop_tables(spark, _shop(order_items=[(1, 1, 1, 2.25, 10.13)]))
    rows = reports.geo_monthly(build_star(src, AS_OF, CALENDAR), 2017).collect()
    assert [float(r.revenue) for r in rows] == [22.7925]


def test_negative_revenue_has_a_margin(spark):
    src = shop_tables(spark, _shop(order_items=[(1, 1, 1, -2, 100), (1, 2, 2, 1, 0)]))
    star = build_star(src, AS_OF, CALENDAR)
    # -200 revenue, -80 profit: a margin of 0.4; no revenue: none.
    assert reports.low_margin(star, 0.5).count() == 1 and reports.low_margin(star, 0.3).count() == 0


def test_differing_rows_of_a_batch_are_kept_aside(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "d")]
    chosen, others = _one_per_product(spark.createDataFrame(rows, "product_id bigint, product_name string"))
    assert sorted(map(tuple, chosen.collect()), key=str) == [(1, "b"), (2, "c"), (None, "d")]
    assert list(map(tuple, others.collect())) == [(1, "a")]


def _ids(spark, root):
    return sorted(r.id for r in p.read_published(spark, root).collect())


def test_of_writers_at_once_at_most_one_gets_in(spark, tmp_path):
    root = f"{tmp_path}/table"
    base = p.publish(spark.range(3), root)

    def add(k):
        try:
            return p.publish_delta(spark.range(10 * k, 10 * k + 2), root, base=base)
        except p.PublicationClash:
            return None

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(add, [1, 2, 3, 4]))
    won = [k for k, v in zip([1, 2, 3, 4], versions) if v is not None]
    assert len(won) <= 1 and all(v in (None, base + 1) for v in versions)
    assert _ids(spark, root) == [0, 1, 2, *(10 * k + i for k in won for i in (0, 1))]
    for k in {1, 2, 3, 4} - set(won):
        p.publish_delta(spark.range(10 * k, 10 * k + 2), root)
    assert _ids(spark, root) == [0, 1, 2, *(10 * k + i for k in (1, 2, 3, 4) for i in (0, 1))]


def test_a_delta_from_an_older_state_is_refused(spark, tmp_path):
    root = f"{tmp_path}/table"
    base = p.publish(spark.range(3), root)
    assert p.publish_delta(spark.range(3, 5), root, base=base) == base + 1
    with pytest.raises(p.PublicationClash):
        p.publish_delta(spark.range(3, 5), root, base=base)
    with pytest.raises(p.PublicationClash):
        p.publish(spark.range(1), root, base=base)
    assert _ids(spark, root) == [0, 1, 2, 3, 4] and p.version_of(spark, root) == base + 1


def test_rivals_wait_for_the_greater_and_give_way_to_the_less(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/table"
    base = p.publish(spark.range(1), root)
    monkeypatch.setattr(p, "PATIENCE", 2.0)
    # A rival with a lesser name stands: withdraw at once.
    p._note(spark, [(base + 1, "0", False)], p._CLAIM, f"{root}/claims/entry=0")
    with pytest.raises(p.PublicationClash):
        p.publish_delta(spark.range(1, 2), root)
    assert p._claims(spark, root, base + 1) == {"0"}
    p._withdraw(spark, root, base + 1, "0")
    # One with a greater name is waited for, and in the way while it stands.
    p._note(spark, [(base + 1, "z", False)], p._CLAIM, f"{root}/claims/entry=z")
    with pytest.raises(p.PublicationClash):
        p.publish_delta(spark.range(1, 2), root)
    looks = []
    claims = p._claims

    def withdrawn_at_the_second_look(*args):
        looks.append(1)
        if len(looks) == 2:
            p._withdraw(spark, root, base + 1, "z")
        return claims(*args)

    monkeypatch.setattr(p, "_claims", withdrawn_at_the_second_look)
    assert p.publish_delta(spark.range(1, 2), root) == base + 1 and len(looks) == 2
    assert _ids(spark, root) == [0, 1]


def test_claims_of_the_dead_can_be_cleared(spark, tmp_path):
    root = f"{tmp_path}/table"
    base = p.publish(spark.range(1), root)
    p._note(spark, [(base + 1, "0", False)], p._CLAIM, f"{root}/claims/entry=0")
    p.clear_claims(spark, root)
    assert p.publish_delta(spark.range(1, 2), root) == base + 1


def test_empty_deltas_are_not_listed_and_tables_are_compacted(spark, tmp_path):
    root = f"{tmp_path}/table"
    p.publish(spark.range(3), root)
    for _ in range(5):
        p.publish_delta(spark.range(0), root)
    assert len(p._entries(spark, root)) == 2
    p.publish_delta(spark.range(3, 5), root)
    p.compact(spark, root)
    table = p.read_published(spark, root)
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]
    assert len({f.rsplit("/", 2)[-2] for f in table.inputFiles()}) == 1


def test_a_broken_list_is_not_an_empty_one(spark, tmp_path):
    root = f"{tmp_path}/table"
    (tmp_path / "table" / "published" / "entry=x").mkdir(parents=True)
    (tmp_path / "table" / "published" / "entry=x" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match=r"(?i)parquet|footer|malformed|cannot read"):
        p.publish_delta(spark.range(1), root)
