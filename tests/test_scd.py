from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import day
from martwright import operators as op
from martwright.operators.scd import OPEN_END

FLAG = "products_active_flag"


def _first(star):
    return op.scd2_init(star["dim_products"], FLAG)


def _apply(dim, changes):
    return op.scd2_apply(dim, changes, "product_id", "product_key", FLAG, 1001)


def _changes(spark, *rows, columns="product_id bigint, start_date date, product_description string"):
    return spark.createDataFrame(list(rows), columns)


def _versions(dim, product_id):
    rows = dim.where(F.col("product_id") == product_id).orderBy("start_date").collect()
    return [(r.product_key, r.product_description, r.start_date, r.end_date, r[FLAG]) for r in rows]


def _check_ranges(dim):
    """One open version per id, and no day covered twice."""
    by_id = {}
    for row in dim.orderBy("product_id", "start_date").collect():
        by_id.setdefault(row.product_id, []).append(row)
    for rows in by_id.values():
        assert [r[FLAG] for r in rows] == ["N"] * (len(rows) - 1) + ["Y"]
        assert rows[-1].end_date == OPEN_END
        for a, b in zip(rows, rows[1:]):
            assert a.start_date <= a.end_date and b.start_date == a.end_date + dt.timedelta(days=1)
    keys = [r.product_key for rows in by_id.values() for r in rows]
    assert len(keys) == len(set(keys))


def test_holidays_and_missing_days(spark):
    calendar = op.dim_date(spark, day("2016-12-01"), day("2016-12-31"))
    days = spark.createDataFrame([(day("2016-12-25"),), (day("2016-12-25"),), (day("2031-01-01"),)], "calendar_date date")
    marked, missing = op.mark_holidays(calendar, days)
    assert marked.count() == 31
    assert [r.calendar_date for r in marked.where("holiday_ind = 'Y'").collect()] == [day("2016-12-25")]
    assert [r.calendar_date for r in missing.collect()] == [day("2031-01-01")]


def test_one_change(spark, star):
    dim, rejects = _apply(_first(star), _changes(spark, (1, day("2018-12-24"), "NEW")))
    assert _versions(dim, 1) == [
        (1001, "FAST", day("2017-01-01"), day("2018-12-23"), "N"),
        (1004, "NEW", day("2018-12-24"), OPEN_END, "Y"),
    ]
    assert rejects.count() == 0 and dim.count() == 4
    _check_ranges(dim)


def test_several_changes_of_one_id_in_a_batch(spark, star):
    changes = _changes(
        spark,
        (2, day("2018-06-01"), "B"),
        (1, day("2018-01-01"), "A"),
        (2, day("2018-03-01"), "A"),
        (2, day("2018-03-01"), "A"),
        (2, day("2019-01-01"), "C"),
    )
    dim, _ = _apply(_first(star), changes)
    assert [(k, d, e) for k, d, _, e, _ in _versions(dim, 2)] == [
        (1002, "SLOW", day("2018-02-28")),
        (1005, "A", day("2018-05-31")),
        (1006, "B", day("2018-12-31")),
        (1007, "C", OPEN_END),
    ]
    _check_ranges(dim)


def test_attributes_carry_over(spark, star):
    changes = _changes(spark, (3, day("2018-01-01")), columns="product_id bigint, start_date date")
    dim, _ = _apply(_first(star), changes)
    old, new = dim.where("product_id = 3").orderBy("start_date").collect()
    assert (new.product_name, new.product_category, new.product_description) == ("STICK", "RAM", None)
    assert old.end_date == day("2017-12-31")


def test_second_run_and_redelivery(spark, star):
    first = _changes(spark, (1, day("2018-01-01"), "A"))
    once, _ = _apply(_first(star), first)
    again, rejects = _apply(once, first)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, once.collect()))
    assert "not after" in rejects.first().reject_reason
    later, _ = _apply(once, _changes(spark, (1, day("2019-01-01"), "B")))
    assert len(_versions(later, 1)) == 3, "only the current version is replaced"
    _check_ranges(later)


def test_unknown_ids_are_rejected_and_the_rest_applied(spark, star):
    dim, rejects = _apply(_first(star), _changes(spark, (77, day("2018-01-01"), "X"), (1, day("2018-01-01"), "A")))
    assert [(r.product_id, r.reject_reason) for r in rejects.collect()] == [(77, "product_id 77 does not exist")]
    assert len(_versions(dim, 1)) == 2


def test_employee_change_recomputes_days(spark, star):
    dim = op.scd2_init(star["dim_employees"], "employee_active_flag")
    changes = spark.createDataFrame([(2, day("2018-01-24"))], "employee_id bigint, start_date date")
    days = F.datediff(F.lit(day("2018-02-28")), "hire_date").cast("bigint")
    changed, _ = op.scd2_apply(
        dim,
        changes,
        "employee_id",
        "employee_key",
        "employee_active_flag",
        1000001,
        reserved_key=9999999,
        recompute={"no_of_days_employed": days},
    )
    new = changed.where("employee_id = 2 and employee_active_flag = 'Y'").first()
    assert (new.employee_key, new.no_of_days_employed) == (1000004, 730)
    assert new.hire_date == day("2016-02-29")


def test_few_changes_do_not_shuffle_the_dimension(spark, tmp_path):
    many = spark.range(3_000_000).selectExpr(
        "id as product_key",
        "id as product_id",
        "'a' as product_name",
        "'b' as product_description",
        "'c' as product_category",
    )
    few = _changes(spark, (5, day("2018-01-01"), "NEW"), (-1, day("2018-01-01"), "NEW"))
    few.write.parquet(f"{tmp_path}/changes")
    changes = spark.read.parquet(f"{tmp_path}/changes")
    dim, rejects = _apply(op.scd2_init(many, FLAG), changes)
    for frame in (dim, rejects):
        joins = [line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
        assert joins and not [line for line in joins if "SortMergeJoin [product_id" in line and "LeftAnti" not in line]
    assert dim.count() == 3_000_001 and rejects.count() == 1


def test_as_of_join(spark, star):
    dim, _ = _apply(_first(star), _changes(spark, (1, day("2018-01-01"), "NEW")))
    sales = spark.createDataFrame(
        [(1, day("2017-12-31")), (1, day("2018-01-01")), (1, day("2016-12-31")), (2, day("2030-01-01"))],
        "product_id bigint, order_date date",
    )
    joined = op.as_of_join(sales, dim, "product_id", "order_date")
    assert {(r.product_id, r.order_date): r.product_key for r in joined.collect()} == {
        (1, day("2016-12-31")): 1001,  # before the first version
        (1, day("2017-12-31")): 1001,
        (1, day("2018-01-01")): 1004,
        (2, day("2030-01-01")): 1002,
    }
    assert op.as_of_join(sales, dim, "product_id", "order_date", "left").count() == 4


def test_as_of_join_edges(spark, star):
    dim, _ = _apply(_first(star), _changes(spark, (1, day("2018-01-01"), "NEW"), (1, day("2019-01-01"), "NEWER")))
    gap = dim.where("product_description <> 'NEW'")  # 2018 is covered by no version
    sales = spark.createDataFrame(
        [(1, day("2018-06-01"), "a"), (1, day("2019-01-01"), "b"), (1, None, "c"), (None, day("2018-01-01"), "d"), (99, day("2018-01-01"), "e")]
        + [(1, day("2019-01-01"), "b")],
        "product_id bigint, order_date date, product_name string",
    )
    inner = op.as_of_join(sales, gap, "product_id", "order_date").collect()
    assert sorted((r.product_name, r.product_description) for r in inner) == [("b", "NEWER"), ("b", "NEWER")]
    left = op.as_of_join(sales, gap, "product_id", "order_date", "left")
    assert left.columns[:3] == sales.columns and left.count() == 6
    assert left.where("product_key is null").count() == 4
    assert op.as_of_join(sales.limit(0), gap, "product_id", "order_date").count() == 0


def test_as_of_join_scans_each_side_once_and_spreads_a_hot_id(spark, tmp_path):
    versions = spark.range(50).selectExpr(
        "id % 5 as product_id", "id as product_key", "date_add(date'2017-01-01', cast(id * 7 as int)) as start_date",
        "date'9999-12-31' as end_date",
    )
    rows = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 1, id % 5) as product_id", "date_add(date'2016-12-01', cast(id % 500 as int)) as order_date", "id as line"
    )
    versions.write.parquet(f"{tmp_path}/v")
    rows.write.parquet(f"{tmp_path}/r")
    v, r = spark.read.parquet(f"{tmp_path}/v"), spark.read.parquet(f"{tmp_path}/r")
    joined = op.as_of_join(r, v, "product_id", "order_date")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    held = {}
    for x in v.collect():
        held.setdefault(x.product_id, []).append((x.start_date, x.product_key))
    got = joined.collect()
    assert len(got) == 60_000
    for x in got[::97]:
        starts = sorted(held[x.product_id])
        assert x.product_key == max([s for s in starts if s[0] <= x.order_date] or starts[:1])[1]
    spread = r.where("product_id = 1").selectExpr("pmod(xxhash64(product_id, order_date, line), 8) as s").groupBy("s").count()
    assert spread.count() == 8 and max(c["count"] for c in spread.collect()) < 1.2 * 24_000 / 8 * 1.2
