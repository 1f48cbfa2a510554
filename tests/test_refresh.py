from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, CALENDAR, SHOP, day, shop_tables
from martwright import operators as op
from martwright.sources.publish import _entries
from martwright.plans import correct_sales, publish_star, read_star, refresh_star

LATER = {
    **SHOP,
    "countries": SHOP["countries"] + [("DE", "Germany", 1)],
    "locations": SHOP["locations"] + [(3, "3 Ring", "1", "Bonn", None, "DE")],
    "warehouses": SHOP["warehouses"] + [(3, "North", 3)],
    "employees": SHOP["employees"] + [(9, "Eve", "Kay", "e", "9", day("2018-01-02"), 1, "Seller")],
    "products": SHOP["products"] + [(8, "Slab", "wide", 5, 7, 2)],
    "customers": SHOP["customers"] + [(6, "Echo", "6 New St, Graz, AT", 600, "w")],
    "orders": [o for o in SHOP["orders"] if o[0] != 2]
    + [
        (2, 2, "Shipped", 3, day("2017-03-15")),
        (6, 6, "Pending", 9, day("2018-01-05")),
        (7, 1, "Shipped", None, day("2018-01-06")),
    ],
    "order_items": SHOP["order_items"] + [(6, 1, 8, 2, 7), (7, 1, 1, 1, 100)],
    "inventories": SHOP["inventories"] + [(8, 3, 4), (1, 3, 5)],
}


@pytest.fixture(scope="module")
def later(spark):
    return shop_tables(spark, LATER)


def _keys(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_new_members_only(star, later):
    assert _keys(op.refresh_products(star["dim_products"], later), "product_key", "product_id") == [(1004, 8)]
    assert _keys(op.refresh_countries(star["dim_countries"], later), "country_key", "country_id") == [(103, "DE")]
    customers = op.refresh_customers(star["dim_customers"], later, day("2018-12-31"))
    assert _keys(customers, "customer_key", "customer_id", "first_name", "customer_status", "customer_geography") == [
        (10000005, 6, "UNDEFINED", "ACTIVE", " AT")
    ]
    people = op.refresh_employees(star["dim_employees"], later, day("2018-01-31"))
    assert _keys(people, "employee_key", "employee_id", "no_of_days_employed") == [(1000004, 9, 29)]
    countries = star["dim_countries"].unionByName(op.refresh_countries(star["dim_countries"], later))
    warehouses = op.refresh_warehouses(star["dim_warehouses"], later, countries)
    assert _keys(warehouses, "warehouse_key", "country_key") == [(10003, 103)]


def test_dates_do_not_repeat(star):
    new = op.refresh_dates(star["dim_date"], day("2017-12-01"), day("2018-01-31"))
    rows = _keys(new, "calendar_date", "date_key")
    assert len(rows) == 31 and rows[0] == (day("2018-01-01"), 100001 + 731)
    both = star["dim_date"].unionByName(new)
    assert op.refresh_dates(both, day("2017-12-01"), day("2018-01-31")).count() == 0


def test_nothing_new_in_the_same_source(star, src):
    assert op.refresh_products(star["dim_products"], src).count() == 0
    assert op.refresh_sales(star["sales_fact"], src, star).count() == 0
    assert op.refresh_inventories(star["inventories_fact"], src, star).count() == 0


def test_empty_fact_takes_everything(star, src):
    assert op.refresh_sales(star["sales_fact"].where("false"), src, star).count() == 7


def test_both_loads_end_to_end(spark, src, later, tmp_path):
    root = str(tmp_path)
    publish_star(spark, root, src, AS_OF, CALENDAR)
    changes = {
        "dim_products": spark.createDataFrame(
            [(1, day("2018-01-01")), (8, day("2018-06-01")), (50, day("2018-01-01"))],
            "product_id bigint, start_date date",
        )
    }
    holidays = spark.createDataFrame([(day("2016-12-25"),), (day("1999-12-25"),)], "calendar_date date")
    span = (day("2017-06-01"), day("2018-01-31"))
    star, rejects = refresh_star(spark, root, later, day("2018-01-31"), span, holidays, changes)

    counts = {name: frame.count() for name, frame in star.items()}
    assert counts == {
        "dim_date": 731 + 31,
        "dim_products": 6,
        "dim_customers": 5,
        "dim_countries": 3,
        "dim_warehouses": 3,
        "dim_employees": 5,
        "sales_fact": 9,
        "inventories_fact": 7,
    }
    assert rejects["dim_products"].first().product_id == 50
    assert rejects["dim_date"].first().calendar_date == day("1999-12-25")
    sold = {r.order_id: r for r in star["sales_fact"].where("order_id > 5").collect()}
    version = {(r.product_id, r.products_active_flag): r.product_key for r in star["dim_products"].collect()}
    assert sold[7].product_key == version[1, "Y"], "sold after the change"
    assert sold[6].product_key == version[8, "N"], "sold before the change takes effect"
    assert (sold[6].order_status, sold[7].employee_key) == ("PENDING", 9999999)
    assert op.orphan_rows(star["sales_fact"], star["dim_products"], "product_key").count() == 0

    again, _ = refresh_star(spark, root, later, day("2018-01-31"), span, holidays, changes)
    assert {name: frame.count() for name, frame in again.items()} == counts

    # Order 2 moved to another customer and day, below the high-water mark.
    fixed = correct_sales(spark, root, later["orders"].where("order_id = 2"), later)
    (line,) = fixed["sales_fact"].where("order_id = 2").collect()
    assert (line.order_date, line.order_status, line.order_year) == (day("2017-03-15"), "SHIPPED", 2017)
    assert fixed["sales_fact"].count() == 9
    *_, (_, newest, _, _) = _entries(spark, f"{root}/sales_fact")
    written = {p.parent.name for p in (tmp_path / f"sales_fact/data/version={newest}").glob("order_year=2017/*/*.parquet")}
    assert written == {"order_month=3"}, "February has lost its only line, other months are left alone"
    assert read_star(spark, root)["sales_fact"].agg(F.sum("order_total_price")).first()[0] == sum(
        i[3] * i[4] for i in LATER["order_items"]
    )


def test_sales_find_the_version_of_their_day(spark, src, star):
    dim = op.scd2_init(star["dim_customers"], "customer_active_flag", day("2017-01-01"))
    changes = spark.createDataFrame([(1, day("2017-02-01"))], "customer_id bigint, start_date date")
    versions, _ = op.scd2_apply(dim, changes, "customer_id", "customer_key", "customer_active_flag", 10000001)
    people = op.scd2_init(star["dim_employees"], "employee_active_flag", day("2017-02-01"))
    fact = op.fact_sales(src, {**star, "dim_customers": versions, "dim_employees": people})
    keys = {r.order_id: (r.customer_key, r.employee_key) for r in fact.collect()}
    assert fact.count() == 7, "no sale is lost, also none before the first version"
    assert keys == {
        1: (10000001, 1000002),
        2: (10000005, 1000002),
        3: (10000002, 9999999),
        4: (10000002, 1000003),
        5: (10000003, 1000003),
    }


def test_a_year_can_lose_its_last_line(spark, src, tmp_path):
    root = str(tmp_path)
    publish_star(spark, root, src, AS_OF, CALENDAR)
    late = src["orders"].where("order_id in (4, 5)").withColumn("order_date", F.lit(day("2017-12-01")))
    star = correct_sales(spark, root, late, src)
    assert _keys(star["sales_fact"].groupBy("order_year").count(), "order_year", "count") == [(2017, 7)]
    assert correct_sales(spark, root, late.where("false"), src)["sales_fact"].count() == 7


def test_corrections_read_and_write_the_touched_months_only(spark, src, tmp_path, monkeypatch):
    from conftest import plan_text
    from martwright.plans import refresh

    root = str(tmp_path)
    publish_star(spark, root, src, AS_OF, CALENDAR)
    plans, publish_parts = [], refresh.publish_parts
    monkeypatch.setattr(refresh, "publish_parts", lambda frame, *rest: (plans.append(plan_text(frame)), publish_parts(frame, *rest)))
    before = src["orders"].where("order_id = 3")
    star = correct_sales(spark, root, before.withColumn("order_date", F.lit(day("2017-06-07"))), src, before=before)
    dates = {r.order_id: (r.order_date, r.order_month) for r in star["sales_fact"].collect()}
    assert dates[3] == (day("2017-06-07"), 6) and dates[1] == (day("2017-01-10"), 1) and star["sales_fact"].count() == 7
    scan = [line for line in plans[0].splitlines() if "PartitionFilters" in line and "order_month" in line]
    assert scan and all("order_month#" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scan)
    newest = [(drops, part) for v, _, drops, part in _entries(spark, f"{root}/sales_fact") if v == 2]
    assert newest == [
        (True, "order_year=2017/order_month=5"),
        (True, "order_year=2017/order_month=6"),
        (False, "order_year=2017/order_month=6"),
    ]


def test_the_mark_reads_one_month(spark, src, later, tmp_path):
    from martwright.operators.incremental import newest_month
    from martwright.sources import read_newest

    root = str(tmp_path)
    star = publish_star(spark, root, src, AS_OF, CALENDAR)
    newest = read_newest(spark, f"{root}/sales_fact")
    assert newest.inputFiles() and all("order_year=2017/order_month=5" in f for f in newest.inputFiles())
    assert op.refresh_sales(newest, later, star).count() == op.refresh_sales(star["sales_fact"], later, star).count()
    month = newest_month(star["sales_fact"])
    assert _keys(month, "order_id") == [(3,), (3,)]
    month.collect()
    scan = next(line for line in month._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(order_year" in scan and "order_month" in scan.split("PartitionFilters")[1]


@pytest.mark.parametrize("together", [True, False])
def test_overlapping_refreshes_leave_each_row_once(spark, src, later, tmp_path, monkeypatch, together):
    """Two refreshes from one state, at once, or one within the other."""
    from concurrent.futures import ThreadPoolExecutor

    from martwright.plans import refresh
    from martwright.sources import PublicationClash

    root = str(tmp_path)
    publish_star(spark, root, src, AS_OF, CALENDAR)
    span = (day("2017-06-01"), day("2018-01-31"))

    def load(_=None):
        try:
            refresh_star(spark, root, later, day("2018-01-31"), span)
            return True
        except PublicationClash:
            return False

    if together:
        with ThreadPoolExecutor(2) as pool:
            done = list(pool.map(load, range(2)))
        assert not all(done)
    else:
        read, first = refresh.read_star, []

        def read_then_be_overtaken(*args):
            frames = read(*args)
            if not first:
                first.append(0)
                first[0] = load()
            return frames

        monkeypatch.setattr(refresh, "read_star", read_then_be_overtaken)
        assert load() is False and first == [True]
    assert load(), "run again, a refresh that lost goes through"
    star = read_star(spark, root)
    assert star["sales_fact"].count() == 9 and star["inventories_fact"].count() == 7
    for name, key in [("dim_products", "product_id"), ("dim_customers", "customer_id"), ("dim_date", "calendar_date")]:
        assert star[name].groupBy(key).count().where("count > 1").count() == 0
    assert star["dim_products"].count() == 4 and star["dim_customers"].count() == 5


def test_half_written_versions_do_not_show(spark, src, tmp_path):
    root = str(tmp_path)
    star = publish_star(spark, root, src, AS_OF, CALENDAR)
    star["sales_fact"].write.partitionBy("order_year").parquet(f"{root}/sales_fact/data/version=2")
    assert read_star(spark, root)["sales_fact"].count() == 7


def test_year_filters_prune_partitions(spark, src, tmp_path):
    from conftest import plan_text
    from martwright.plans import reports as r

    star = publish_star(spark, str(tmp_path), src, AS_OF, CALENDAR)
    text = plan_text(r.top_products(star, 2017))
    assert "PartitionFilters: [isnotnull(order_year" in text
    assert r.top_products(star, 2017).collect()[0].product_id == 2
