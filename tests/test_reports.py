from __future__ import annotations

from decimal import Decimal as D

from pyspark.sql import functions as F

from conftest import plan_text
from martwright.operators import scd2_init, subtotal, top_k_with_ties
from martwright.plans import reports as r


def _tuples(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def test_monthly_growth(star):
    rows = _tuples(
        r.monthly_growth(star, 2017, "cpu"), "sales_month", "sales_amount", "pre_sales_amount", "growth", "sales_performance"
    )
    assert rows == [
        ("JANUARY", D(150), D(0), D(0), "Constant Performance"),
        ("FEBRUARY", D(110), D(150), D("-26.67"), "Reduced Performance"),
        ("MAY", D(50), D(110), D("-54.55"), "Reduced Performance"),
    ]


def test_monthly_growth_as_written(star):
    rows = r.monthly_growth_as_written(star, 2017, "CPU").collect()
    every_sale = 100 + 50 + 110 + 50 + 50 + 100
    assert [row.sales_amount for row in rows] == [
        every_sale * days for days in (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
    ]
    assert (rows[1].growth, rows[2].sales_performance) == (D("-9.68"), "Improved Performance")
    assert r.monthly_growth_as_written(star, 2017, "NONE").count() == 0


def test_employee_quarterly(star):
    rows = r.employee_quarterly(star, 2017).collect()
    assert [tuple(row) for row in rows] == [(2, "BOB RAY", "SELLER", D(810), 0, 0, 0, D(13), D(810))]


def test_low_margin(star):
    columns = ("product_id", "sales_unit", "sales_revenue", "gross_profit", "gross_profit_margin")
    rows = _tuples(r.low_margin(star, 0.2), *columns)
    assert rows == [(2, D(17), D(850), D(85), D(10)), (3, D(5), D(50), D(5), D(10))]
    assert r.low_margin(star, 0.1).count() == 0


def test_inventory_status(star):
    columns = ("country_name", "product_id", "total_inventory_quantity", "inventory_status", "reorder_level")
    rows = _tuples(r.inventory_status(star, 1), *columns)
    assert rows == [
        ("[IT] ITALY", 1, 0, "Out of Stock", "Reorder Needed"),
        ("[IT] ITALY", 2, 9, "Low Stock", "Reorder Needed"),
        ("[IT] ITALY", 3, 10, "Medium Stock", "Reorder Needed"),
    ]
    assert _tuples(r.inventory_status(star, 2), "inventory_status", "reorder_level") == [
        ("Medium Stock", "Reorder Needed"),
        ("High Stock", "Sufficient Stock"),
    ]
    assert r.inventory_status(star, 77).count() == 0


def test_geo_monthly(star):
    rows = {tuple(row) for row in r.geo_monthly(star, 2017).collect()}
    assert rows == {
        (" IN", "ACME", "January  ", "2017", D(700), D(0)),
        (" IN", "ACME", "February ", "2017", D(110), D(0)),
        (" ", "BOLT", "May      ", "2017", D(250), D(0)),
        (" ", "BOLT", "December ", "2016", D(0), D(150)),
        (None, "CORD", "November ", "2016", D(0), D(100)),
    }
    assert r.geo_monthly(star, 2017).collect()[-1].customer_geography is None


def test_geo_monthly_yoy_has_one_row_per_month(spark, star):
    more = star["sales_fact"].where("order_id = 1").withColumn("date_key", F.col("date_key") - 365)
    more = more.withColumn("order_date", F.col("order_date") - F.expr("interval 365 days"))
    more = more.withColumn("order_date", F.col("order_date").cast("date"))
    both = {**star, "sales_fact": star["sales_fact"].unionByName(more)}
    row = r.geo_monthly_yoy(both, 2017).where("month = 'January  '").collect()
    assert [(x.revenue, x.prev_year_revenue) for x in row] == [(D(700), D(700))]


def test_annual_category(star):
    columns = ("product_category", "sales_month", "num_orders", "total_sales", "total_profit", "avg_sales_amount")
    rows = _tuples(r.annual_category(star, 2017), *columns)
    assert rows == [
        ("CPU", "JANUARY  ", 1, D(700), D(130), D(350)),
        ("CPU", "FEBRUARY ", 1, D(110), D(50), D(110)),
        ("CPU", "MAY      ", 1, D(200), D(20), D(200)),
        ("RAM", "MAY      ", 1, D(50), D(5), D(50)),
    ]


def test_lifetime_value(star):
    (row,) = r.cltv_top10(star, 2017).collect()
    # Acme: average line 810/3, two orders on two days, 49 days apart.
    assert (row.ranking, row.customer_id, row.avg_purchase_value_per_year) == (1, 1, D(270))
    assert (row.num_of_purchases_per_year, row.avg_customer_lifespan) == (2, D("0.13"))
    assert row.customer_lifetime_value == D("36.25")


def test_top_k_keeps_ties(spark):
    values = [9, 9, 8, 7, 7, 7, 7, 6, None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    best = top_k_with_ties(df.where("v is not null"), "v", 4, "ranking")
    assert sorted((row.ranking, row.v) for row in best.collect()) == [(1, 9), (1, 9), (3, 8), (4, 7), (4, 7), (4, 7), (4, 7)]
    nulls_first = {(row.ranking, row.v) for row in top_k_with_ties(df, "v", 2, "ranking").collect()}
    assert nulls_first == {(1, None), (2, 9)}


def test_retention(star):
    rows = {row.customer_geography: row for row in r.retention(star, 2017).collect()}
    assert set(rows) == {" "}
    row = rows[" "]
    assert (row.ranking, row.product_category, row.total_customers) == (1, "CPU", 1)
    assert (row.acquired_customers, row.retained_customers, row.retention_rate, row.cac) == (1, 1, 100.0, 50.0)


def test_employee_performance(star):
    rows = [tuple(row) for row in r.employee_performance(star).collect()]
    assert rows == [
        (2, "BOB RAY", "SELLER", 3, D(810), D(270), 1, D("66.67")),
        (3, "CY FOX", "SELLER", 2, D(250), D(125), 2, D(50)),
    ]


def test_top_products(star):
    columns = ("product_id", "product_status", "sales_amount", "sales_profit", "profit_contribution")
    rows = _tuples(r.top_products(star, 2017, 2), *columns)
    assert rows == [(2, "ACTIVE", D(700), D(70), D(10)), (1, "ACTIVE", D(310), D(130), D("41.94"))]


def test_fractional_quantities_are_not_rounded_line_by_line(spark, star):
    line = star["sales_fact"].where("order_id = 2").withColumn("item_quantity", F.lit(D("0.15")).cast("decimal(8,2)"))
    # 0.15 units at 110 with a cost of 60.03: 16.50 - 9.0045 a line.
    line = line.withColumn("standard_cost", F.lit(D("60.03")).cast("decimal(9,2)"))
    line = line.withColumn("order_total_price", F.lit(D("16.50")).cast("decimal(18,2)"))
    three = {**star, "sales_fact": line.unionByName(line).unionByName(line)}
    (row,) = r.top_products(three, 2017).collect()
    assert (row.sales_unit, row.sales_amount, row.sales_profit) == (D("0.45"), D("49.50"), D("22.49"))
    assert row.profit_contribution == D("45.43")


def test_market_trend(star):
    columns = ("ranking", "product_category", "initial_sales", "comparison_sales", "quantity_diff", "percent_diff")
    rows = _tuples(r.market_trend(star, 2017, 2016), *columns)
    assert rows == [
        (1, "RAM", D(50), D(0), D(-5), 100.0),
        (2, "CPU", D(1010), D(250), D(-13), 100 * 760 / 1010),
    ]
    # A category without sales in the first year has no percentage and comes first.
    back = r.market_trend(star, 2016, 2017).collect()
    assert (back[0].product_category, back[0].percent_diff) == ("RAM", None)


def test_product_quarterly(star):
    rows = sorted(tuple(row) for row in r.product_quarterly(star, 2017).collect())
    assert rows == [
        (1, "CHIP", D(90), 0, 0, 0, D(3), D(90), D(210)),
        (2, "CHOP", D(5), D(5), 0, 0, D(14), D(10), D(100)),
    ]
    every = sorted(tuple(row) for row in r.product_quarterly_all(star, 2016).collect())
    assert every == [
        (1, "CHIP", 0, 0, 0, D(40), D(1), D(40), D(100)),
        (2, "CHOP", 0, 0, 0, D(15), D(3), D(15), D(150)),
        (3, "STICK", 0, 0, 0, 0, 0, 0, 0),
    ]


def test_subtotals_fold_report_rows(star):
    report = r.monthly_growth(star, 2017, "CPU")
    (row,) = subtotal(report, {"sum": ["sales_amount"], "avg": ["sales_amount"]}).collect()
    assert (row.total_sales_amount, row.average_sales_amount) == (D(310), D("103.33"))
    by_place = subtotal(r.geo_monthly(star, 2017), {"sum": ["revenue"]}, ["customer_geography"])
    assert {x.customer_geography: x.total_revenue for x in by_place.collect()} == {" IN": 810, " ": 250, None: 0}


def test_versions_do_not_fan_out_reports(star):
    """Sales keep the key of the version they were loaded with."""
    old = scd2_init(star["dim_products"], "products_active_flag")
    new = old.withColumn("product_key", F.col("product_key") + 500)
    versioned = {**star, "dim_products": old.unionByName(new)}
    assert r.top_products(versioned, 2017).collect() == r.top_products(star, 2017).collect()
    assert r.annual_category(versioned, 2017).collect() == r.annual_category(star, 2017).collect()


def test_reports_as_views(spark, star):
    r.register_reports(star, 2017, 2016, "CPU", 1, "shop_")
    assert spark.sql("select sum(sales_amount) from shop_monthly_growth").first()[0] == 310
    assert len([t for t in spark.catalog.listTables() if t.name.startswith("shop_")]) >= 12


def test_no_report_needs_a_cartesian_product(star):
    reports = [
        r.monthly_growth(star, 2017, "CPU"),
        r.monthly_growth_as_written(star, 2017, "CPU"),
        r.employee_quarterly(star, 2017),
        r.low_margin(star),
        r.inventory_status(star, 1),
        r.geo_monthly(star, 2017),
        r.geo_monthly_yoy(star, 2017),
        r.annual_category(star, 2017),
        r.cltv_top10(star, 2017),
        r.retention(star, 2017),
        r.employee_performance(star),
        r.top_products(star, 2017),
        r.market_trend(star, 2017, 2016),
        r.product_quarterly(star, 2017),
        r.product_quarterly_all(star, 2017),
    ]
    for report in reports:
        text = plan_text(report)
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
