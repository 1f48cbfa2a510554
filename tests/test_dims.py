from __future__ import annotations

from conftest import AS_OF, day
from martwright import operators as op


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_calendar(spark):
    days = _by(op.dim_date(spark, day("2013-06-01"), day("2023-06-01")), "calendar_date")
    assert len(days) == 3653
    first = days[day("2013-06-01")]
    assert (first.date_key, first.day_of_week, first.cal_month_name) == (100001, 7, "JUNE     ")
    new_year = days[day("2017-01-01")]
    assert (new_year.cal_week_no_in_year, new_year.weekday_ind, new_year.cal_year_quarter) == (52, "N", "2017Q1")
    assert days[day("2016-01-01")].cal_week_no_in_year == 53
    assert days[day("2016-02-29")].last_day_in_month_ind == "Y"
    assert days[day("2016-02-28")].last_day_in_month_ind == "N"
    assert days[day("2016-12-30")].cal_week_end_date == day("2016-12-31")
    assert len({d.date_key for d in days.values()}) == 3653


def test_calendar_as_written(spark):
    days = _by(op.dim_date_as_written(op.dim_date(spark, day("2013-06-01"), day("2013-08-01"))), "calendar_date")
    assert days[day("2013-06-29")].last_day_in_month_ind is None
    assert days[day("2013-06-30")].last_day_in_month_ind == "Y"
    assert days[day("2013-07-10")].last_day_in_month_ind == "Y"


def test_customers(star):
    rows = _by(star["dim_customers"], "customer_id")
    assert [rows[i].customer_key for i in (1, 2, 3, 4)] == [10000001, 10000002, 10000003, 10000004]
    assert (rows[1].first_name, rows[1].last_name) == ("FLOR", "STONE")
    assert (rows[4].first_name, rows[4].customer_status) == ("UNDEFINED", "INACTIVE")
    assert [rows[i].customer_geography for i in (1, 2, 3, 4)] == [" IN", " ", None, " DE"]
    assert [rows[i].customer_status for i in (1, 2, 3)] == ["ACTIVE", "ACTIVE", "INACTIVE"]


def test_other_dimensions(star):
    products = _by(star["dim_products"], "product_id")
    assert (products[3].product_key, products[3].product_category, products[3].product_description) == (1003, "RAM", None)
    assert {r.country_id: r.country_key for r in star["dim_countries"].collect()} == {"IT": 101, "JP": 102}
    warehouses = _by(star["dim_warehouses"], "warehouse_id")
    assert (warehouses[1].state, warehouses[2].state) == ("ROMA", "TOKYO PREFECTURE")
    assert (warehouses[1].warehouse_key, warehouses[2].country_key) == (10001, 102)
    people = _by(star["dim_employees"], "employee_key")
    assert people[1000003].no_of_days_employed == (AS_OF - day("2016-12-24")).days
    assert people[9999999].asDict() == {
        "employee_key": 9999999,
        "employee_id": 9999,
        "first_name": "UNDEFINED",
        "last_name": "UNDEFINED",
        "email": "UNDEFINED",
        "phone": "UNDEFINED",
        "hire_date": None,
        "no_of_days_employed": 0,
        "job_title": "UNDEFINED",
    }


def test_sales(star, src):
    rows = star["sales_fact"].collect()
    assert len(rows) == 7
    line = next(r for r in rows if r.order_id == 1 and r.product_key == 1002)
    assert (line.order_status, line.item_quantity, line.order_total_price) == ("SHIPPED", 10, 500)
    assert (line.unit_profit, line.gross_profit, line.employee_key) == (5, 50, 1000002)
    assert line.date_key == 100001 + (day("2017-01-10") - day("2016-01-01")).days
    assert {r.employee_key for r in rows if r.order_id == 3} == {9999999}
    raw = op.fact_sales(src, star, unknown_employee=False).collect()
    assert {r.employee_key for r in raw if r.order_id == 3} == {None}
    assert sum(r.order_total_price for r in rows) == sum(q * p for _, _, _, q, p in _items())


def _items():
    from conftest import SHOP

    return SHOP["order_items"]


def test_inventories(star):
    rows = {(r.product_key, r.warehouse_key): r.inventory_quantity for r in star["inventories_fact"].collect()}
    assert rows == {(1001, 10001): 0, (1002, 10001): 9, (1003, 10001): 10, (1001, 10002): 50, (1002, 10002): 19}
