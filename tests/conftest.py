from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from martwright.plans import build_star  # noqa: E402
from martwright.schemas import SOURCE_DDL, conform, source_schema  # noqa: E402
from martwright.session import expect_skew, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "martwright-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    expect_skew(session)
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


# A shop small enough to work out by hand: a product sold only in Q2, an order
# without a salesman, a customer without a contact, one with two, addresses with
# one and two commas and with nothing behind the second.
SHOP = {
    "regions": [(1, "Europe"), (2, "Asia")],
    "countries": [("IT", "Italy", 1), ("JP", "Japan", 2)],
    "locations": [
        (1, "1 Via Roma", "00989", "Roma", None, "IT"),
        (2, "2 Shinjuku", None, "Tokyo", "Tokyo Prefecture", "JP"),
    ],
    "warehouses": [(1, "South", 1), (2, "East", 2)],
    "employees": [
        (1, "Ann", "Lee", "ann@x.com", "1", day("2016-01-03"), None, "Boss"),
        (2, "Bob", "Ray", "bob@x.com", "2", day("2016-02-29"), 1, "Seller"),
        (3, "Cy", "Fox", "cy@x.com", "3", day("2016-12-24"), 1, "Seller"),
    ],
    "product_categories": [(1, "Cpu"), (2, "Ram")],
    "products": [
        (1, "Chip", "fast", 60, 100, 1),
        (2, "Chop", "slow", 45, 50, 1),
        (3, "Stick", None, 9, 10, 2),
    ],
    "customers": [
        (1, "Acme", "1 Main St, Kokomo, IN", 100, "w"),
        (2, "Bolt", "2 Side St, Rome, ", 200, "w"),
        (3, "Cord", "3 Back St, Oslo", 300, "w"),
        (4, "Dune", "4 Far St, Bonn, DE", 400, "w"),
    ],
    "contacts": [
        (1, "Flor", "Stone", "e", "p", 1),
        (7, "Late", "Comer", "e", "p", 1),
        (2, "Lav", "Em", "e", "p", 2),
        (3, "Fern", "Head", "e", "p", 3),
    ],
    "orders": [
        (1, 1, "Shipped", 2, day("2017-01-10")),
        (2, 1, "Pending", 2, day("2017-02-28")),
        (3, 2, "Shipped", None, day("2017-05-05")),
        (4, 2, "Canceled", 3, day("2016-12-31")),
        (5, 3, "Shipped", 3, day("2016-11-30")),
    ],
    "order_items": [
        (1, 1, 1, 2, 100),
        (1, 2, 2, 10, 50),
        (2, 1, 1, 1, 110),
        (3, 1, 3, 5, 10),
        (3, 2, 2, 4, 50),
        (4, 1, 2, 3, 50),
        (5, 1, 1, 1, 100),
    ],
    "inventories": [(1, 1, 0), (2, 1, 9), (3, 1, 10), (1, 2, 50), (2, 2, 19)],
}
AS_OF = day("2017-12-31")
CALENDAR = (day("2016-01-01"), day("2017-12-31"))


def shop_tables(spark, data=None):
    tables = {}
    for name in SOURCE_DDL:
        schema = source_schema(name)
        text = ", ".join(
            f"{f.name} {'double' if 'decimal' in f.dataType.simpleString() else f.dataType.simpleString()}"
            for f in schema.fields
        )
        rows = [
            tuple(float(v) if "double" in c.split()[1] and v is not None else v for v, c in zip(row, text.split(", ")))
            for row in (data or SHOP)[name]
        ]
        tables[name] = conform(spark.createDataFrame(rows, text), schema)
    return tables


@pytest.fixture(scope="session")
def src(spark):
    return shop_tables(spark)


@pytest.fixture(scope="session")
def star(spark, src):
    # Kept in memory for the tests; the library itself publishes stars to files.
    return {name: frame.persist() for name, frame in build_star(src, AS_OF, CALENDAR).items()}


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()
