"""The six dimensions.

Joins carry no broadcast hints: category, country and location lookups are
broadcast by their measured size and fall back to a sort-merge join beyond it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..functions.text import text_after_nth, upper_text
from ..schemas import conform, star_schema
from .keys import with_surrogate_key

# First surrogate key of each dimension, and the unknown member.
DATE_START = 100001
PRODUCT_START = 1001
CUSTOMER_START = 10000001
COUNTRY_START = 101
WAREHOUSE_START = 10001
EMPLOYEE_START = 1000001
UNKNOWN_EMPLOYEE_KEY = 9999999
UNKNOWN_EMPLOYEE_ID = 9999
UNDEFINED = "UNDEFINED"


def _calendar(days: DataFrame, first: Column) -> DataFrame:
    """Calendar rows for a frame of (calendar_date); keys count days from ``first``."""
    key = F.lit(DATE_START) + F.datediff("calendar_date", first)
    rows = days.withColumn("date_key", key).withColumns(calendar_columns(F.col("calendar_date")))
    return conform(rows, star_schema("dim_date"))


def calendar_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("calendar_date"))


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    return _calendar(calendar_days(spark, start, end), F.lit(start))


def dim_date_spanning(df: DataFrame, column: str) -> DataFrame:
    """A calendar of whole years around all dates of ``column``."""
    span = df.agg(
        F.trunc(F.min(column), "year").alias("first"),
        F.date_add(F.add_months(F.trunc(F.max(column), "year"), 12), -1).alias("last"),
    )
    days = span.select("first", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("calendar_date"))
    return _calendar(days, F.col("first"))


def dim_date_as_written(dim: DataFrame) -> DataFrame:
    """The literal month-end flag: NULL before the first month end, ``Y`` ever after."""
    first_month_end = dim.agg(F.min(F.last_day("calendar_date"))).scalar()
    flag = F.when(F.col("calendar_date") >= first_month_end, "Y")
    return dim.withColumn("last_day_in_month_ind", flag)


def dim_products_rows(products: DataFrame, categories: DataFrame) -> DataFrame:
    return products.join(categories, "category_id").select(
        "product_id",
        upper_text("product_name"),
        upper_text("description", "product_description"),
        upper_text("category_name", "product_category"),
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    rows = dim_products_rows(products, categories)
    return with_surrogate_key(rows, ["product_id"], "product_key", PRODUCT_START)


def dim_customers_rows(
    customers: DataFrame, contacts: DataFrame, orders: DataFrame, as_of: dt.date, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Customer rows with their lowest-numbered contact, activity status and geography.

    Orders shrink to one last date per customer before the join, so a customer
    with very many orders is combined map-side instead of fanning out. Customers
    without a contact get the text UNDEFINED.
    """
    last_orders = orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    main_contacts = contacts.groupBy("customer_id").agg(
        F.min_by(F.struct("first_name", "last_name"), "contact_id").alias("contact")
    )
    address = F.upper("address")
    cutoff = F.add_months(F.lit(as_of), -12)
    return (
        customers.join(main_contacts, "customer_id", "left")
        .join(last_orders, "customer_id", "left")
        .select(
            *carry,
            "customer_id",
            upper_text("name", "customer_name"),
            F.coalesce(F.upper("contact.first_name"), F.lit(UNDEFINED)).alias("first_name"),
            F.coalesce(F.upper("contact.last_name"), F.lit(UNDEFINED)).alias("last_name"),
            address.alias("address"),
            "credit_limit",
            F.when(F.col("last_order") >= cutoff, "ACTIVE").otherwise("INACTIVE").alias("customer_status"),
            text_after_nth(address, ",", 2).alias("customer_geography"),
        )
    )


def dim_customers(customers: DataFrame, contacts: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    # Keys go on the bare customer table: left joins keep its rows, and the two
    # passes of the numbering then never repeat the contact and order work.
    keyed = with_surrogate_key(customers, ["customer_id"], "customer_key", CUSTOMER_START)
    return dim_customers_rows(keyed, contacts, orders, as_of, carry=("customer_key",))


def dim_countries_rows(countries: DataFrame, regions: DataFrame) -> DataFrame:
    return countries.join(regions, "region_id").select(
        upper_text("country_id"), upper_text("country_name"), upper_text("region_name")
    )


def dim_countries(countries: DataFrame, regions: DataFrame) -> DataFrame:
    rows = dim_countries_rows(countries, regions)
    return with_surrogate_key(rows, ["country_id"], "country_key", COUNTRY_START)


def dim_warehouses_rows(warehouses: DataFrame, locations: DataFrame, countries_dim: DataFrame) -> DataFrame:
    return (
        warehouses.join(locations, "location_id")
        .join(countries_dim.select("country_id", "country_key"), "country_id")
        .select(
            "warehouse_id",
            upper_text("warehouse_name"),
            upper_text("address"),
            upper_text("postal_code"),
            upper_text("city"),
            F.coalesce(F.upper("state"), F.upper("city")).alias("state"),
            "country_key",
        )
    )


def dim_warehouses(warehouses: DataFrame, locations: DataFrame, countries_dim: DataFrame) -> DataFrame:
    rows = dim_warehouses_rows(warehouses, locations, countries_dim)
    return with_surrogate_key(rows, ["warehouse_id"], "warehouse_key", WAREHOUSE_START)


def dim_employees_rows(employees: DataFrame, as_of: dt.date) -> DataFrame:
    return employees.select(
        "employee_id",
        upper_text("first_name"),
        upper_text("last_name"),
        "email",
        upper_text("phone"),
        "hire_date",
        F.datediff(F.lit(as_of), "hire_date").cast("bigint").alias("no_of_days_employed"),
        upper_text("job_title"),
    )


def dim_employees(employees: DataFrame, as_of: dt.date) -> DataFrame:
    rows = dim_employees_rows(employees, as_of)
    return with_surrogate_key(
        rows, ["employee_id"], "employee_key", EMPLOYEE_START, reserved=UNKNOWN_EMPLOYEE_KEY
    )


def with_unknown_employee(dim: DataFrame) -> DataFrame:
    """Add the member that stands for orders without a salesman."""
    fixed = {
        "employee_key": UNKNOWN_EMPLOYEE_KEY,
        "employee_id": UNKNOWN_EMPLOYEE_ID,
        "hire_date": None,
        "no_of_days_employed": 0,
    }
    row = dim.sparkSession.range(1).select(
        *[F.lit(fixed.get(f.name, UNDEFINED)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)
