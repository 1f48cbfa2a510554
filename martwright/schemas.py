"""Declared schemas of the twelve source tables and the eight warehouse tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONEY = "decimal(18,2)"

# The columns, keys and limits of both data models.

SOURCE_DDL = {
    "regions": "region_id bigint, region_name string",
    "countries": "country_id string, country_name string, region_id bigint",
    "locations": "location_id bigint, address string, postal_code string, city string, state string, country_id string",
    "warehouses": "warehouse_id bigint, warehouse_name string, location_id bigint",
    "employees": "employee_id bigint, first_name string, last_name string, email string, phone string, "
    "hire_date date, manager_id bigint, job_title string",
    "product_categories": "category_id bigint, category_name string",
    "products": "product_id bigint, product_name string, description string, standard_cost decimal(9,2), "
    "list_price decimal(9,2), category_id bigint",
    "customers": "customer_id bigint, name string, address string, credit_limit decimal(8,2), website string",
    "contacts": "contact_id bigint, first_name string, last_name string, email string, phone string, customer_id bigint",
    "orders": "order_id bigint, customer_id bigint, status string, salesman_id bigint, order_date date",
    "order_items": "order_id bigint, item_id int, product_id bigint, quantity decimal(8,2), unit_price decimal(8,2)",
    "inventories": "product_id bigint, warehouse_id bigint, quantity int",
}

STAR_DDL = {
    "dim_date": "date_key bigint, calendar_date date, day_of_week int, day_of_month int, day_of_year int, "
    "last_day_in_month_ind string, cal_week_end_date date, cal_week_no_in_year int, cal_month_name string, "
    "cal_month_no_in_year int, cal_year_month string, cal_quarter string, cal_year_quarter string, cal_year int, "
    "holiday_ind string, weekday_ind string",
    "dim_products": "product_key bigint, product_id bigint, product_name string, product_description string, "
    "product_category string",
    "dim_customers": "customer_key bigint, customer_id bigint, customer_name string, first_name string, "
    "last_name string, address string, credit_limit decimal(8,2), customer_status string, customer_geography string",
    "dim_countries": "country_key bigint, country_id string, country_name string, region_name string",
    "dim_warehouses": "warehouse_key bigint, warehouse_id bigint, warehouse_name string, address string, "
    "postal_code string, city string, state string, country_key bigint",
    "dim_employees": "employee_key bigint, employee_id bigint, first_name string, last_name string, email string, "
    "phone string, hire_date date, no_of_days_employed bigint, job_title string",
    "sales_fact": "date_key bigint, product_key bigint, customer_key bigint, employee_key bigint, order_id bigint, "
    "order_status string, order_date date, item_quantity decimal(8,2), standard_cost decimal(9,2), "
    "unit_price decimal(8,2), unit_profit decimal(9,2), order_total_price decimal(18,2), gross_profit decimal(18,2)",
    "inventories_fact": "product_key bigint, warehouse_key bigint, inventory_quantity int, "
    "standard_cost decimal(9,2), list_price decimal(9,2)",
}

SOURCE_PRIMARY_KEYS = {
    "regions": ["region_id"],
    "countries": ["country_id"],
    "locations": ["location_id"],
    "warehouses": ["warehouse_id"],
    "employees": ["employee_id"],
    "product_categories": ["category_id"],
    "products": ["product_id"],
    "customers": ["customer_id"],
    "contacts": ["contact_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "item_id"],
    "inventories": ["product_id", "warehouse_id"],
}

# (child, child column, parent, parent column)
SOURCE_FOREIGN_KEYS = [
    ("countries", "region_id", "regions", "region_id"),
    ("locations", "country_id", "countries", "country_id"),
    ("warehouses", "location_id", "locations", "location_id"),
    ("employees", "manager_id", "employees", "employee_id"),
    ("products", "category_id", "product_categories", "category_id"),
    ("contacts", "customer_id", "customers", "customer_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "salesman_id", "employees", "employee_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("inventories", "product_id", "products", "product_id"),
    ("inventories", "warehouse_id", "warehouses", "warehouse_id"),
]

STAR_FOREIGN_KEYS = [
    ("dim_warehouses", "country_key", "dim_countries", "country_key"),
    ("sales_fact", "date_key", "dim_date", "date_key"),
    ("sales_fact", "product_key", "dim_products", "product_key"),
    ("sales_fact", "customer_key", "dim_customers", "customer_key"),
    ("sales_fact", "employee_key", "dim_employees", "employee_key"),
    ("inventories_fact", "product_key", "dim_products", "product_key"),
    ("inventories_fact", "warehouse_key", "dim_warehouses", "warehouse_key"),
]

STAR_PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_products": ["product_key"],
    "dim_customers": ["customer_key"],
    "dim_countries": ["country_key"],
    "dim_warehouses": ["warehouse_key"],
    "dim_employees": ["employee_key"],
}

STAR_NULLABLE = {
    "dim_date": {"last_day_in_month_ind", "holiday_ind", "weekday_ind"},
    "dim_products": {"product_description"},
    "dim_customers": {"credit_limit", "customer_geography"},
    "dim_warehouses": {"postal_code"},
    "dim_employees": {"hire_date", "no_of_days_employed"},
    "sales_fact": {"employee_key", "standard_cost", "unit_profit", "order_total_price", "gross_profit"},
    "inventories_fact": {"standard_cost", "list_price"},
}

# Declared limits: an int is a text width, a pair is decimal (precision, scale).
STAR_LIMITS = {
    "dim_products": {"product_name": 50, "product_description": 2000, "product_category": 255},
    "dim_customers": {
        "customer_name": 50,
        "first_name": 255,
        "last_name": 255,
        "address": 255,
        "credit_limit": (8, 2),
        "customer_status": 50,
        "customer_geography": 50,
    },
    "dim_countries": {"country_id": 2, "country_name": 40, "region_name": 50},
    "dim_warehouses": {"warehouse_name": 255, "address": 255, "postal_code": 20, "city": 50, "state": 50},
    "dim_employees": {"first_name": 255, "last_name": 255, "email": 255, "phone": 50, "job_title": 255},
    "sales_fact": {
        "order_status": 20,
        "item_quantity": (8, 2),
        "standard_cost": (9, 2),
        "unit_price": (8, 2),
        "unit_profit": (8, 2),
        "order_total_price": (8, 2),
        "gross_profit": (8, 2),
    },
    "inventories_fact": {"inventory_quantity": (4, 0), "standard_cost": (9, 2), "list_price": (9, 2)},
}


def source_schema(table: str) -> StructType:
    return StructType.fromDDL(SOURCE_DDL[table])


def star_schema(table: str) -> StructType:
    return StructType.fromDDL(STAR_DDL[table])


def column_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in re.split(r",(?![^(]*\))", ddl)]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the declared columns, in order, with the declared types."""
    return df.select([_typed(f.name, f.dataType) for f in schema.fields])


def _typed(name: str, dtype) -> Column:
    return F.col(name).cast(dtype).alias(name)
