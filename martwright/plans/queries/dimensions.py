"""Dimension and fact builds, straight from the source model."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import operators as op
from ...sources.tpch import AS_OF
from .registry import Inputs, query


@query("dim_surrogate_keys")
def dim_surrogate_keys(w: Inputs) -> DataFrame:
    """Dense keys over the largest natural key there is, the orders."""
    return op.with_surrogate_key(w.src["orders"].select("order_id"), ["order_id"], "order_key", 1)


@query("dim_date")
def dim_date(w: Inputs) -> DataFrame:
    return op.dim_date_spanning(w.src["orders"], "order_date")


@query("dim_date_as_written")
def dim_date_as_written(w: Inputs) -> DataFrame:
    return op.dim_date_as_written(op.dim_date_spanning(w.src["orders"], "order_date"))


@query("dim_products")
def dim_products(w: Inputs) -> DataFrame:
    return op.dim_products(w.src["products"], w.src["product_categories"])


@query("dim_customers")
def dim_customers(w: Inputs) -> DataFrame:
    return op.dim_customers(w.src["customers"], w.src["contacts"], w.src["orders"], AS_OF)


@query("dim_countries")
def dim_countries(w: Inputs) -> DataFrame:
    return op.dim_countries(w.src["countries"], w.src["regions"])


@query("dim_warehouses")
def dim_warehouses(w: Inputs) -> DataFrame:
    return op.dim_warehouses(w.src["warehouses"], w.src["locations"], dim_countries(w))


@query("dim_employees")
def dim_employees(w: Inputs) -> DataFrame:
    return op.dim_employees(w.src["employees"], AS_OF)


@query("dim_employees_unknown")
def dim_employees_unknown(w: Inputs) -> DataFrame:
    return op.with_unknown_employee(dim_employees(w))


@query("fact_sales")
def fact_sales(w: Inputs) -> DataFrame:
    return op.fact_sales(w.src, w.star, unknown_employee=False)


@query("fact_sales_unknown_employee")
def fact_sales_unknown_employee(w: Inputs) -> DataFrame:
    return op.fact_sales(w.src, w.star)


@query("fact_inventories")
def fact_inventories(w: Inputs) -> DataFrame:
    return op.fact_inventories(w.src, w.star)


@query("fact_sales_reserved_id")
def fact_sales_reserved_id(w: Inputs) -> DataFrame:
    """A real employee has the unknown member's id and takes the pending orders."""
    people = w.src["employees"]
    namesake = people.where("employee_id = 1").withColumn("employee_id", F.lit(op.UNKNOWN_EMPLOYEE_ID).cast("long"))
    salesman = F.when(F.col("status") == "Pending", op.UNKNOWN_EMPLOYEE_ID).otherwise(F.col("salesman_id"))
    orders = w.src["orders"].withColumn("salesman_id", salesman)
    staff = people.where(F.col("employee_id") != op.UNKNOWN_EMPLOYEE_ID).unionByName(namesake)
    employees = op.with_unknown_employee(op.dim_employees(staff, AS_OF))
    return op.fact_sales(ChainMap({"orders": orders}, w.src), {**w.star, "dim_employees": employees})


@query("fact_rejects")
def fact_rejects(w: Inputs) -> DataFrame:
    """Lines that find no member once the calendar lacks 1998, the customers Europe and the products one line."""
    dims = {
        **w.star,
        "dim_date": w.star["dim_date"].where("cal_year <> 1998"),
        "dim_customers": w.star["dim_customers"].where("customer_geography <> ' EUROPE'"),
        "dim_products": w.star["dim_products"].where("product_category <> 'ECONOMY'"),
    }
    return op.sales_rejects(w.src, dims)


@query("dim_text_keys")
def dim_text_keys(w: Inputs) -> DataFrame:
    """Surrogate keys over customers' names, a text id, in its order."""
    return op.with_surrogate_key(w.src["customers"].select("name", "customer_id"), ["name"], "name_key", 1)
