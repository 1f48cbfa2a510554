"""The order-processing source model seen through TPC-H-like tables.

Prices come from the part table (extended prices there bear no relation to
it); salesmen, states and contacts get their gaps from the data itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import SOURCE_DDL, conform, source_schema

AS_OF = dt.date(2001, 12, 31)
SPLIT_DATE = dt.date(2001, 1, 1)
REPORT_YEAR = 1998
COMPARE_YEAR = 1997
CATEGORY = "ECONOMY"
WAREHOUSE = 1

_STATUS = {"F": "Shipped", "O": "Pending", "P": "Canceled"}
_FIRST_HIRE = "1993-01-01"


def part_schema(spark: SparkSession, folder: str) -> StructType:
    return spark.read.parquet(f"{folder}/part.parquet").schema


def _name_part(name: Column, index: int) -> Column:
    return F.split_part(name, F.lit("#"), F.lit(index))


def _contact_email(name: str) -> Column:
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))


def _category_id() -> Column:
    return F.xxhash64("p_type")


def products_from_part(part: DataFrame) -> DataFrame:
    retail = F.col("p_retailprice").cast("decimal(9,2)")
    size = F.col("p_size").cast("decimal(5,0)")
    cost_share = F.lit("0.700").cast("decimal(5,3)") + size * F.lit("0.005").cast("decimal(5,3)")
    rows = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat("p_brand", F.lit(" size "), F.col("p_size").cast("string")).alias("description"),
        F.round(retail * cost_share, 2).alias("standard_cost"),
        retail.alias("list_price"),
        _category_id().alias("category_id"),
    )
    return conform(rows, source_schema("products"))


class SourceModel(Mapping):
    """The twelve source tables by name, each planned when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._read = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))
        self._planned: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCE_DDL)

    def __len__(self) -> int:
        return len(SOURCE_DDL)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SOURCE_DDL:
            raise KeyError(name)
        if name not in self._planned:
            self._planned[name] = conform(getattr(self, f"_{name}")(), source_schema(name))
        return self._planned[name]

    def _places(self) -> DataFrame:
        return self._read("nation").join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def _regions(self) -> DataFrame:
        return self._read("region").select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))

    def _countries(self) -> DataFrame:
        return self._read("nation").select(
            F.col("n_nationkey").alias("country_id"),
            F.col("n_name").alias("country_name"),
            F.col("n_regionkey").alias("region_id"),
        )

    def _locations(self) -> DataFrame:
        placed = self._read("supplier").join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
        return placed.select(
            F.col("s_suppkey").alias("location_id"),
            F.concat(F.lit("1 "), F.col("s_name"), F.lit(" street")).alias("address"),
            F.when(F.col("s_acctbal") >= 0, F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("postal_code"),
            F.col("n_name").alias("city"),
            F.when(F.col("s_suppkey") % 4 != 0, F.col("r_name")).alias("state"),
            F.col("s_nationkey").alias("country_id"),
        )

    def _warehouses(self) -> DataFrame:
        return self._read("supplier").select(
            F.col("s_suppkey").alias("warehouse_id"),
            F.col("s_name").alias("warehouse_name"),
            F.col("s_suppkey").alias("location_id"),
        )

    def _employees(self) -> DataFrame:
        hired = F.date_add(F.lit(_FIRST_HIRE).cast("date"), (F.col("s_suppkey") % 700).cast("int"))
        return self._read("supplier").select(
            F.col("s_suppkey").alias("employee_id"),
            _name_part(F.col("s_name"), 1).alias("first_name"),
            _name_part(F.col("s_name"), 2).alias("last_name"),
            _contact_email("s_name").alias("email"),
            F.concat(F.lit("555."), _name_part(F.col("s_name"), 2)).alias("phone"),
            hired.alias("hire_date"),
            F.when(F.col("s_suppkey") != 0, F.floor(F.col("s_suppkey") / 10)).alias("manager_id"),
            F.concat(F.lit("Sales "), (F.col("s_suppkey") % 5).cast("string")).alias("job_title"),
        )

    def _product_categories(self) -> DataFrame:
        types = self._read("part").select("p_type").distinct()
        return types.select(_category_id().alias("category_id"), F.col("p_type").alias("category_name"))

    def _products(self) -> DataFrame:
        return products_from_part(self._read("part"))

    def _customers(self) -> DataFrame:
        placed = self._read("customer").join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
        return placed.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat_ws(", ", "c_name", "n_name", "r_name").alias("address"),
            F.col("c_acctbal").alias("credit_limit"),
            F.concat(F.lit("http://www."), F.lower("c_mktsegment"), F.lit(".example.com")).alias("website"),
        )

    def _contacts(self) -> DataFrame:
        """Customers in debt have no contact."""
        return self._read("customer").where("c_acctbal >= 0").select(
            F.col("c_custkey").alias("contact_id"),
            _name_part(F.col("c_name"), 1).alias("first_name"),
            _name_part(F.col("c_name"), 2).alias("last_name"),
            _contact_email("c_name").alias("email"),
            F.concat(F.lit("+1 "), _name_part(F.col("c_name"), 2)).alias("phone"),
            F.col("c_custkey").alias("customer_id"),
        )

    def _orders(self) -> DataFrame:
        """Every third order has no salesman; the others go to salesmen 0 to 9."""
        status = F.create_map(*[F.lit(x) for pair in _STATUS.items() for x in pair])
        return self._read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.element_at(status, F.col("o_orderstatus")).alias("status"),
            F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 10).alias("salesman_id"),
            F.to_date("o_orderdate").alias("order_date"),
        )

    def _order_items(self) -> DataFrame:
        return self._priced(self._read("lineitem"))

    def lines_of(self, orders: DataFrame) -> DataFrame:
        """``order_items`` of the given orders, cut before the lines are priced."""
        ids = orders.select(F.col("order_id").alias("_order_id"))
        lines = self._read("lineitem").join(ids, F.col("l_orderkey") == F.col("_order_id"), "left_semi")
        return conform(self._priced(lines), source_schema("order_items"))

    def _priced(self, lines: DataFrame) -> DataFrame:
        retail = F.col("p_retailprice").cast("decimal(9,2)")
        unit_price = F.round(retail * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
        priced = lines.join(self._read("part"), F.col("l_partkey") == F.col("p_partkey"))
        return priced.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            unit_price.alias("unit_price"),
        )

    def _inventories(self) -> DataFrame:
        stock = self._read("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("on_hand"))
        return stock.select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("warehouse_id"),
            (F.col("on_hand").cast("bigint") % 60).alias("quantity"),
        )


def source_model(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    return SourceModel(spark, folder)
