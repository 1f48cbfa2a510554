"""Sources, corrections and scalar functions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ...functions import calendar_columns, full_name, month_label_padded, parse_day_month_year, text_after_nth
from ...session import shared_folder
from ...sources import append_delta, apply_corrections, load_sources, row_counts, source_rejects
from ...sources.tpch import SPLIT_DATE
from .registry import Inputs, query


@query("src_row_counts")
def src_row_counts(w: Inputs) -> DataFrame:
    return row_counts(w.src)


#: A column of each table whose letters are counted after reading.
_LETTERS = {
    "regions": "region_name",
    "countries": "country_name",
    "locations": "address",
    "warehouses": "warehouse_name",
    "employees": "email",
    "product_categories": "category_name",
    "products": "product_name",
    "customers": "address",
    "contacts": "last_name",
    "orders": "status",
    "order_items": "order_id",
    "inventories": "product_id",
}


@query("src_load_text")
def src_load_text(w: Inputs) -> DataFrame:
    """The source written as text exports, some order lines of it spoiled, and read again with the declared schema.

    Per table the rows read, the letters of one of their columns, and the lines set aside.
    """
    folder = f"{shared_folder(w.spark)}/martwright/export-{uuid.uuid4().hex}"

    def export(frame: DataFrame, name: str) -> None:
        frame.write.mode("append").option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")

    def as_text(frame: DataFrame) -> DataFrame:
        days = [f.name for f in frame.schema.fields if isinstance(f.dataType, DateType)]
        return frame.withColumns({day: F.upper(F.date_format(day, "dd-MMM-yy")) for day in days})

    for name, frame in w.src.items():
        export(as_text(frame), name)
    spoiled = as_text(w.src["orders"].where(F.col("order_id") % 50 == 0))
    no_number = F.col("order_id") % 100 == 0
    export(
        spoiled.withColumns(
            {
                "order_id": F.concat(F.when(no_number, "x").otherwise(""), F.col("order_id").cast("string")),
                "order_date": F.when(no_number, F.col("order_date")).otherwise("31-FOO-99"),
            }
        ),
        "orders",
    )
    loaded = load_sources(w.spark, folder, "csv", strict=False)
    rejected = source_rejects(w.spark, folder).groupBy("table_name").agg(F.count(F.lit(1)).alias("rejected"))

    def counted(name: str) -> DataFrame:
        frame = loaded[name]
        letters = F.sum(F.length(F.col(_LETTERS[name]).cast("string"))).alias("letters")
        return frame.agg(F.count(F.lit(1)).alias("loaded"), letters).withColumn("table_name", F.lit(name))

    counts = reduce(DataFrame.unionByName, [counted(name) for name in loaded])
    return counts.join(rejected, "table_name", "left").select(
        "table_name", "loaded", "letters", F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected")
    )


@query("src_parse_dates")
def src_parse_dates(w: Inputs) -> DataFrame:
    text = F.upper(F.date_format("order_date", "dd-MMM-yy"))
    return w.src["orders"].select("order_id", text.alias("date_text")).withColumn(
        "order_date", parse_day_month_year(F.col("date_text"))
    )


@query("src_apply_corrections")
def src_apply_corrections(w: Inputs) -> DataFrame:
    """Small products come back with a new description and list price."""
    products = w.src["products"].join(w.src["product_categories"], "category_id")
    changes = products.where(F.col("category_name") == "SMALL").withColumns(
        {
            "description": F.concat("description", F.lit(" corrected")),
            "list_price": (F.col("list_price") + 10).cast("decimal(9,2)"),
        }
    )
    corrected = apply_corrections(w.src["products"], changes, ["product_id"])
    return corrected.drop("category_id")


@query("src_append_delta")
def src_append_delta(w: Inputs) -> DataFrame:
    orders = w.src["orders"]
    early = orders.where(F.col("order_date") < F.lit(SPLIT_DATE))
    return append_delta(early, orders.where(F.col("order_date") >= F.lit(SPLIT_DATE)))


@query("fn_calendar")
def fn_calendar(w: Inputs) -> DataFrame:
    day = F.col("order_date")
    attributes = {name: column for name, column in calendar_columns(day).items() if name != "holiday_ind"}
    return (
        w.src["orders"]
        .select("order_date")
        .distinct()
        .withColumns(attributes)
        .withColumns(
            {
                "month_text": month_label_padded(day, capitals=False),
                "year_text": F.date_format(day, "yyyy"),
                "month_digits": F.date_format(day, "MM"),
                "day_text": F.date_format(day, "dd/MM/yyyy"),
                "year_start": F.trunc(day, "year").cast("date"),
                "year_earlier": F.add_months(day, -12),
                "day_before": F.date_sub(day, 1),
                "next_day": F.date_add(day, 1),
                "days_since_year_start": F.datediff(day, F.trunc(day, "year")),
            }
        )
    )


@query("fn_text")
def fn_text(w: Inputs) -> DataFrame:
    address = F.upper("address")
    contact = F.col("first_name")
    contacts = w.src["contacts"].select("customer_id", "first_name", "last_name")
    return w.src["customers"].join(contacts, "customer_id", "left").select(
        "customer_id",
        F.upper("name").alias("upper_name"),
        text_after_nth(address, ",", 2).alias("geography"),
        text_after_nth(F.upper(F.concat("address", F.lit(","), "name")), ",", 3).alias("after_third_comma"),
        F.when(F.col("address").like("%,%,%"), "Y").otherwise("N").alias("has_two_commas"),
        full_name(contact, F.col("last_name")).alias("contact_name"),
        F.coalesce(contact, F.lit("UNDEFINED")).alias("first_name"),
        F.round("credit_limit", 0).alias("credit_rounded"),
        F.concat(F.lit("["), F.col("customer_id").cast("string"), F.lit("] "), F.col("name")).alias("label"),
    )
