"""Reading the twelve source tables and exposing frames as SQL views."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.text import parse_day_month_year
from ..schemas import SOURCE_DDL, source_schema


_BAD = "_corrupt_record"
_REJECTS = "table_name string, file string, line string, reject_reason string"


def load_sources(spark: SparkSession, folder: str, fmt: str = "parquet", strict: bool = True) -> dict[str, DataFrame]:
    """Read ``<folder>/<table>`` for every source table with its declared schema.

    Text exports (``fmt="csv"``, with a header) carry dates as ``17-NOV-16`` and
    are parsed on read; empty text is NULL there. Lines that do not fit the schema fail the read, or,
    unless ``strict``, are left out: then ``source_rejects`` has them.
    """
    return {table: _load(spark, f"{folder}/{table}", table, fmt, strict) for table in SOURCE_DDL}


def _load(spark: SparkSession, path: str, table: str, fmt: str, strict: bool) -> DataFrame:
    schema = source_schema(table)
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    if strict:
        rows = spark.read.schema(_as_text(schema)).options(header=True, mode="FAILFAST").csv(path)
        return rows.withColumns({name: parse_day_month_year(F.col(name)) for name in _dates(schema)})
    lines = _lines(spark, path, schema)
    return lines.where(_reason(schema).isNull()).select([F.col(f"_{n}").alias(n) if n in _dates(schema) else n for n in schema.names])


def source_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """``table_name, file, line, reject_reason``: the lines of a text export that ``load_sources`` leaves out."""

    def of(table: str) -> DataFrame:
        schema = source_schema(table)
        lines = _lines(spark, f"{folder}/{table}", schema).withColumn("reject_reason", _reason(schema))
        text = F.coalesce(_BAD, F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in schema.names]))
        return lines.where("reject_reason is not null").select(
            F.lit(table).alias("table_name"), "file", text.alias("line"), "reject_reason"
        )

    return reduce(DataFrame.unionByName, [of(table) for table in SOURCE_DDL])


def _dates(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, DateType)]


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType() if f.name in _dates(schema) else f.dataType) for f in schema.fields])


def _lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every line of an export: its columns, dates as text and (``_name``) parsed, ``file``, and itself if it does not fit."""
    # Without pruning, or whether a line fits would depend on the columns somebody asks for.
    rows = (
        spark.read.schema(_as_text(schema).add(_BAD, StringType()))
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, columnPruning=False)
        .csv(path)
    )
    # A day that does not exist is no date here, where the reader's own parser would raise.
    parsed = {f"_{name}": parse_day_month_year(F.when(F.col(name).rlike(_DAY), F.col(name))) for name in _dates(schema)}
    return rows.withColumns({"file": F.col("_metadata.file_path"), **parsed})


#: Fixed format of dates in exports: 17-NOV-16.
_DAY = r"(?i)^([0-2]\d|3[01])-(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)-\d\d$"


def _reason(schema: StructType) -> Column:
    """Why a line is left out; null for a good one."""
    # The reader refuses queries over the column of unfit lines alone; the second half is never true and names another.
    unfit = F.col(_BAD).isNotNull() | (F.length(F.col(schema.names[0]).cast("string")) < 0)
    reason = F.when(unfit, "the line does not fit the declared columns")
    for name in _dates(schema):
        reason = reason.when(F.col(name).isNotNull() & F.col(f"_{name}").isNull(), f"{name} is no date")
    return reason


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make each frame a temporary view for SQL users."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(prefix + name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count)."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
