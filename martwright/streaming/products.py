"""Change-driven refresh of the product dimension.

Which ids are known is kept in the state store of the stream, so a batch works on what has arrived
and never reads the dimension: its base passes through the stream once, as its first rows, and the highest key
is noted beside every batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.dims import PRODUCT_START, dim_products_rows
from ..operators.keys import with_surrogate_key
from ..schemas import source_schema, star_schema

_MARK = "seq bigint, highest bigint"


def read_dimension(spark: SparkSession, dim_path: str) -> DataFrame:
    """The dimension so far, with the partition column ``batch``: a base and one folder per batch applied."""
    schema = star_schema("dim_products").add("batch", "string")
    return spark.read.schema(schema).option("basePath", dim_path).parquet(f"{dim_path}/batch=*")


def start_dimension(dim: DataFrame, dim_path: str) -> None:
    dim.write.mode("overwrite").parquet(f"{dim_path}/batch=base")
    written = dim.sparkSession.read.schema(star_schema("dim_products")).parquet(f"{dim_path}/batch=base")
    _note_mark(written, -1, f"{dim_path}-marks/batch=base")


def _note_mark(rows: DataFrame, seq: int, path: str) -> None:
    highest = rows.agg(F.lit(seq).cast("bigint").alias("seq"), F.max("product_key").alias("highest"))
    highest.write.mode("overwrite").parquet(path)


def _one_per_product(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per product id, the same one whenever the batch is delivered; and the differing rows of those ids."""
    rest = [c for c in products.columns if c != "product_id"]
    rows = products.select("product_id", F.struct(*rest).alias("row")).distinct()
    chosen = rows.groupBy(F.col("product_id").alias("_id")).agg(F.max("row").alias("_row"))
    differs = F.col("product_id").eqNullSafe(F.col("_id")) & ~F.col("row").eqNullSafe(F.col("_row"))
    others = rows.join(chosen, differs, "left_semi")
    return chosen.select(F.col("_id").alias("product_id"), "_row.*"), others.select("product_id", "row.*")


def rejects_path(dim_path: str) -> str:
    return f"{dim_path}-rejects"


def stream_products(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    dim_path: str,
    categories: DataFrame,
    schema: StructType,
    as_products: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Add products that arrive as new files under ``path`` to the dimension.

    Products whose id the state does not know yet are new. They get keys behind the highest one noted by the batches before, in
    a folder of the batch's own: a batch delivered twice after a failure starts from the same state and
    marks, overwrites its folder, and leaves one copy and the same keys. Of differing rows of a
    product within a batch the greatest counts; the others, and rows of no category (until one of their id has one),
    go to ``rejects_path``, a folder per batch. A hot id is one row
    of the state's; its rows are combined before any shuffle by id.
    """
    products = source_schema("products")
    named = StructType([*products.fields, StructField("category_name", StringType())]).add("known", "boolean")

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = f"batch={'batch-%010d' % batch_id}"
        # Written once and read again, so that the state moves on once per batch however often its rows are used.
        batch.write.mode("overwrite").parquet(f"{dim_path}-arrived/{own}")
        rows = session.read.schema(named).parquet(f"{dim_path}-arrived/{own}")
        arrived = rows.where("known is null").drop("known").join(rows.where("known"), "product_id", "left_anti")
        first = rows.where("not known").select(F.col("product_id").alias("_id"))
        placed = arrived.where("category_name is not null").drop("category_name")
        placed = placed.join(first, F.col("product_id").eqNullSafe(F.col("_id")), "left_semi")
        chosen, others = _one_per_product(placed)
        homeless = arrived.where("category_name is null").select(others.columns)
        others.unionByName(homeless).write.mode("overwrite").parquet(f"{rejects_path(dim_path)}/{own}")
        marks = session.read.schema(_MARK).parquet(f"{dim_path}-marks/batch=*").where(F.col("seq") < batch_id)
        highest = marks.agg(F.max("highest")).scalar()
        fresh = with_surrogate_key(dim_products_rows(chosen, categories), ["product_id"], "product_key", PRODUCT_START, highest)
        fresh.write.mode("overwrite").parquet(f"{dim_path}/{own}")
        written = session.read.schema(star_schema("dim_products")).parquet(f"{dim_path}/{own}")
        _note_mark(written, batch_id, f"{dim_path}-marks/{own}")

    feed = as_products(spark.readStream.schema(schema).parquet(path)).select(products.names)
    feed = feed.join(categories.select("category_id", "category_name"), "category_id", "left")
    base = spark.readStream.schema(star_schema("dim_products")).parquet(f"{dim_path}/batch=base")
    # What the state lets through: ids of the base, once (``known``), and ids it has not seen before, neither in the base
    # nor in a row with a category (not ``known``).
    ids = base.select("product_id", F.explode(F.array(F.lit(True), F.lit(False))).alias("known"))
    ids = ids.unionByName(feed.where("category_name is not null").select("product_id", F.lit(False).alias("known")))
    fresh = feed.withColumn("known", F.lit(None).cast("boolean")).unionByName(
        ids.dropDuplicates(["product_id", "known"]), allowMissingColumns=True
    )
    return (
        fresh.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
