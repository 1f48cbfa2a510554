"""Dense surrogate keys without a one-task sort.

A global ``row_number`` would pull a whole dimension into one task. Instead the
leading natural key is cut into blocks by its high bits: rows are numbered
inside their block, and blocks get their offsets from running sums of block
sizes, themselves grouped by still higher bits. Distinct ids bound every window
group: 2^18 ids in a block, 2^23 blocks in a zone, 2^23 zones in all (a single
zone holds ids up to 2^41). Text ids have no such bits: their blocks are ranges between
bounds taken from a sample of the ids, which is chosen by their hashes. The numbering
depends on the data alone, so a recomputed task hands out the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType

_BLOCK_BITS = 18
_ZONE_BITS = 23
#: Text ids in the sample (those of the least hashes), and every how many of them, in order, bounds a block.
_SAMPLE = 16384
_EVERY = 16
#: A search among the bounds cuts what is left into so many parts, one bound looked at between two.
_RUN = 2


def _before(count: str, *partition: str, order: str) -> Column:
    frame = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(frame), F.lit(0))


def _leading_number(df: DataFrame, name: str) -> Column:
    """An order-preserving whole number for the leading natural key."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(dtype, IntegralType):
        return F.col(name).cast("bigint")
    raise TypeError(f"no surrogate keys over {dtype.simpleString()} column {name}")


def _with_text_block(df: DataFrame, name: str) -> DataFrame:
    """``_block``, the number of the range of ids that a text id lies in: how many bounds are not greater.

    The bounds are a scalar subquery over the sample, at most _SAMPLE / _EVERY of them.
    """
    sample = df.select(name).where(F.col(name).isNotNull()).orderBy(F.xxhash64(name), name).limit(_SAMPLE)
    ids = sample.agg(F.array_sort(F.collect_list(name)).alias("ids"))
    bounds = ids.select(F.filter("ids", lambda _, at: at % _EVERY == _EVERY - 1)).scalar()

    # Steps of falling width over the sorted bounds, each taken if the last bound it passes is not greater.
    widths, width = [], 1
    while width <= _SAMPLE // _EVERY:
        widths, width = [width] * (_RUN - 1) + widths, width * _RUN
    steps = F.array(*[F.lit(width) for width in widths])
    block = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get("_bounds", at + step - 1) <= F.col(name), at + step).otherwise(at),
    )
    return df.withColumn("_bounds", bounds).withColumn("_block", block.cast("bigint")).drop("_bounds")


def _with_block(df: DataFrame, name: str) -> DataFrame:
    if isinstance(df.schema[name].dataType, StringType):
        return _with_text_block(df, name)
    return df.withColumn("_block", F.shiftright(_leading_number(df, name), _BLOCK_BITS))


def with_surrogate_key(
    df: DataFrame,
    natural_key: list[str],
    name: str,
    start: int,
    after: Column | None = None,
    reserved: int | None = None,
) -> DataFrame:
    """Add ``name``: ``start``, ``start`` + 1, … in order of the (unique) natural key.

    The leading natural key is a whole number, a date or a text (in binary order).
    ``after`` continues behind an existing highest key (ignored while NULL).
    ``reserved`` is one key value never handed out (an unknown member's).
    """
    cut = _with_block(df, natural_key[0])
    blocks = (
        cut.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_zone", F.shiftright("_block", _ZONE_BITS))
    )
    zones = (
        blocks.groupBy("_zone")
        .agg(F.sum("_rows").alias("_zone_rows"))
        .select("_zone", _before("_zone_rows", order="_zone").alias("_zone_start"))
    )
    offsets = (
        blocks.withColumn("_start", _before("_rows", "_zone", order="_block"))
        .join(zones, "_zone")
        .select("_block", (F.col("_start") + F.col("_zone_start")).alias("_offset"))
    )
    first = F.lit(start - 1) if after is None else F.greatest(F.lit(start - 1), after)
    in_block = F.row_number().over(Window.partitionBy("_block").orderBy(*natural_key))
    numbered = cut.withColumn("_rank", in_block).join(offsets, "_block")
    key = first + F.col("_offset") + F.col("_rank")
    if reserved is not None:
        # Keys are consecutive from `first`, so only those from `reserved` on move up.
        key = F.when((key >= reserved) & (first < reserved), key + 1).otherwise(key)
    return numbered.select(key.cast("bigint").alias(name), *df.columns)


def highest_key(dim: DataFrame, name: str, reserved: int | None = None) -> Column:
    """The highest key in use, as a scalar subquery (no driver round trip)."""
    used = dim if reserved is None else dim.where(F.col(name) != reserved)
    return used.agg(F.max(name)).scalar()
