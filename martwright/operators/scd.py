"""Slowly changing dimensions of types 1 and 2, set at a time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import highest_key, with_surrogate_key

# The open end of a version and the default start of first versions.
OPEN_END = dt.date(9999, 12, 31)
FIRST_START = dt.date(2017, 1, 1)
FIRST_START_EMPLOYEES = dt.date(2017, 2, 1)


def mark_holidays(dim_date: DataFrame, dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Type 1: flag the given dates (column ``calendar_date``) in place.

    Returns the updated calendar and the dates it does not hold.
    """
    wanted = dates.select("calendar_date").distinct()
    marked = (
        dim_date.join(wanted.withColumn("_holiday", F.lit(True)), "calendar_date", "left")
        .withColumn("holiday_ind", F.when(F.col("_holiday"), "Y").otherwise(F.col("holiday_ind")))
        .select(dim_date.columns)
    )
    missing = wanted.join(dim_date.select("calendar_date"), "calendar_date", "left_anti")
    return marked, missing


def in_force_from(natural_key: str) -> Column:
    """The first day of a version; days before an id's first version belong to that one."""
    first = F.min("start_date").over(Window.partitionBy(natural_key))
    dawn = F.make_date(F.lit(1), F.lit(1), F.lit(1))
    return F.when(F.col("start_date") == first, dawn).otherwise(F.col("start_date"))


def scd2_init(dim: DataFrame, flag: str, start: dt.date = FIRST_START) -> DataFrame:
    """Give an unversioned dimension its first, open versions."""
    return dim.withColumns({"start_date": F.lit(start), "end_date": F.lit(OPEN_END), flag: F.lit("Y")})


def current(dim: DataFrame, flag: str) -> DataFrame:
    return dim.where(F.col(flag) == "Y")


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    natural_key: str,
    surrogate_key: str,
    flag: str,
    key_start: int,
    reserved_key: int | None = None,
    recompute: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Type 2: close current versions and open new ones, several per id if need be.

    ``changes`` holds the natural key, ``start_date`` and any attributes that
    change; other attributes carry over from the current version. ``recompute``
    derives columns of the new versions. Returns the whole new dimension and the
    rejected changes with a reason: unknown ids, starts missing or not after the start
    of the current version (so a change delivered twice is not applied twice), and,
    where changes of one id and day differ, all but the greatest. The member with
    ``reserved_key`` never changes: its id may be a real one's too.

    Changes of one id and day are combined before any shuffle by id, so an id has at
    most one change per calendar day and its window stays that small. Changes small enough are broadcast, and then the
    dimension is scanned but not shuffled.
    """
    attributes = [c for c in changes.columns if c not in (natural_key, "start_date")]
    wanted = changes.select(
        natural_key, "start_date", (F.struct(*attributes) if attributes else F.lit(0)).alias("_new")
    )
    daily = wanted.groupBy(natural_key, "start_date").agg(F.max("_new").alias("_new"))
    real = F.lit(True) if reserved_key is None else F.col(surrogate_key) != reserved_key
    live = current(dim, flag).where(real).drop("end_date", flag).withColumnRenamed("start_date", "_since")
    # Inner, so that few changes are broadcast and the dimension is not shuffled for them.
    matched = live.join(daily, natural_key)
    accepted = matched.where(F.col("start_date") > F.col("_since"))

    late = F.coalesce(F.col("start_date") <= F.col("_since"), F.lit(True))
    stale = matched.where(late).select(
        natural_key, "start_date", F.lit("start date is not after the current version's").alias("reject_reason")
    )
    same_day = F.col("w.start_date").eqNullSafe(F.col("d.start_date"))
    same_id = F.col(f"w.{natural_key}").eqNullSafe(F.col(f"d.{natural_key}"))
    beaten = (
        wanted.distinct()
        .alias("w")
        .join(daily.alias("d"), same_id & same_day)
        .where(~F.col("w._new").eqNullSafe(F.col("d._new")))
        .select(f"w.{natural_key}", "w.start_date", F.lit("another change of the day was preferred").alias("reject_reason"))
    )
    unknown = daily.join(matched.select(natural_key), natural_key, "left_anti").select(
        natural_key,
        "start_date",
        F.concat(
            F.lit(f"{natural_key} "), F.coalesce(F.col(natural_key).cast("string"), F.lit("(none)")), F.lit(" does not exist")
        ).alias("reject_reason"),
    )
    rejects = stale.unionByName(unknown).unionByName(beaten)

    by_id = Window.partitionBy(natural_key).orderBy("start_date")
    next_start = F.lead("start_date").over(by_id)
    versions = accepted.withColumns(
        {
            "end_date": F.coalesce(F.date_sub(next_start, 1), F.lit(OPEN_END)),
            flag: F.when(next_start.isNull(), "Y").otherwise("N"),
            **{name: F.col(f"_new.{name}") for name in attributes},
        }
    ).withColumns(recompute or {})
    opened = with_surrogate_key(
        versions.select([c for c in dim.columns if c != surrogate_key]),
        [natural_key, "start_date"],
        surrogate_key,
        key_start,
        after=highest_key(dim, surrogate_key, reserved_key),
        reserved=reserved_key,
    )

    # From the changes alone: joined with anything first, they would look too big to broadcast.
    starts = daily.groupBy(natural_key).agg(F.collect_set("start_date").alias("_starts"))
    closed_by = F.array_min(F.filter("_starts", lambda start: start > F.col("start_date")))
    closes = (F.col(flag) == "Y") & real & closed_by.isNotNull()
    kept = (
        dim.join(starts, natural_key, "left")
        .withColumns(
            {
                "end_date": F.when(closes, F.date_sub(closed_by, 1)).otherwise(F.col("end_date")),
                flag: F.when(closes, "N").otherwise(F.col(flag)),
            }
        )
        .select(dim.columns)
    )
    return kept.unionByName(opened.select(dim.columns)), rejects


def as_of_join(
    fact: DataFrame, dim: DataFrame, natural_key: str, date_col: str, how: str = "inner", spread: int = 8
) -> DataFrame:
    """Join each row to the version in force on its date; days before the first version belong to it.

    Versions and rows are one stream per id, in order of their dates, along which the
    last version seen is carried forward: each side is scanned, shuffled and sorted once, however
    many versions an id has. The rows of an id are dealt over ``spread`` such streams, each with all versions of it, so
    that an id with a third of all rows is not one task's. Rows without an id or date, with an
    unknown id, or on a day that no version covers have no version (``how`` = ``left``) or go.
    """
    row = F.struct(*[F.col(c) for c in fact.columns])
    version = F.struct(*[F.col(c) for c in dim.columns])
    salt = F.xxhash64(*fact.columns)
    # Rows without an id meet nothing and can be dealt over as many streams as there are rows.
    stream = F.when(F.col(natural_key).isNull(), salt).otherwise(F.pmod(salt, F.lit(spread)))
    rows = fact.select(
        F.col(natural_key).alias("_id"), stream.alias("_stream"), F.col(date_col).alias("_date"), F.lit(1).alias("_kind"),
        F.lit(None).cast(dim.schema).alias("_version"), row.alias("_row"),
    )
    versions = dim.where(F.col(natural_key).isNotNull()).select(
        F.col(natural_key).alias("_id"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("_stream"),
        F.col("start_date").alias("_date"), F.lit(0).alias("_kind"),
        version.alias("_version"), F.lit(None).cast(fact.schema).alias("_row"),
    )
    along = Window.partitionBy("_id", "_stream").orderBy("_date", "_kind")
    first = F.first("_version", True).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    held = F.coalesce(F.last("_version", True).over(along), first)
    found = versions.unionByName(rows).withColumn("_held", held).where("_kind = 1")
    covers = F.col("_id").isNotNull() & (F.col("_date") <= F.col("_held.end_date"))
    if how == "inner":
        found = found.where(covers)
    added = [F.when(covers, F.col(f"_held.{c}")).alias(c) for c in dim.columns if c not in fact.columns]
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in fact.columns], *added)
