"""Integrity checks that report violations as rows instead of aborting a load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contents import Contents


def duplicate_keys(df: DataFrame, pk: list[str]) -> DataFrame:
    """Key values held by more than one row, with their row count.

    Keys hardly repeat and, as numbers in a row, compress to a fraction of what a task needs to count them. Combined
    before the shuffle they would only fill memory, and adaptive execution, which sees compressed sizes, would merge
    partitions into tasks of gigabytes: so rows go, not combined, to as many partitions as the session has.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*pk).repartition(partitions, *pk).groupBy(*pk).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_count) for every named column, in one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).alias("k")) for c in columns]))
    return counts.select(pairs.alias("p")).select(
        F.col("p.n").alias("column_name"), F.col("p.k").alias("null_count")
    )


def orphan_rows(child: DataFrame, parent: DataFrame, on: str, parent_column: str | None = None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    keys = parent.select(F.col(parent_column or on).alias(on))
    return child.where(F.col(on).isNotNull()).join(keys, on, "left_anti").select(child.columns)


def orphan_count(child: DataFrame, parent: DataFrame, on: str, parent_column: str | None = None) -> DataFrame:
    """(orphans): how many rows ``orphan_rows`` has. References are counted before they meet the parents."""
    keys = parent.select(F.col(parent_column or on).alias(on))
    used = child.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    return used.join(keys, on, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def cascade_delete(child: DataFrame, deleted: DataFrame, on: str) -> DataFrame:
    """What is left of ``child`` once the given parents are gone."""
    return child.join(deleted.select(on), on, "left_anti").select(child.columns)


def cascade_delete_all(
    tables: Mapping[str, DataFrame],
    foreign_keys: list[tuple[str, str, str, str]],
    parent: str,
    key: str,
    deleted: DataFrame,
) -> dict[str, DataFrame]:
    """What is left of ``parent`` and of every table below it once the rows of ``parent`` whose ``key`` ``deleted`` holds are gone.

    ``foreign_keys`` (child, column, parent, its column) are followed level by level, from lines of orders to
    orders of customers; a row goes with any of the rows it refers to, and one that refers to nothing (NULL) stays. A
    table that refers to itself, or two that refer to each other, cannot be followed and raise.
    """
    below, reached = [parent], {parent}
    while more := {child for child, _, above, _ in foreign_keys if above in reached} - reached:
        reached |= more
    links = [link for link in foreign_keys if link[2] in reached]
    if any(child in (above, parent) for child, _, above, _ in links):
        raise ValueError(f"foreign keys go in circles among {sorted(reached)}")
    while len(below) < len(reached):
        ready = [t for t in sorted(reached - {*below}) if all(above in below for child, _, above, _ in links if child == t)]
        if not ready:
            raise ValueError(f"foreign keys go in circles among {sorted(reached - {*below})}")
        below += ready
    gone = {parent: tables[parent].join(deleted.select(key), key, "left_semi")}
    left = {parent: tables[parent].join(deleted.select(key), key, "left_anti").select(tables[parent].columns)}
    for table in below[1:]:
        rows = tables[table]
        doomed = []
        for _, column, above, its_column in (link for link in links if link[0] == table):
            keys = gone[above].select(F.col(its_column).alias(column))
            doomed.append(tables[table].join(keys, column, "left_semi").select(rows.columns))
            rows = rows.join(keys, column, "left_anti").select(rows.columns)
        gone[table], left[table] = reduce(DataFrame.unionByName, doomed), rows
    return left


def reconcile_counts(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table_name, expected_rows, actual_rows) for pairs of (source, loaded) frames."""

    def count(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))

    rows = [
        count(loaded).select(
            F.lit(name).alias("table_name"),
            count(source).scalar().alias("expected_rows"),
            F.col("n").alias("actual_rows"),
        )
        for name, (source, loaded) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).withColumn(
        "matches", F.when(F.col("expected_rows") == F.col("actual_rows"), "Y").otherwise("N")
    )


def reconcile_contents(tables: dict[str, tuple[DataFrame, Contents, tuple[int, int]]]) -> DataFrame:
    """(table_name, expected_rows, actual_rows, same_contents) of sources and what was observed when their targets were written.

    Each table has its source, what of the source the target must hold, and the target's rows and
    fingerprint (``published_contents``). The target is not read; the source is scanned once. Contents are the same if
    the same rows, however ordered, occur equally often.
    """
    rows = [
        source.agg(wanted.rows().alias("expected_rows"), wanted.fingerprint().alias("wanted")).select(
            F.lit(name).alias("table_name"),
            "expected_rows",
            F.lit(actual_rows).cast("bigint").alias("actual_rows"),
            F.when(
                (F.col("expected_rows") == actual_rows)
                & (F.col("wanted") == F.lit(str(fingerprint)).cast("decimal(38,0)")),
                "Y",
            )
            .otherwise("N")
            .alias("same_contents"),
        )
        for name, (source, wanted, (actual_rows, fingerprint)) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def width_violations(df: DataFrame, limits: dict[str, int | tuple[int, int]]) -> DataFrame:
    """(column_name, violations) against text widths and (precision, scale) limits, in one pass."""

    def broken(name: str, limit: int | tuple[int, int]):
        if isinstance(limit, int):
            return F.length(name) > limit
        precision, scale = limit
        return F.abs(name) >= F.lit(10 ** (precision - scale))

    flags = [F.count_if(broken(c, limit)).alias(c) for c, limit in limits.items()]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).alias("k")) for c in limits]))
    return (
        df.agg(*flags)
        .select(pairs.alias("p"))
        .select(F.col("p.n").alias("column_name"), F.col("p.k").alias("violations"))
    )
