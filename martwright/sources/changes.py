"""Late deliveries to source tables: corrected rows and new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def apply_corrections(base: DataFrame, changes: DataFrame, pk: list[str]) -> DataFrame:
    """Rows of ``changes`` take the place of the rows of ``base`` with the same key."""
    kept = base.join(changes.select(*pk), pk, "left_anti")
    return kept.select(base.columns).unionByName(changes.select(base.columns))


def append_delta(base: DataFrame, new: DataFrame) -> DataFrame:
    return base.unionByName(new.select(base.columns))
