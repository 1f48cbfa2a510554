"""Rows counted and fingerprinted whatever their order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contents:
    """Which columns of which rows a table is compared by."""

    columns: tuple[str, ...]
    where: str = "true"

    def rows(self) -> Column:
        return F.count_if(F.expr(self.where))

    def fingerprint(self) -> Column:
        """The sum of the rows' 64-bit hashes: equal for equal rows in any order, repeated ones counted, and 0 for none.

        Values are hashed as text, so that types of different width compare; NULL is told from every text and place.
        """
        values = [f(F.col(c)) for c in self.columns for f in (F.isnull, lambda c: c.cast("string"))]
        summed = F.sum(F.when(F.expr(self.where), F.xxhash64(*values).cast("decimal(20,0)")))
        return F.coalesce(summed, F.lit(0)).cast("decimal(38,0)")
