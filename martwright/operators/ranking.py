"""Top-k by rank with ties, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_with_ties(df: DataFrame, value: str, k: int, rank_name: str) -> DataFrame:
    """Rows whose ``rank() over (order by value desc)`` is at most ``k``.

    The k best values come from a distributed top-k, and all rows above any of
    them are among them, so ranking just those k values gives every true rank.
    However many rows tie, they are picked by a join with at most k values and
    never gathered in one task.
    """
    best = df.select(F.col(value).alias("_best")).orderBy(F.desc_nulls_first("_best")).limit(k)
    ranked = best.select("_best", F.rank().over(Window.orderBy(F.desc_nulls_first("_best"))).alias(rank_name))
    cut = ranked.groupBy("_best").agg(F.min(rank_name).alias(rank_name))
    return df.join(cut, F.col(value).eqNullSafe(F.col("_best"))).select(rank_name, *df.columns)
