"""Lines that many documents share: explode, hash, count documents per hash, drop, put together by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, saved

MIN_DOCUMENTS = 10


def line_key(line: Column) -> Column:
    """The line without outer blanks, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hash(key: Column) -> list[Column]:
    """128 bits, as two longs."""
    return [F.xxhash64(key).alias("__h1"), F.xxhash64(F.lit(1), key).alias("__h2")]


def line_dedup(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` without the lines found in ``min_documents`` rows or more; ``n_lines`` and ``n_dropped`` are added.

    Lines are compared by key (outer blanks stripped, A-Z lower-cased); empty keys are never dropped. A null or empty
    text is one empty line, and comes back as an empty text. Every row counts as a document, repeated rows
    too; rows may share a doc_id or have none. All columns come back, in place; existing columns called n_lines or
    n_dropped are replaced.

    Rows shuffled: one hash per distinct line of a document to count (combined before the shuffle), and, unless
    the dropped hashes are few enough to broadcast, one per line to drop; then dropped positions meet their
    document. A line that is everywhere is a single pre-aggregated key, and the join splits it if it is skewed.
    """
    own = [F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text")]
    lines = docs.select(*own, F.posexplode(_lines(F.col("text"))).alias("__at", "__line"))
    keyed = lines.select("__id", "__text", "__at", line_key(F.col("__line")).alias("__key")).filter(
        F.length("__key") > 0
    )
    hashed = keyed.select("__id", "__text", "__at", *_hash(F.col("__key")))

    def distinct_hashes(text: Column) -> Column:
        keys = F.transform(_lines(text), lambda x: line_key(x))
        pair = F.transform(F.filter(keys, lambda k: F.length(k) > 0), lambda k: F.struct(*_hash(k)))
        return F.array_distinct(pair)

    counted = docs.select(F.inline(distinct_hashes(F.col("text")))).groupBy("__h1", "__h2").count()
    common = saved(counted.filter(F.col("count") >= min_documents).select("__h1", "__h2"), "lines")
    dropped = (
        hashed.join(common, ["__h1", "__h2"], "left_semi")
        .groupBy("__id", "__text")
        .agg(F.collect_set("__at").alias("__drop"))
    )
    joined = docs.withColumns({"__id0": F.col("doc_id"), "__text0": F.xxhash64("text"), "__all": _lines(F.col("text"))}).join(
        dropped, F.col("__id0").eqNullSafe(F.col("__id")) & (F.col("__text0") == F.col("__text")), "left"
    )
    total = F.size("__all")
    kept = F.array_except(F.sequence(F.lit(0), total - 1), F.col("__drop"))
    text = F.when(F.col("__drop").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda at: F.get(F.col("__all"), at)), "\n")
    )
    out = joined.withColumns(
        {
            "text": text,
            "n_lines": total.cast("long"),
            "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
        }
    )
    return out.drop("__id0", "__text0", "__all", "__id", "__text", "__drop")
