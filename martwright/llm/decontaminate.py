"""Benchmark items inside documents: size-partitioned MinHash containment search, verified on whole shingles.

Items are partitioned by size, in powers of two. The sketch of an item is the least hashes of its shingles, as many as
its partition needs: one document may lack a fifth of an item's shingles and still contain it, so a sketch of
that fifth of the partition's largest size, and SPARE more, has SPARE hashes in every document that does. The sketches
are looked up among the hashes of each document, however long it is, and pairs with fewer hits than
that are dropped; so no contained item is missed. The rest are compared shingle by shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import expect_skew
from .common import SHINGLE, SIMILARITY_PERCENT, let, saved, shingle_hashes, words

#: Hits asked for beyond what an item may lack.
SPARE = 3


def shingles(text: Column) -> Column:
    """The distinct runs of five words themselves; of fewer words, their only run."""

    def runs(w: Column) -> Column:
        count = F.greatest(F.size(w) - (SHINGLE - 1), F.least(F.size(w), F.lit(1)))
        return F.transform(
            F.slice(w, F.lit(1), count), lambda _, at: F.array_join(F.slice(w, at + 1, F.lit(SHINGLE)), " ")
        )

    return F.array_distinct(let(words(text), runs))


def _may_lack(n: Column, percent: int) -> Column:
    return F.floor((100 - percent) * n / 100.0 + 1e-9)


def _sketches(items: DataFrame, percent: int) -> DataFrame:
    """``hash, key, need``: the sketch of every item, and how many of its hashes a document needs."""
    largest = F.pow(F.lit(2.0), F.ceil(F.log2("n")))
    length = F.least(F.col("n"), _may_lack(largest, percent) + SPARE).cast("int")
    sized = items.withColumn("length", length)
    return sized.select(
        F.explode(F.slice(F.array_sort("hashes"), F.lit(1), F.col("length"))).alias("hash"),
        "key",
        (F.col("length") - _may_lack(F.col("n"), percent)).alias("need"),
    )


def contained_items(docs: DataFrame, items: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``doc_id, text_hash, item_id, n_item_shingles, n_shared`` for every document that contains an item.

    ``docs (doc_id, text)`` contain an item of ``items (item_id, text)`` if they hold ``percent`` of its distinct
    shingles or more. Items with equal shingles are one, named by the least item_id, or null if none has one, and are
    found with or without a name; items without words are in no
    document, and an item of fewer than five words is only in documents of the same words. Null texts have no
    words. Rows that share a doc_id are searched each by itself, equal rows are reported once, null ids stay null.
    Empty tables give no row; other columns are ignored.

    Sketches are broadcast only if their written size allows it; a hash or item that a third of all documents
    hold is one row on that side, and the other side is split where it is skewed.
    """
    expect_skew(docs.sparkSession)
    hashed = (
        items.select("item_id", "text", shingle_hashes(F.col("text")).alias("hashes"))
        .withColumn("n", F.size("hashes"))
        .filter("n > 0")
    )
    alike = F.array_sort("hashes")
    known = saved(
        hashed.groupBy(alike.alias("hashes"), "n").agg(F.min(F.struct(F.col("item_id").isNull().alias("none"), "item_id", "text")).alias("item"))
        .select(F.xxhash64("hashes").alias("key"), "item.item_id", "item.text", "n", "hashes"),
        "items",
    )
    sketches = saved(_sketches(known, percent), "sketches")
    held = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(shingle_hashes(F.col("text"))).alias("hash"))
    candidates = saved(
        held.join(sketches, "hash")
        .groupBy("doc_id", "text_hash", "key", "need")
        .agg(F.count(F.lit(1)).alias("hits"))
        .filter("hits >= need")
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "key"),
        "candidates",
    )
    whole = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        .join(candidates, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
        .join(known.select("key", "item_id", F.col("text").alias("item_text")), "key")
    )
    wanted = shingles(F.col("item_text"))
    counted = whole.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.size(wanted).cast("long").alias("n_item_shingles"),
        F.size(F.array_intersect(wanted, shingles(F.col("text")))).cast("long").alias("n_shared"),
    )
    return counted.filter(100 * F.col("n_shared") >= percent * F.col("n_item_shingles")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``docs`` without the rows that contain an item; all their columns."""
    found = saved(contained_items(docs, items, percent).select("doc_id", "text_hash").distinct(), "contaminated")
    gone = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
    keyed = docs.withColumns({"__id0": F.col("doc_id"), "__text0": F.xxhash64("text")})
    same = F.col("__id0").eqNullSafe(F.col("__id")) & (F.col("__text0") == F.col("__text"))
    return keyed.join(gone, same, "left_anti").select(docs.columns)
