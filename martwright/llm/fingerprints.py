"""Threshold-scaled sketches: of a text's shingle hashes, all below a fixed fraction of the range of hashes.

Which hashes are retained depends on nothing but the hashes, so the sketch of two texts together is the union of theirs, and the
share of a sketch found in another estimates the share of the text, however unequal the two are. All of
it is built-in functions; a document meets its neighbour by a shuffle into blocks of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SHINGLE, let, saved, words

#: One hash in so many is retained.
ONE_IN = 4
#: Hexadecimal digits of a hash (of MD5's 32).
DIGITS = 16
#: Ids of a block: not more than 2^BLOCK_BITS to begin with, wider if the widest then holds no more than BLOCK_ROWS rows.
BLOCK_BITS = 10
BLOCK_ROWS = 2048
#: Blocks that are put in order together.
ZONE_BITS = 12
_NO_ID = -(1 << 63)


def shingle_digests(text: Column) -> Column:
    """The MD5 prefixes of all runs of five words, as hexadecimal text; of fewer words, of their only run."""

    def runs(w: Column) -> Column:
        count = F.greatest(F.size(w) - (SHINGLE - 1), F.least(F.size(w), F.lit(1)))
        return F.transform(
            F.slice(w, F.lit(1), count),
            lambda _, at: F.substring(F.md5(F.array_join(F.slice(w, at + 1, F.lit(SHINGLE)), " ").cast("binary")), 1, DIGITS),
        )

    return let(words(text), runs)


def sketch(text: Column, one_in: int = ONE_IN) -> Column:
    """The sorted distinct digests below one part in ``one_in`` of their range.

    A text that has words but no such digest keeps its least one, which is above that part and so known for what it is;
    null and empty texts have none.
    """
    below = f"{(1 << 4 * DIGITS) // one_in:0{DIGITS}x}" if one_in > 1 else "g"

    def retained(all_: Column) -> Column:
        def kept(low: Column) -> Column:
            least = F.filter(F.array(F.array_min(all_)), lambda d: d.isNotNull())
            return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).otherwise(least)

        return let(F.filter(all_, lambda d: d < below), kept)

    return let(shingle_digests(text), retained)


def merged(one: Column, other: Column, one_in: int = ONE_IN) -> Column:
    """The sketch of two texts together (but for shingles over their border): what both retain, or else the least digest."""
    below = f"{(1 << 4 * DIGITS) // one_in:0{DIGITS}x}" if one_in > 1 else "g"

    def kept(all_: Column) -> Column:
        low = F.filter(all_, lambda d: d < below)
        return F.when(F.size(low) > 0, low).otherwise(F.slice(all_, 1, 1))

    return let(F.array_sort(F.array_union(one, other)), kept)


def contained(one: Column, other: Column) -> Column:
    """The share of ``one`` found in ``other``; 1 if both are empty, 0 if only one is."""
    return F.when(F.size(one) > 0, F.size(F.array_intersect(one, other)) / F.size(one)).otherwise(
        (F.size(other) == 0).cast("double")
    )


def likeness(one: Column, other: Column) -> Column:
    """How much of the smaller sketch the larger one holds: 0 to 1; 1 if both are empty, 0 if only one is."""
    smaller = F.least(F.size(one), F.size(other))
    return F.when(smaller > 0, F.size(F.array_intersect(one, other)) / smaller).otherwise(
        (F.size(one) == F.size(other)).cast("double")
    )


def as_text(digests: Column) -> Column:
    return F.array_join(digests, "")


def _following(keys: DataFrame, low: int, high: int) -> DataFrame:
    """``key, next`` of the distinct ``keys`` from ``low`` to ``high``, by zones of neighbours; null behind the last."""
    last = high - low < 1 << ZONE_BITS
    zoned = keys.withColumn("zone", F.lit(0) if last else F.shiftright("key", ZONE_BITS))
    rows = zoned.withColumn("next", F.lead("key").over(Window.partitionBy("zone").orderBy("key")))
    if last:
        return rows.select("key", "next")
    firsts = saved(zoned.groupBy("zone").agg(F.min("key").alias("first")), "zones")
    zones = _following(firsts.select(F.col("zone").alias("key")), low >> ZONE_BITS, high >> ZONE_BITS)
    behind = zones.join(firsts.select(F.col("zone").alias("next"), "first"), "next", "left")
    return rows.join(behind.select(F.col("key").alias("zone"), "first"), "zone", "left").select(
        "key", F.coalesce("next", "first").alias("next")
    )


def _bits(ids: DataFrame) -> int:
    """The widest blocks of ids that hold BLOCK_ROWS rows at most; the narrowest ones if none do."""
    counts = ids.filter("doc_id is not null").groupBy(F.shiftright("doc_id", BLOCK_BITS).alias("block")).count()
    widths = F.array(
        *(F.struct(F.lit(w).alias("bits"), F.shiftright("block", w - BLOCK_BITS).alias("wide")) for w in range(BLOCK_BITS, 62, 3))
    )
    sizes = (
        counts.select(F.explode(widths).alias("w"), "count")
        .groupBy("w.bits", "w.wide")
        .agg(F.sum("count").alias("rows"))
        .groupBy("bits")
        .agg(F.max("rows").alias("most"))
    )
    return max([r.bits for r in sizes.collect() if r.most <= BLOCK_ROWS], default=BLOCK_BITS)


def with_next(docs: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, text``, columns worked out from the text (``extra``), and ``next``, a struct of text and those of the next row.

    Rows follow each other by doc_id, then text, nulls first; the first row follows the last, and an only row
    itself. Texts are shuffled once, by blocks of neighbouring ids; a block's last row gets the first of the next block by a join.
    A doc_id that many rows share makes one block, which Spark sorts on disk.
    """
    extra = extra or {}
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bits = _bits(docs)
    block = F.coalesce(F.shiftright("doc_id", bits), F.lit(_NO_ID))
    blocks = saved(docs.groupBy(block.alias("block")).agg(F.min("doc_id").alias("first")), "blocks")
    low, high = blocks.agg(F.min("block"), F.max("block")).first()
    if low is None:
        low = high = 0
    order = _following(blocks.select(F.col("block").alias("key")), low, high)
    heads = saved(
        docs.alias("d")
        .join(blocks, F.col("d.doc_id").eqNullSafe(F.col("first")))
        .groupBy("block")
        .agg(F.min("text").alias("text"))
        .join(order.select(F.col("key"), F.coalesce("next", F.lit(low)).alias("block")), "block")
        .select(F.col("key").alias("block"), "text"),
        "heads",
    )
    known = ["text", *extra]
    head = heads.withColumns(extra).select("block", F.struct(*known).alias("head"))
    rows = docs.withColumn("block", block).repartition("block").withColumns(extra)
    within = F.lead(F.struct(*known)).over(Window.partitionBy("block").orderBy("doc_id", "text"))
    led = rows.withColumn("next", within).join(head, "block", "left")
    return led.select("doc_id", *known, F.coalesce("next", "head").alias("next"))


def fingerprints(docs: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """The sketch of every row of ``docs (doc_id, text)``, of its edited text, and how much they and the next row's have in common.

    ``doc_id, n_chars, edited, digests, edited_digests, near_edited, near_next``. The edited text has its last
    ``floor(n_chars / 2)`` characters replaced by the first as many (or all) of the next row's text.

    Null texts are empty; texts without words have an empty sketch. Rows are ordered by doc_id, then text, null ids first;
    equal rows follow one another. The first row follows the last, an only row itself; an empty table gives no row; other
    columns are ignored.
    """
    rows = with_next(docs, {"digests": sketch(F.col("text"), one_in)})
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), chars - half), F.col("next.text").substr(F.lit(1), half))
    out = rows.select(
        "doc_id", chars.cast("long").alias("n_chars"), "digests", F.col("next.digests").alias("_next"), edited.alias("edited")
    ).withColumn("edited_digests", sketch(F.col("edited"), one_in))
    return out.select(
        "doc_id",
        "n_chars",
        "edited",
        "digests",
        "edited_digests",
        likeness(F.col("digests"), F.col("edited_digests")).alias("near_edited"),
        likeness(F.col("digests"), F.col("_next")).alias("near_next"),
    )
