"""Near copies by exact Jaccard similarity of word shingles, with a token-group matrix.

1. Every text becomes its set of shingle hashes. Equal sets are one node from here on, however many rows hold them.
2. Sets are ordered by one global order, rare hashes first, and each keeps its prefix: so few hashes that two sets
   over the threshold share one of them at least.
3. Groups of similar documents: each node is compared with the pivots of its prefix hashes (of a hash's list, the most
   typical node, whose hashes are the most frequent, and the least) that share most, and joined to those it truly
   resembles. That is linear in the lists; a group of any number of copies costs one comparison or two per node.
   Where hashes are still shared by several groups, nodes are compared once more with the hubs of their hashes: of
   nodes about as large, in groups of their own, those that share most of their prefix with others. So copies that only
   resemble one of them, and not each other, are one group before any pair of them is looked at.
4. The token-group matrix holds, for each group and band of sizes, the prefix hashes of its members and the range of
   their sizes. The hashes a node finds there bound its overlap with any member, so only a few groups of other documents
   qualify. Nodes meet the matrix by hash and band, never by the hash alone.
5. Those are opened: the node meets the members that hold one of its rarest hashes there, so many that no member over
   the bound lacks them all. Where more bits of two sketches differ than hashes of similar sets can, the two do not
   meet; the bound of step 4 cuts single pairs, and what is left is compared in full. All links together give the
   components.

Nothing is skipped: a link between two groups is always found by step 5. Hashes have 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import expect_skew
from .common import SIMILARITY_PERCENT, components, saved, ship
from .shingles import WordTable, shingle_set

#: Counters by which hashes are ordered; their number bounds what is broadcast (4 bytes each).
BUCKET_BITS = 20
CHUNK_BITS = 12
#: Bits of a sketch: bit k says whether the number of a set's hashes whose last bits are k is odd.
SKETCH_BITS = 256
_SKETCH = [f"s{k}" for k in range(SKETCH_BITS // 64)]
#: Rows of one hash that stay together; longer lists are split and joined by their pivots.
LIST_ROWS = 50_000
#: Pivots a node is compared with.
PIVOTS = 2
#: Hubs of a hash and band of sizes that are offered to its nodes, each of another group.
HUBS = 4


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )


def _node(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _sketch(found: np.ndarray) -> np.ndarray:
    odd = np.bincount((found & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _needed(n: int, percent: int) -> int:
    """The least overlap of a set of ``n`` with any set over the threshold."""
    return -(-percent * n // 100)


_DESCRIBED = "doc_id string, text_hash long, n long, node long, {}, part long, chunk long, counts binary".format(
    ", ".join(f"{s} long" for s in _SKETCH)
)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size, node and sketch of every row, then what this task counted per bucket of hashes, in chunks."""
    table, counts = WordTable(), np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        sets = [shingle_set(text, table) for text in batch["text"]]
        if sets:
            counts += np.bincount(_bucket(np.concatenate(sets)), minlength=len(counts))
        sketches = np.array([_sketch(s) for s in sets], np.int64).reshape(-1, len(_SKETCH))
        yield batch[["doc_id", "text_hash"]].assign(
            n=[len(s) for s in sets],
            node=[_node(s) for s in sets],
            **dict(zip(_SKETCH, sketches.T)),
            part=-1,
            chunk=-1,
            counts=None,
        )
    parts = counts.reshape(-1, 1 << CHUNK_BITS)
    used = np.flatnonzero(parts.any(axis=1))
    yield pd.DataFrame(
        {
            "doc_id": None,
            "text_hash": 0,
            "n": 0,
            "node": 0,
            **dict.fromkeys(_SKETCH, 0),
            "part": TaskContext.get().partitionId(),
            "chunk": used,
            "counts": [parts[k].astype("<u4").tobytes() for k in used],
        }
    )


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    """The sum of the group's counts, each at most 32 bits."""
    total = sum(np.frombuffer(c, "<u4").astype(np.int64) for c in group["counts"])
    counts = np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()
    return pd.DataFrame({"part": group["part"][:1], "chunk": group["chunk"][:1], "counts": [counts]})


def _bucket_counts(described: DataFrame) -> np.ndarray:
    """How often each bucket of hashes occurs in the corpus; tasks are added up in groups of 64, then all."""
    parts = described.filter("chunk >= 0").select(F.floor(F.col("part") / 64).alias("part"), "chunk", "counts")
    for step in ("part", F.lit(0).cast("long").alias("part")):
        parts = (
            parts.select(step, "chunk", "counts")
            .groupBy("part", "chunk")
            .applyInPandas(_add_up, "part long, chunk long, counts binary")
        )
    out = np.zeros((1 << (BUCKET_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint32)
    for row in parts.select("chunk", "counts").collect():
        out[row["chunk"]] = np.frombuffer(row["counts"], "<u4")
    return out.reshape(-1)


def _prefixes(docs: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """``token, node, splits, typical``: the rarest hashes of every set, into how many lists the hash's rows are split,
    and how frequent the node's hashes are.

    A task gives each node once; other tasks may give it again.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, often, seen = WordTable(), shared.value, set()
        for batch in batches:
            tokens, nodes, splits, typical = [], [], [], []
            for text in batch["text"]:
                found = shingle_set(text, table)
                node = _node(found)
                if not len(found) or node in seen:
                    continue
                seen.add(node)
                count = often[_bucket(found)]
                length = len(found) - _needed(len(found), percent) + 1
                first = np.lexsort((found, count))[:length]
                tokens.append(found[first].view(np.int64))
                nodes.append(np.full(length, node, np.int64))
                splits.append(count[first] // LIST_ROWS + 1)
                typical.append(np.full(length, 1000 * np.log2(count[first]).mean(), np.int32))
            if tokens:
                yield pd.DataFrame(
                    {
                        "token": np.concatenate(tokens),
                        "node": np.concatenate(nodes),
                        "splits": np.concatenate(splits).astype(np.int32),
                        "typical": np.concatenate(typical),
                    }
                )

    return _texts(docs).mapInPandas(work, "token long, node long, splits int, typical int")


def _fewest_shared(a: Column, b: Column, percent: int) -> Column:
    """The least number of prefix hashes that sets of sizes ``a`` and ``b`` over the threshold share.

    Their overlap is at least percent/(100+percent) of both sizes together. Behind the prefix that ends first,
    a set has one hash less than the overlap it needs; what remains must be shared within the prefixes.
    """
    overlap = F.ceil(percent * (a + b) / (100 + percent) - 1e-9)
    behind = F.ceil(percent * F.greatest(a, b) / 100.0 - 1e-9) - 1
    return F.greatest(overlap - behind, F.lit(1))


def _fewest_in(n: Column, low: Column, high: Column, percent: int) -> Column:
    """The least of ``_fewest_shared(n, m)`` over all sizes ``m`` from ``low`` to ``high``.

    Up to ``n`` it never falls. Above, it falls in steps whose two roundings can leave it one less a few sizes
    before ``high`` than at ``high`` itself, so those sizes are asked too.
    """
    steps = range(1, 200 * (100 + percent) // percent**2 + 1)
    dips = [d for d in steps if percent * d // 100 < -(-percent * d // (100 + percent))]
    sizes = [low, high, *(F.greatest(high - d, low) for d in dips)]
    return F.least(*(_fewest_shared(n, m, percent) for m in sizes))


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _may_fit(of_a: list[Column], of_b: list[Column], a: Column, b: Column, percent: int) -> Column:
    """Whether sketches of sets of sizes ``a`` and ``b`` differ in no more bits than the sets may differ in hashes."""
    differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(of_a, of_b)), F.lit(0))
    return differ <= a + b - 2 * F.ceil(percent * (a + b) / (100 + percent) - 1e-9)


def _band(n: Column, percent: int) -> Column:
    """A number that differs by one at most between sets whose sizes fit.

    Bands are a little wider than the widest fitting ratio, so rounding can not part two fitting sizes by two bands.
    """
    return F.floor(F.log(n) / (1.001 * math.log(100 / percent))).cast("int")


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One compressed text per node and task."""
    table, press, seen = WordTable(), zstandard.ZstdCompressor(level=1), set()
    for batch in batches:
        nodes, blobs = [], []
        for text in batch["text"]:
            node = _node(shingle_set(text, table))
            if node not in seen:
                seen.add(node)
                nodes.append(node)
                blobs.append(press.compress(text or b""))
        yield pd.DataFrame({"node": nodes, "blob": blobs})


def _compare(percent: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, press = WordTable(), zstandard.ZstdDecompressor()
        last: tuple[int, np.ndarray] | None = None  # pairs arrive by b, so a popular b is unpacked once
        for batch in batches:
            keep = []
            for a, b, blob_a, blob_b in zip(batch["a"], batch["b"], batch["blob_a"], batch["blob_b"]):
                left = shingle_set(press.decompress(blob_a), table)
                if last is None or last[0] != b:
                    last = (b, shingle_set(press.decompress(blob_b), table))
                right = last[1]
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.loc[keep, ["a", "b"]]

    return work


def _verified(pairs: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose sets are similar enough, by the whole sets."""
    left = pairs.join(blobs.select(F.col("node").alias("a"), F.col("blob").alias("blob_a")), "a")
    both = left.join(blobs.select(F.col("node").alias("b"), F.col("blob").alias("blob_b")), "b")
    return both.select("a", "b", "blob_a", "blob_b").mapInPandas(_compare(percent), "a long, b long")


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the group of their node; a node without links is its own."""
    return rows.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _groups(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("id").alias("node"), F.col("component").alias("group"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The ``rows`` of tokens that nodes of several groups hold."""
    tokens = rows.groupBy("token").agg(F.min("group").alias("g"), F.max("group").alias("h")).filter("g != h")
    return rows.join(tokens, "token", "left_semi")


def _with_hubs(rows: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes with hubs of other groups, at most ``PIVOTS`` for each node, none of them in ``tried``.

    A list of one token holds about ``LIST_ROWS`` rows, which bounds what is gathered for it.
    """
    weighed = rows.withColumn("weight", F.count(F.lit(1)).over(Window.partitionBy("node")))
    place = ["token", "list", "band"]
    hubs = (
        weighed.groupBy(*place, "group")
        .agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
        .groupBy(*place)
        .agg(F.sort_array(F.collect_list(F.struct("hub", "group")), asc=False).alias("hubs"))
        .filter(F.size("hubs") > 1)
        .select(*place, F.slice("hubs", 1, HUBS).alias("hubs"))
    )
    offered = (
        weighed.join(hubs, place)
        .select(F.col("node").alias("a"), "n", "group", F.explode("hubs").alias("to"))
        .filter(F.col("group") != F.col("to.group"))
        .select("a", "n", F.col("to.hub.node").alias("b"), F.col("to.hub.n").alias("m"))
        .filter(_sizes_fit(F.col("n"), F.col("m"), percent))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("n"), F.first("m").alias("m"))
        .filter(F.col("common") >= _fewest_shared(F.col("n"), F.col("m"), percent))
        .join(tried, ["a", "b"], "left_anti")
    )
    best = Window.partitionBy("a").orderBy(F.desc("common"), "b")
    return offered.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= PIVOTS).select("a", "b")


def similarity_groups(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(members, groups)``: ``doc_id, text_hash, n, node`` of every row; ``node, place`` of the nodes that have links.

    Nodes are connected by links if they have one place; that of a node without links is itself.
    """
    expect_skew(docs.sparkSession)
    ship(docs.sparkSession)
    described = saved(_texts(docs).mapInPandas(_describe, _DESCRIBED), "described")
    members = described.filter("chunk < 0").select(F.col("doc_id").cast("long").alias("doc_id"), "text_hash", "n", "node")
    found = described.filter("chunk < 0 and n > 0").groupBy("node")
    nodes = saved(found.agg(F.max("n").alias("n"), *(F.max(s).alias(s) for s in _SKETCH)), "nodes")
    sizes = nodes.select("node", "n")
    counts = _bucket_counts(described)

    listed = Window.partitionBy("token", "list")
    lists = (
        _prefixes(docs, counts, percent)
        .withColumn("list", F.pmod("node", "splits"))
        .withColumns(
            {
                "least": F.min("node").over(listed),
                "most": F.max("node").over(listed),
                "pivot": F.max(F.struct("typical", "node")).over(listed)["node"],
            }
        )
    )
    shared = saved(
        lists.filter("least != most or splits > 1").select("token", "list", "splits", "node", "least", "pivot").distinct(),
        "lists",
    )

    # Groups of similar documents, by comparison with pivots.
    parted = shared.filter("splits > 1")
    over_parts = (
        parted.select("token", F.col("pivot").alias("node"))
        .distinct()
        .join(parted.groupBy("token").agg(F.min("pivot").alias("pivot")), "token")
        .select("node", "pivot")
    )
    to_pivot = (
        shared.select("node", F.explode(F.array_distinct(F.array("least", "pivot"))).alias("pivot"))
        .union(over_parts)
        .filter("node != pivot")
        .groupBy("node", "pivot")
        .agg(F.count(F.lit(1)).alias("common"))
    )
    sized = (
        to_pivot.join(sizes, "node")
        .join(sizes.select(F.col("node").alias("pivot"), F.col("n").alias("m")), "pivot")
        .filter(_sizes_fit(F.col("n"), F.col("m"), percent))
        .filter(F.col("common") >= _fewest_shared(F.col("n"), F.col("m"), percent))
    )
    best = Window.partitionBy("node").orderBy(F.desc("common"), "pivot")
    tried = saved(
        sized.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= PIVOTS)
        .select(F.col("node").alias("a"), F.col("pivot").alias("b")),
        "tried",
    )
    alike = shared.select("node").distinct()
    blobs = saved(
        _texts(docs)
        .mapInPandas(_pack, "node long, blob binary")
        .join(alike, "node", "left_semi")
        .dropDuplicates(["node"]),
        "blobs",
    )
    near = saved(_verified(tried, blobs, percent), "links")

    # Once more, with the hubs of hashes that several groups share.
    placed = saved(
        shared.select("token", "list", "node").join(nodes, "node").withColumn("band", _band(F.col("n"), percent)), "placed"
    )
    unsketched = placed.drop(*_SKETCH)
    to_hub = saved(_with_hubs(_mixed(_grouped(unsketched, _groups(near))), tried, percent), "tried")
    near = saved(near.union(_verified(to_hub, blobs, percent)), "links")
    first = _groups(near)

    # The token-group matrix, and the groups that a node's hashes let it open.
    rows = saved(_mixed(_grouped(placed.drop("list"), first)), "mixed")
    matrix = rows.groupBy("token", F.col("group").alias("other"), F.col("band").alias("of_band")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("held")
    )
    bands = F.explode(F.array(*(F.col("of_band") + k for k in (-1, 0, 1)))).alias("band")
    reach = (
        rows.join(matrix.select("*", bands), ["token", "band"])
        .filter("group > other")
        .filter((100 * F.col("high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("low")))
        .groupBy("node", "n", "other", "of_band")
        .agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.array_sort(F.collect_list(F.struct("held", "token"))).alias("common"),
        )
    )
    n = F.col("n")
    low = F.greatest("low", F.ceil(percent * n / 100.0 - 1e-9))
    high = F.least("high", F.floor(100.0 * n / percent + 1e-9))
    bound = _fewest_in(n, low, high, percent)
    # A member that shares ``bound`` of the common hashes has one of any that many less one left out.
    spare = (F.size("common") - bound + 1).cast("int")
    qualifying = saved(
        reach.withColumn("spare", spare)
        .filter("spare > 0")
        .select("node", "n", "other", "of_band", F.explode(F.slice("common", F.lit(1), F.col("spare"))["token"]).alias("token")),
        "qualifying",
    )
    members_of = rows.select(
        "token",
        F.col("node").alias("b"),
        F.col("n").alias("m"),
        F.col("group").alias("other"),
        F.col("band").alias("of_band"),
        *(F.col(s).alias(f"b_{s}") for s in _SKETCH),
    )
    sketches = [[F.col(s) for s in _SKETCH], [F.col(f"b_{s}") for s in _SKETCH]]
    opened = (
        qualifying.join(nodes.select("node", *_SKETCH), "node")
        .join(members_of, ["token", "other", "of_band"])
        .filter(_sizes_fit(F.col("n"), F.col("m"), percent))
        .filter(_may_fit(*sketches, F.col("n"), F.col("m"), percent))
        .select(F.col("node").alias("a"), "b", "n", "m")
        .distinct()
    )
    held = saved(rows.groupBy("node").agg(F.collect_list("token").alias("tokens")), "held")
    pairs = (
        opened.join(held.select(F.col("node").alias("a"), F.col("tokens").alias("of_a")), "a")
        .join(held.select(F.col("node").alias("b"), F.col("tokens").alias("of_b")), "b")
        .filter(F.size(F.array_intersect("of_a", "of_b")) >= _fewest_shared(F.col("n"), F.col("m"), percent))
    )
    tried = saved(pairs.select("a", "b"), "tried")
    across = saved(_verified(tried, blobs, percent), "links")
    ends = [_grouped(across.select(F.col(end).alias("node"), "a", "b"), first).select("a", "b", F.col("group").alias(f"g{end}")) for end in "ab"]
    merged = components(ends[0].join(ends[1], ["a", "b"]).select(F.col("ga").alias("a"), F.col("gb").alias("b")).distinct())
    linked = first.select("node", "group").union(across.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(first, "node", "left_anti").select("node", F.col("node").alias("group")))
    places = linked.join(merged.withColumnRenamed("id", "group"), "group", "left")
    return members, saved(places.select("node", F.coalesce("component", "group").alias("place")), "places")


def _placed(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, place`` of every row; rows with words are linked if they have one place."""
    members, groups = similarity_groups(docs, percent)
    return members.join(groups, "node", "left").select("doc_id", "text_hash", "n", F.coalesce("place", "node").alias("place"))


def jaccard_components(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs (doc_id, text)``.

    ``component_id`` is the least doc_id that links reach. Rows with a null or wordless text have no shingles and
    link with nothing; rows with fewer than five words have one shingle. Rows with equal sets are linked, whatever
    their doc_id. A null doc_id stays null and never names a component that has another one. An empty
    table gives no row. Other columns are ignored.
    """
    placed = _placed(docs, percent)
    least = placed.filter("n > 0").groupBy("place").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "place", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id (rows without one come last).

    Rows without words stay; of rows with equal doc_id and text one stays. Columns are those of ``docs``.
    """
    placed = saved(_placed(docs, percent), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    kept = (
        placed.filter("n > 0")
        .groupBy("place")
        .agg(first)
        .select("first.doc_id", "first.text_hash")
        .union(placed.filter("n = 0").select("doc_id", "text_hash").distinct())
    )
    key = [F.coalesce("doc_id", F.lit(-(2**62))).alias("__id"), F.col("text_hash").alias("__text")]
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(-(2**62))), "__text": F.xxhash64("text")})
    return (
        keyed.join(kept.select(*key), ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"]).select(docs.columns)
    )
