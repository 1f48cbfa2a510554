"""Hard negatives by anchor-clustered shared lists, in the manner of MAXIMUS.

Anchors are clustered by direction. Every cluster has an angle within which all its anchors lie around its centre, so
``|c| * cos(max(0, angle(c, centre) - that angle))`` bounds the product of a candidate c with any anchor of the cluster
of length one. A shard of the candidates sorts itself by that bound once per cluster, and every anchor of the cluster walks that list,
a step of rows at a time, until the bound says that no row further on can enter its result.

The walk is done twice: for the best rows of an anchor's own label (its positives), and, when their scores have set the
bands, for the best rows of other labels in each band. Candidates are dealt over shards of bounded size, and anchors visit every
shard in blocks; a task holds one shard and one block. What shards find for an anchor is merged by a
window that keeps the first few rows before the shuffle already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, ship

#: Vectors are whole numbers after this factor.
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score in per cent of the positive's.
BAND = (30, 90)
#: Anchors whose directions the centres are learned from (those of the least hashes), and how many centres.
SAMPLE = 4096
CENTRES = 32
ROUNDS = 8
#: Candidates of a shard at most, and those it takes at least to make a shard of its own.
SHARD_ROWS = 131_072
LEAST_SHARD = 2_048
#: Anchors that walk together, and rows of the list between two looks at the bound.
BLOCK = 256
STEP = 1_024
#: Scores are exact as long as they stay below this.
EXACT = float(1 << 53)

_ROW = "kind int, cluster int, key long, vec_id long, label long, vec array<long>, positives array<struct<id:long,score:long>>"
_FOUND = "key long, anchor_id long, nth int, positive_id long, positive_score long, score long, id long"


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``key, vec_id, label, vec`` of the rows that take part: no null, no component that is null or not finite."""
    value = F.col(vector)

    def good(x: Column) -> Column:
        return x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double"))

    rows = embeddings.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & value.isNotNull() & F.forall(value, good)
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(value, lambda x: F.floor(SCALE * x.cast("double"))).alias("vec"),
    )
    return rows.select(F.xxhash64("vec_id", "label", "vec").alias("key"), "vec_id", "label", "vec")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers as doubles; short rows end in zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.float64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return vectors / np.where(norms > 0, norms, 1)[:, None], norms


def _angles(directions: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ centre, -1, 1))


def centres_of(vectors: np.ndarray, count: int = CENTRES, rounds: int = ROUNDS) -> np.ndarray:
    """Unit vectors in the middle of groups of like directions."""
    directions, _ = _directions(vectors)
    centres = np.unique(directions, axis=0)
    centres = centres[:: max(1, -(-len(centres) // count))]
    for _ in range(rounds):
        own = (directions @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, directions)
        moved, norms = _directions(sums)
        centres = np.where(norms[:, None] > 0, moved, centres)
    return centres


def _clustered(centres: np.ndarray):
    """Anchors with their nearest centre and the angle to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch["vec"])
            width = max(vectors.shape[1], centres.shape[1])
            directions, _ = _directions(_wide(vectors, width))
            cosines = directions @ _wide(centres, width).T
            nearest = cosines.argmax(1)
            angle = np.arccos(np.clip(cosines[np.arange(len(nearest)), nearest], -1, 1))
            names = ["key", "vec_id", "label", "vec"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(nearest, pa.int32()), pa.array(angle)], [*names, "cluster", "angle"]
            )

    return work


class _Best:
    """The first ``k`` rows of every task by score, then id; rows under ``low`` or over ``high`` never count."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray):
        self.k, self.high, self.low = k, high, low
        self.least = low.copy()  # what a row needs to enter a task
        self.task = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.id = np.empty(0, np.int64)

    def add(self, task: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(task):
            return
        task = np.concatenate((self.task, task))
        score, ident = np.concatenate((self.score, score)), np.concatenate((self.id, ident))
        order = np.lexsort((ident, -score, task))
        task, score, ident = task[order], score[order], ident[order]
        at = np.arange(len(task))
        nth = at - np.maximum.accumulate(np.where(np.concatenate(([True], task[1:] != task[:-1])), at, 0))
        keep = nth < self.k
        self.task, self.score, self.id = task[keep], score[keep], ident[keep]
        last = nth[keep] == self.k - 1
        self.least.flat[self.task[last]] = self.score[last]


class _Shard:
    """Candidates of one shard, and the list of the cluster that is walking it."""

    def __init__(self, batches: list[pa.RecordBatch]):
        vectors = [_matrix(b["vec"]) for b in batches]
        width = max([v.shape[1] for v in vectors], default=0)
        self.vectors = np.concatenate([_wide(v, width) for v in vectors]) if vectors else np.empty((0, 0))
        self.ids = np.concatenate([np.asarray(b["vec_id"]) for b in batches]) if batches else np.empty(0, np.int64)
        self.labels = np.concatenate([np.asarray(b["label"]) for b in batches]) if batches else np.empty(0, np.int64)
        self.directions, self.norms = _directions(self.vectors)
        self.cluster: int | None = None

    def list_for(self, cluster: int, centre: np.ndarray, reach: float) -> None:
        if cluster == self.cluster:
            return
        width = max(len(centre), self.vectors.shape[1])
        cosine_of = _angles(_wide(self.directions, width), np.pad(centre, (0, width - len(centre))))
        bound = self.norms * np.cos(np.maximum(0, cosine_of - reach - 1e-7))
        bound += np.abs(bound) * 1e-9 + 1e-6
        self.order = np.argsort(-bound, kind="stable")
        self.bound, self.cluster = bound[self.order], cluster

    def walk(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, best: _Best) -> None:
        width = max(anchors.shape[1], self.vectors.shape[1])
        anchors = _wide(anchors, width)
        norms = _directions(anchors)[1]
        if norms.max(initial=0) * self.norms.max(initial=0) >= EXACT:
            raise ArithmeticError("vectors too long for exact scores")
        tasks = best.low.shape[1]
        active = np.arange(len(anchors))
        for first in range(0, len(self.order), STEP):
            # Certified: the bound of the row next in the list is under what the anchor's tasks still ask for.
            ask = best.least[active].min(1)
            at_most = norms[active] * self.bound[first]
            active = active[(at_most >= ask) & (best.low[active] <= best.high[active]).any(1)]
            if not len(active):
                return
            rows = self.order[first : first + STEP]
            scores = anchors[active] @ _wide(self.vectors[rows], width).T
            alike = labels[active][:, None] == self.labels[rows]
            fits = alike & (ids[active][:, None] != self.ids[rows]) if same else ~alike
            fits &= scores >= best.least[active].min(1)[:, None]
            fits &= scores <= best.high[active].max(1)[:, None]
            who, which = np.nonzero(fits)
            score, ident, who = scores[who, which], self.ids[rows][which], active[who]
            for j in range(tasks):
                enters = (score >= best.least[who, j]) & (score <= best.high[who, j])
                best.add(who[enters] * tasks + j, score[enters], ident[enters])


def _bands(positives: list) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative for each positive, a row per anchor."""
    low = np.full((len(positives), POSITIVES), np.inf)
    high = np.full((len(positives), POSITIVES), -np.inf)
    for k, those in enumerate(positives):
        for j, p in enumerate(those):
            low[k, j], high[k, j] = -((-BAND[0] * p["score"]) // 100), (BAND[1] * p["score"]) // 100
    return low, high


def _visit(centres: np.ndarray, reach: dict[int, float], same: bool):
    """Rows sorted by shard, candidates first, then anchors by cluster: what each block of anchors finds there."""
    schema = pa.schema(
        [("key", pa.int64()), ("anchor_id", pa.int64()), ("nth", pa.int32()), ("positive_id", pa.int64())]
        + [("positive_score", pa.int64()), ("score", pa.int64()), ("id", pa.int64())]
    )

    def block(shard: _Shard, rows: pa.RecordBatch) -> pa.RecordBatch:
        cluster = rows["cluster"][0].as_py()
        shard.list_for(cluster, centres[cluster], reach[cluster])
        count = rows.num_rows
        ids, labels, keys = (np.asarray(rows[n]) for n in ("vec_id", "label", "key"))
        if same:
            positives = None
            best = _Best(POSITIVES, np.full((count, 1), -np.inf), np.full((count, 1), np.inf))
        else:
            positives = rows["positives"].to_pylist()
            best = _Best(NEGATIVES, *_bands(positives))
        shard.walk(_matrix(rows["vec"]), ids, labels, same, best)
        who, nth = np.divmod(best.task, best.low.shape[1])
        of = [positives[a][j] for a, j in zip(who.tolist(), nth.tolist())] if positives else None
        whole = [p["id"] for p in of] if of is not None else [None] * len(who)
        theirs = [p["score"] for p in of] if of is not None else [None] * len(who)
        columns = [keys[who], ids[who], nth, whole, theirs, best.score.astype(np.int64), best.id]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, shard = None, [], None
        for batch in batches:
            numbers, kinds, clusters = (np.asarray(batch[n].fill_null(-1)) for n in ("shard", "kind", "cluster"))
            change = (np.diff(numbers) != 0) | (np.diff(kinds) != 0) | (np.diff(clusters) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if numbers[a] != at:
                    at, rows, shard = numbers[a], [], None
                if kinds[a] == 0:
                    rows.append(batch.slice(a, b - a))
                    continue
                if shard is None:
                    shard, rows = _Shard(rows), []
                for first in range(a, b, BLOCK):
                    yield block(shard, batch.slice(first, min(BLOCK, b - first)))

    return work


def _first_rows(found: DataFrame, k: int, *of: str) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _shards(rows: int, cores: int) -> int:
    return max(1, -(-rows // SHARD_ROWS), min(2 * cores, rows // LEAST_SHARD))


def hard_negatives(embeddings: DataFrame, is_anchor: Column, vector: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors among ``embeddings``.

    A score is the product of two vectors of whole numbers, ``floor(256 * x)``; the higher comes first, of equals the smaller
    vec_id. An anchor's positives are the first five other rows of its label, the negatives of a positive the first
    ten rows of other labels with 30 to 90 per cent of its score (none for a score below zero).

    Rows with a null vec_id, label, vector or component, or one that is not finite, take no part. Rows that share a vec_id are rows each
    for themselves, but no row is a positive of an anchor with its own vec_id; equal anchors are one. Shorter vectors end in
    zeros, an empty one scores zero. An anchor without positives or negatives gives no row, an empty table none; other columns
    are ignored. Scores are exact below 2^53; vectors that could exceed it raise ArithmeticError.

    The centres are learned from at most SAMPLE anchors, which changes the order of the lists and never a result.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = saved(whole_vectors(embeddings, vector), "vectors")
    anchors = rows.filter(is_anchor).dropDuplicates(["key", "vec_id"])
    sample = anchors.orderBy("key").limit(SAMPLE).select("vec").toArrow()["vec"].combine_chunks()
    sample = sample.chunk(0) if isinstance(sample, pa.ChunkedArray) else sample
    centres = centres_of(_matrix(sample)) if len(sample) else np.zeros((1, 0))
    placed = saved(
        anchors.mapInArrow(_clustered(centres), "key long, vec_id long, label long, vec array<long>, cluster int, angle double"),
        "anchors",
    )
    reach = {r.cluster: r.angle for r in placed.groupBy("cluster").agg(F.max("angle").alias("angle")).collect()}
    shards = _shards(rows.count(), spark.sparkContext.defaultParallelism)
    none = F.lit(None)
    positives_type = "array<struct<id:long,score:long>>"
    # The place in the written table, so that no vector and no id is in one shard more often than in others.
    candidates = rows.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
        F.lit(0).alias("kind"),
        none.cast("int").alias("cluster"),
        "key", "vec_id", "label", "vec",
        none.cast(positives_type).alias("positives"),
    )

    def visits(those: DataFrame, same: bool) -> DataFrame:
        everywhere = those.select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.lit(1).alias("kind"),
            "cluster", "key", "vec_id", "label", "vec", "positives",
        )
        stream = candidates.union(everywhere).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "cluster", "key")
        return stream.mapInArrow(_visit(centres, reach, same), _FOUND)

    own = visits(placed.withColumn("positives", none.cast(positives_type)), True)
    best = _first_rows(own, POSITIVES, "key", "anchor_id")
    lists = best.groupBy("key", "anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
    positives = saved(
        lists.select(
            "key",
            F.col("anchor_id").alias("vec_id"),
            F.transform("best", lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("positives"),
        ),
        "positives",
    )
    others = visits(placed.join(positives, ["key", "vec_id"]), False)
    found = _first_rows(others, NEGATIVES, "key", "anchor_id", "nth")
    return found.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
