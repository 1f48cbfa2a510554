from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from martwright.operators import with_surrogate_key
from martwright.operators.keys import highest_key


def _keys(df, name="k"):
    return {r.id: r[name] for r in df.collect()}


@pytest.mark.parametrize(
    "ids",
    [
        list(range(1, 500)),
        [3, 1, 2],
        [-(2**62), -5, 0, 7, 2**41, 2**41 + 1, 2**62],
        sorted({random.Random(seed).getrandbits(64) - 2**63 for seed in range(400)}),
        [i << 17 for i in range(300)],
    ],
)
def test_dense_in_order_of_the_id(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    keys = _keys(with_surrogate_key(df, ["id"], "k", 1001))
    assert keys == {i: 1001 + rank for rank, i in enumerate(sorted(ids))}


def test_continues_behind_the_highest_key(spark):
    df = spark.range(5)
    dim = spark.createDataFrame([(1007,), (1002,)], "k bigint")
    assert sorted(_keys(with_surrogate_key(df, ["id"], "k", 1001, after=highest_key(dim, "k"))).values()) == list(
        range(1008, 1013)
    )
    nothing = highest_key(dim.where("k < 0"), "k")
    assert min(_keys(with_surrogate_key(df, ["id"], "k", 1001, after=nothing)).values()) == 1001


def test_never_hands_out_the_reserved_key(spark):
    keys = sorted(_keys(with_surrogate_key(spark.range(6), ["id"], "k", 97, reserved=99)).values())
    assert keys == [97, 98, 100, 101, 102, 103]
    dim = spark.createDataFrame([(98,), (99,)], "k bigint")
    after = highest_key(dim, "k", reserved=99)
    assert sorted(_keys(with_surrogate_key(spark.range(2), ["id"], "k", 97, after, 99)).values()) == [100, 101]
    past = spark.createDataFrame([(105,), (99,)], "k bigint")
    after = highest_key(past, "k", reserved=99)
    assert sorted(_keys(with_surrogate_key(spark.range(2), ["id"], "k", 97, after, 99)).values()) == [106, 107]


def test_several_rows_per_leading_id(spark):
    rows = [(i, j) for i in range(20) for j in range(i % 4 + 1)]
    df = spark.createDataFrame(rows, "id bigint, j int")
    got = {(r.id, r.j): r.k for r in with_surrogate_key(df, ["id", "j"], "k", 1).collect()}
    assert got == {row: n for n, row in enumerate(sorted(rows), start=1)}


def test_spread_over_many_tasks(spark):
    ids = spark.range(3_000_000).select((F.col("id") * 7).alias("id"))
    keyed = with_surrogate_key(ids, ["id"], "k", 1)
    off = keyed.where(F.col("k") != F.col("id") / 7 + 1).count()
    assert off == 0


def test_text_ids_in_binary_order(spark, monkeypatch):
    from martwright.operators import keys

    monkeypatch.setattr(keys, "_EVERY", 2)
    monkeypatch.setattr(keys, "_RUN", 7)
    rng = random.Random(3)
    ids = {f"customer-{rng.randrange(10**6):06d}" for _ in range(3000)} | {"", "a", "Z", "ä", "漢字", "~", "customer-", "x" * 5000}
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = _keys(with_surrogate_key(df, ["id"], "k", 101))
    assert got == {i: 101 + rank for rank, i in enumerate(sorted(ids, key=lambda i: i.encode()))}
    blocks = keys._with_block(df, "id").groupBy("_block").count().collect()
    assert len(blocks) > 1000 and max(r["count"] for r in blocks) <= 4
    assert with_surrogate_key(df.limit(0), ["id"], "k", 1).count() == 0
    some = spark.createDataFrame([(None,), ("b",), ("a",)], "id string")
    assert _keys(with_surrogate_key(some, ["id"], "k", 1)) == {None: 1, "a": 2, "b": 3}


def test_a_sampled_block_is_a_range(spark):
    """More ids than the sample holds: every block is still a contiguous range, none far above its share."""
    from martwright.operators import keys

    df = spark.range(200_000).select(F.concat(F.lit("customer-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("id"))
    blocks = keys._with_block(df, "id").groupBy("_block").agg(F.min("id"), F.max("id"), F.count("id")).orderBy("_block").collect()
    assert all(one[2] < two[1] for one, two in zip(blocks, blocks[1:]))
    assert len(blocks) == keys._SAMPLE // keys._EVERY + 1 and max(r[3] for r in blocks) < 5 * 200_000 / len(blocks)
    keyed = with_surrogate_key(df, ["id"], "k", 1)
    assert keyed.where(F.col("k") != F.substring("id", 10, 9).cast("bigint") + 1).count() == 0


def test_a_text_id_is_held_against_few_bounds(spark):
    """The block of an id is searched for, not counted out over all bounds, which took minutes for a million ids."""
    from martwright.operators import keys

    df = spark.range(40_000).select(F.col("id").cast("string").alias("id"))
    assert "size(filter(" not in plan_text(keys._with_block(df, "id"))
    ids = [r.id for r in df.collect()]
    chosen = sorted(r.id for r in df.orderBy(F.xxhash64("id"), "id").limit(keys._SAMPLE).collect())
    bounds = chosen[keys._EVERY - 1 :: keys._EVERY]
    got = {r.id: r._block for r in keys._with_block(df, "id").collect()}
    assert got == {i: bisect.bisect_right(bounds, i) for i in ids}
