from __future__ import annotations

import shutil
from types import SimpleNamespace

import pytest

from martwright import operators as op
from martwright.plans.queries import refresh
from martwright.schemas import source_schema
from martwright.sources import tpch
from martwright.streaming.products import read_dimension, rejects_path, start_dimension, stream_products


def _feed(spark, rows, path, name):
    columns = (
        "product_id bigint, product_name string, description string, "
        "standard_cost string, list_price string, category_id bigint"
    )
    frame = spark.createDataFrame(rows, columns)
    cast = frame.select(*[frame[f.name].cast(f.dataType).alias(f.name) for f in source_schema("products").fields])
    cast.coalesce(1).write.parquet(f"{path}/{name}")


def test_products_arrive_in_batches_and_never_twice(spark, star, src, tmp_path):
    feed, dim, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/dim", f"{tmp_path}/checkpoint"
    start_dimension(star["dim_products"], dim)
    base_rows = []

    def run():
        query = stream_products(
            spark, f"{feed}/*", checkpoint, dim, src["product_categories"], source_schema("products")
        )
        query.awaitTermination()
        assert query.exception() is None
        for at in query.recentProgress:
            for source in at["sources"]:
                if "batch=base" in source["description"]:
                    base_rows.append(source["numInputRows"])
        return sorted((r.product_id, r.product_key) for r in read_dimension(spark, dim).collect())

    start = [(1, 1001), (2, 1002), (3, 1003)]
    _feed(spark, [(5, "a", "d", "1", "2", 1), (4, "b", "d", "1", "2", 2), (5, "a", "d", "1", "2", 1)], feed, "one")
    assert run() == start + [(4, 1004), (5, 1005)]
    _feed(spark, [(4, "b", "changed", "1", "2", 2), (7, "c", "d", "1", "2", 1)], feed, "two")
    assert run() == start + [(4, 1004), (5, 1005), (7, 1006)]
    assert run() == start + [(4, 1004), (5, 1005), (7, 1006)], "nothing new, nothing added"

    # The last batch is delivered again, as after a crash before its commit was noted.
    shutil.rmtree(f"{checkpoint}/commits")
    assert run() == start + [(4, 1004), (5, 1005), (7, 1006)]
    assert [n for n in base_rows if n] == [3], "the dimension is read once, to fill the state"


def test_rejects_of_the_stream_and_empty_ids(spark, star, src, tmp_path):
    feed, dim, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/dim", f"{tmp_path}/checkpoint"
    start_dimension(star["dim_products"], dim)

    def run():
        query = stream_products(spark, f"{feed}/*", checkpoint, dim, src["product_categories"], source_schema("products"))
        query.awaitTermination()
        assert query.exception() is None
        return sorted((r.product_id, r.product_name, r.product_key) for r in read_dimension(spark, dim).collect())[3:]

    _feed(spark, [(5, "a", "d", "1", "2", 1), (5, "b", "d", "1", "2", 1), (6, "c", "d", "1", "2", 99), (1, "x", "d", "1", "2", 1)], feed, "one")
    assert run() == [(5, "B", 1004)]
    rejects = spark.read.parquet(f"{rejects_path(dim)}/batch=*")
    assert sorted((r.product_id, r.product_name) for r in rejects.collect()) == [(5, "a"), (6, "c")]
    _feed(spark, [(6, "c", "d", "1", "2", 2), (5, "late", "d", "1", "2", 1)], feed, "two")
    assert run() == [(5, "B", 1004), (6, "C", 1005)], "a product comes in once it has a category"


def test_the_state_runs_no_python(spark, star, src, tmp_path):
    """A Python call per product took hours for millions of them; whole numbers beyond a double's reach stay exact."""
    feed, dim = f"{tmp_path}/feed", f"{tmp_path}/dim"
    start_dimension(star["dim_products"], dim)
    big = 2**60 + 1
    _feed(spark, [(big, "a", "d", "1", "2", 1), (big + 1, "b", "d", "1", "2", 1)], feed, "one")
    query = stream_products(spark, f"{feed}/*", f"{tmp_path}/checkpoint", dim, src["product_categories"], source_schema("products"))
    query.awaitTermination()
    assert query.exception() is None
    operators = {state["operatorName"] for at in query.recentProgress for state in at["stateOperators"]}
    assert operators == {"dedupe"}
    got = [r.product_id for r in read_dimension(spark, dim).orderBy("product_key").collect()]
    assert got == [1, 2, 3, big, big + 1]


class _Watched:
    """A stream for which any time limit is over at once."""

    def __init__(self, stream):
        self._stream = stream

    def __getattr__(self, name):
        return getattr(self._stream, name)

    def awaitTermination(self, timeout=None):
        return self._stream.awaitTermination(timeout and 0.01)


def _parts(spark, tmp_path):
    """Inputs of the query: two products in the dimension and two of the new category."""
    rows = [(1, "a#1", "ECONOMY"), (2, "b#2", "PROMO"), (3, "c#3", "ECONOMY"), (4, "d#4", "PROMO")]
    parts = [(key, name, "Brand#1", kind, key, 10.0 * key) for key, name, kind in rows]
    columns = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(parts, columns).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    src = tpch.source_model(spark, str(tmp_path))
    star = {"dim_products": op.dim_products(src["products"], src["product_categories"])}
    return SimpleNamespace(spark=spark, folder=str(tmp_path), src=src, star=star)


def test_the_query_waits_until_the_stream_is_done(spark, tmp_path, monkeypatch):
    """Its wait once ended after half an hour, and what was in the dimension by then was the result."""
    monkeypatch.setattr(refresh, "stream_products", lambda *given: _Watched(stream_products(*given)))
    rows = refresh.inc_products_stream(_parts(spark, tmp_path)).collect()
    assert sorted(r.product_id for r in rows) == [1, 2, 3, 4]


def test_a_stopped_stream_is_no_result(spark, tmp_path, monkeypatch):
    def stopped(*given):
        stream = stream_products(*given)
        stream.stop()
        return stream

    monkeypatch.setattr(refresh, "stream_products", stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        refresh.inc_products_stream(_parts(spark, tmp_path))
