"""The pipeline against plain versions of its stages, and the registered queries against their SQL."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm_helpers import documents, prose
from martwright.llm.oracles import ORACLE_SQL
from martwright.llm.queries import QUERIES
from test_lines_and_quality import _plain_lines
from test_pairs import _edited, _plain_components, _plain_contained

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "conversations", "pages", "labels", "embeddings")


def _corpus():
    items = [(k, prose(900 + k, 30)) for k in range(4)]
    rows = [(k, prose(k, 40) + "\nall rights reserved\n" + prose(-k - 1, 40)) for k in range(30)]
    rows += [(100 + k, _edited(rows[0][1], k, k)) for k in range(4)]
    rows += [(200 + k, prose(300 + k, 50) + " " + items[k][1]) for k in range(4)]
    rows += [(300, "too few words"), (301, "again and again and " * 30), (302, None), (303, "")]
    return rows, items


def test_all_stages_like_plain_ones(spark, tmp_path):
    rows, items = _corpus()
    documents(spark, *rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0), (300, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    good = [(i, t) for i, t in rows if i < 300]
    lined = [(i, t) for i, t, *_ in _plain_lines(good, 10)]
    heads = {c for _, _, c in _plain_components(lined)}
    single = [(i, t) for i, t in lined if i in heads]
    clean = [(i, t) for i, t in single if i not in {c[0] for c in _plain_contained(single, items)}]
    assert len(rows) > len(good) > len(single) > len(clean) >= 30

    seen = documents(spark, *rows)
    for (name, stage), wanted in zip(corpus_pipeline.STAGES[:-1], (good, lined, single, clean)):
        seen = stage(spark, seen, str(tmp_path))
        assert sorted((r.doc_id, r.text) for r in seen.collect()) == sorted(wanted), name
        assert seen.columns == documents(spark, "x").columns
        assert all(r.n_chars == len(r.text) for r in seen.collect())

    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {i: np.array([*encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in clean}
    assert {r.doc_id for r in pieces} == set(ids)
    for i, wanted in ids.items():
        own = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in own) == len(wanted)
        assert all(r.ids_crc32 == zlib.crc32(wanted[r.start : r.start + r.length].tobytes()) for r in own)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
        wanted = db.execute(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, DATA).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    plain = [sorted(map(str, frame[columns].itertuples(index=False, name=None))) for frame in (got, wanted)]
    assert plain[0] == plain[1] and len(got)


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_native_queries_run_no_python(spark):
    for name in ("op3_decontamination", "op5_url_filter", "op6_line_dedup", "op13_fingerprints"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "InPandas", "InArrow")), name
