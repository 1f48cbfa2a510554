from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from llm_helpers import documents, prose, rows_of, words_of
from martwright.llm import fingerprints as fp
from martwright.llm import negatives, runs
from pyspark.sql import functions as F

# Periodic runs


def _plain_runs(w: list) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _plain_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = _plain_runs(w)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (
        doc_id,
        n,
        len(found),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest(),
    )


def _periodic_text(rng: random.Random) -> list[int]:
    t = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 150))]
    for _ in range(rng.randint(0, 3)):
        if t:
            s, p = rng.randrange(len(t)), rng.randint(1, 25)
            for i in range(s + p, rng.randint(s, len(t))):
                t[i] = t[i - p]
    return t


def test_runs_of_many_texts_at_once_like_plain_search():
    rng = random.Random(11)
    texts = [_periodic_text(rng) for _ in range(800)]
    got = runs.runs_of([np.array(t, np.int64) for t in texts])
    assert got == [_plain_runs(t) for t in texts]
    assert sum(map(len, got)) > 100


@pytest.mark.parametrize("period, length", [(1, 30_000), (3, 20_000), (6_000, 20_000)])
def test_long_runs(period, length):
    assert runs.runs_of([np.arange(length) % period]) == [[(0, length, period)]]


def test_periodic_runs_query_columns(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{x}" for x in _periodic_text(rng))) for k in range(250)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (None, "a b " * 40), (None, None), (-5, "x\x0by\x0cz " * 30)]
    rows += [(403, "x y " * 30), (404, prose(3, 4000)), (405, "ab " * 9000), (406, prose(4, 3000) + " " + prose(4, 3000))]
    rows += [(407, "Ü ß " * 20), (407, "Ü ß " * 20), (407, "Ü ß " * 7)]
    out = runs.periodic_runs(documents(spark, *rows), plant=True)
    columns = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = rows_of(out, *columns)
    assert got == sorted((_plain_row(*r) for r in rows), key=repr)
    assert sum(r[2] for r in got) > 50
    assert runs.periodic_runs(documents(spark, (1, "a")).limit(0)).count() == 0


def test_collapsed_text_and_unplanted(spark):
    text = "one two three " * 10 + "four"
    row = runs.periodic_runs(documents(spark, (13, text))).first()
    assert (row.collapsed, row.starts, row.lengths, row.periods) == (b"one two three four", [0], [30], [3])


# Fingerprints


def _plain_sketch(text, one_in=fp.ONE_IN):
    w = words_of(text)
    digests = {
        hashlib.md5(" ".join(w[k : k + 5]).encode()).hexdigest()[:16] for k in range(max(1, len(w) - 4)) if w
    }
    low = sorted(d for d in digests if int(d, 16) < 2**64 // one_in)
    return low or sorted(digests)[:1]


def _plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    return len(set(a) & set(b)) / min(len(a), len(b))


def _plain_fingerprints(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        a, b, c = _plain_sketch(t), _plain_sketch(edited), _plain_sketch(follow)
        out.append((i, len(t), edited, a, b, _plain_likeness(a, b), _plain_likeness(a, c)))
    return sorted(out, key=repr)


_PRINTS = ["doc_id", "n_chars", "edited", "digests", "edited_digests", "near_edited", "near_next"]


@pytest.mark.parametrize("step", [1, 777, 2**40])
def test_fingerprints_like_plain_python(spark, step):
    rows = [(k * step - 40, prose(k % 50, 3 + k * 7 % 90)) for k in range(120)]
    rows += [(9000 * step, None), (9001 * step, ""), (9002 * step, "\t "), (9003 * step, "One two"), (9003 * step, "one  TWO")]
    rows += [(9003 * step, "one  TWO"), (None, "no id at all, but words"), (None, None), (9004 * step, "Größe 漢字 x" * 30)]
    rows += [(9005 * step, prose(8, 6000)), (2**62, "last"), (-(2**62), "first")]
    got = [(*r[:3], list(r[3]), list(r[4]), *r[5:]) for r in rows_of(fp.fingerprints(documents(spark, *rows)), *_PRINTS)]
    assert sorted(got, key=repr) == _plain_fingerprints(rows)


def test_fingerprints_of_one_row_and_of_none(spark):
    one = rows_of(fp.fingerprints(documents(spark, (5, prose(1, 30)))), *_PRINTS)
    assert [(*r[:3], list(r[3]), list(r[4]), *r[5:]) for r in one] == _plain_fingerprints([(5, prose(1, 30))])
    assert fp.fingerprints(documents(spark, (5, "x")).limit(0)).count() == 0


def test_sketches_merge_and_show_containment(spark):
    small, large = prose(1, 300), prose(2, 9000)
    both = small + " " + large
    row = (
        spark.createDataFrame([(small, large, both, "a b c d e")], "s string, l string, b string, t string")
        .select(*(fp.sketch(F.col(c)).alias(c) for c in "slbt"))
        .select(
            fp.merged(F.col("s"), F.col("l")).alias("union"),
            "b",
            fp.contained(F.col("s"), F.col("b")).alias("inside"),
            fp.contained(F.col("b"), F.col("s")).alias("outside"),
            F.size("t").alias("least"),
            fp.merged(F.col("t"), F.col("t")).alias("same"),
        )
        .first()
    )
    assert set(row.union) <= set(row.b) and len(row.b) - len(row.union) <= 4
    assert row.inside == 1.0 and abs(row.outside - 300 / 9300) < 0.02
    assert row.least == 1 and len(row.same) == 1
    error = abs(len(row.b) * fp.ONE_IN / 9296 - 1)
    assert error < 0.1


def test_fingerprints_run_no_python_on_executors(spark):
    plan = fp.fingerprints(documents(spark, (1, "a b"), (2, "c d")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# Hard negatives

_VECTORS = "vec_id long, label int, embedding array<float>, rank string, score string, cluster string"


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, "mine", "own", "other") for r in rows], _VECTORS)


def _plain_negatives(rows, is_anchor):
    def good(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[2])

    whole = [(i, l, [math.floor(256 * float(np.float32(x))) for x in v]) for i, l, v in rows if good((i, l, v))]
    out, done = [], set()
    for i, label, v in whole:
        if not is_anchor(i) or (i, label, tuple(v)) in done:
            continue
        done.add((i, label, tuple(v)))
        scored = [(-sum(a * b for a, b in zip(v, w)), j, k) for j, k, w in whole]
        own = sorted(s for s in scored if s[2] == label and s[1] != i)[:5]
        for p in own:
            fits = sorted(s for s in scored if s[2] != label and -30 * p[0] <= -100 * s[0] <= -90 * p[0])
            out += [(i, p[1], n, s[1], -p[0], -s[0]) for n, s in enumerate(fits[:10], 1)]
    return sorted(out, key=repr)


_NEGATIVES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("shards", [1, 5])
def test_hard_negatives_like_all_pairs(spark, monkeypatch, shards):
    monkeypatch.setattr(negatives, "_shards", lambda rows, cores: shards)
    rng = np.random.default_rng(shards)
    centres = rng.normal(size=(6, 12))
    rows = []
    for k in range(1500):
        v = centres[k % 6] + rng.normal(size=12) * 0.4 if k % 3 else centres[0]  # a third are one vector
        rows.append((k, int(rng.integers(0, 5)), [float(x) for x in v * rng.uniform(0.5, 2)] if k % 3 else v.tolist()))
    rows += [(3000, None, [1.0] * 12), (3001, 1, None), (3002, 1, [None] * 12), (3003, 1, [math.nan] * 12)]
    rows += [(3004, 1, [math.inf] + [0.0] * 11), (3005, 1, []), (3006, 2, [0.0] * 12), (None, 1, [1.0] * 12)]
    rows += [(3007, 2, [0.5] * 7), (3030, 3, rows[30][2]), (3030, 3, rows[30][2]), (3060, 7, [0.1] * 12), (-30, 2, rows[7][2])]
    got = rows_of(negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 30 == 0), *_NEGATIVES)
    assert got == _plain_negatives(rows, lambda i: i % 30 == 0)
    assert len(got) > 500


def test_no_anchor_no_row(spark):
    rows = [(1, 1, [1.0, 2.0]), (2, 1, [2.0, 1.0])]
    assert negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") == 7).count() == 0
    assert negatives.hard_negatives(_vectors(spark, rows).limit(0), F.col("vec_id") == 7).count() == 0


def test_a_walk_ends_where_the_bound_certifies_it(monkeypatch):
    """Tight clusters: each anchor sees its own part of the list and no more."""
    rng = np.random.default_rng(4)
    centres = np.eye(8) * 1000
    vectors = np.floor(np.repeat(centres, 3000, 0) + rng.normal(size=(24000, 8)) * 10)
    shard = negatives._Shard([])
    shard.vectors, shard.ids, shard.labels = vectors, np.arange(24000), np.zeros(24000, np.int64)
    shard.directions, shard.norms = negatives._directions(vectors)
    shard.list_for(0, centres[0] / 1000, 0.05)
    seen = []
    monkeypatch.setattr(negatives, "_wide", lambda a, w: (seen.append(len(a)), a)[1])
    anchors = vectors[:20]
    best = negatives._Best(5, np.full((20, 1), -np.inf), np.full((20, 1), np.inf))
    shard.walk(anchors, np.arange(20), np.zeros(20, np.int64), True, best)
    assert sum(seen[1:]) < 6000
    scores = anchors @ vectors.T
    scores[np.arange(20), np.arange(20)] = -np.inf
    wanted = np.argsort(-scores, axis=1, kind="stable")[:, :5]
    assert best.id.reshape(20, 5).tolist() == wanted.tolist()


def test_vectors_too_long_for_exact_scores():
    shard = negatives._Shard([])
    shard.vectors, shard.ids, shard.labels = np.full((1, 2), 1e9), np.arange(1), np.zeros(1, np.int64)
    shard.directions, shard.norms = negatives._directions(shard.vectors)
    shard.list_for(0, np.array([1.0, 0.0]), 4.0)
    with pytest.raises(ArithmeticError):
        shard.walk(np.full((1, 2), 1e9), np.array([5]), np.zeros(1, np.int64), True, negatives._Best(5, np.full((1, 1), -np.inf), np.full((1, 1), np.inf)))
