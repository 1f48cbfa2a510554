from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from llm_helpers import GAP, documents, prose, rows_of, shingle_set
from martwright.llm import decontaminate as dc
from martwright.llm import jaccard, passages, repeats
from martwright.llm.phrases import merged, text_rows
from martwright.llm.queries import op4_suffix_dedup


def _edited(text: str, edits: int, seed: int) -> str:
    w, rng = text.split(), random.Random(seed)
    for k in range(edits):
        w[rng.randrange(len(w))] = f"edit{seed}x{k}"
    return " ".join(w)


def _similar_rows():
    base, other = prose(1, 120), prose(2, 60)
    rows = [(100 + k, _edited(base, k % 7, k)) for k in range(60)]
    rows += [(300 + k, base) for k in range(20)] + [(400 + k, other + f" end{k}") for k in range(8)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one two"), (504, "ONE  two"), (505, "one two three")]
    rows += [(506, prose(9, 5)), (507, prose(9, 5).upper()), (600, prose(7, 4000)), (601, prose(7, 3900)), (600, prose(8, 30))]
    rows += [(None, other), (None, None), (700, prose(10, 200)), (700, prose(10, 200))]
    return rows


def _plain_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None) if sets[k] else i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("list_rows", [50_000, 8])
def test_components_like_all_pairs(spark, monkeypatch, list_rows):
    monkeypatch.setattr(jaccard, "LIST_ROWS", list_rows)
    rows = _similar_rows()
    got = jaccard.jaccard_components(documents(spark, *rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == _plain_components(rows)


def test_copies_that_resemble_one_text_only_cost_few_comparisons(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 121):
        text = list(base)
        for at in rng.sample(range(5, 145, 5), 2 if i <= 80 else 4):
            text[at] = f"x{i}.{at}"
        rows.append((i, " ".join(text)))
    wanted = _plain_components(rows)
    assert len({c for _, _, c in wanted}) == 41  # two edits link with the base, four with nothing
    tried = []
    whole = jaccard._verified

    def counted(pairs, blobs, percent):
        tried.append(pairs.count())
        return whole(pairs, blobs, percent)

    monkeypatch.setattr(jaccard, "_verified", counted)
    got = jaccard.jaccard_components(documents(spark, *rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == wanted
    assert sum(tried) <= 4 * len(rows)


def test_sizes_that_fit_lie_in_bands_side_by_side(spark):
    from pyspark.sql import functions as F

    sizes = spark.range(1, 200_000).select(F.col("id").alias("a"), F.floor(F.col("id") * 100 / 80).alias("b"))
    apart = jaccard._band(F.col("b"), 80) - jaccard._band(F.col("a"), 80)
    assert sizes.filter(~jaccard._sizes_fit(F.col("a"), F.col("b"), 80)).isEmpty()
    assert sizes.filter((apart > 1) | (apart < 0)).isEmpty()


def test_sketches_part_no_similar_sets(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows, similar = [], 0
    for _ in range(1500):
        size = int(rng.integers(1, 400))
        left = rng.integers(0, 1 << 63, size, np.uint64)
        gone = int(rng.integers(0, size // 4 + 1))
        right = np.concatenate([left[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, gone + 2)), np.uint64)])
        fits = 100 * (size - gone) >= 80 * (size + len(right) - (size - gone))
        similar += fits
        rows.append((*map(int, jaccard._sketch(left)), *map(int, jaccard._sketch(right)), size, len(right), bool(fits)))
    names = [f"{side}{k}" for side in "xy" for k in range(4)]
    frame = spark.createDataFrame(rows, [*names, "a", "b", "fits"])
    columns = [[F.col(c) for c in names if c[0] == side] for side in "xy"]
    may = jaccard._may_fit(*columns, F.col("a"), F.col("b"), 80)
    assert 100 < similar < 1400
    assert frame.filter(F.col("fits") & ~may).isEmpty()
    assert frame.filter(~F.col("fits") & ~may).count() > 300


def test_one_of_each_component_stays(spark):
    rows = [r for r in _similar_rows() if r[0] is not None]
    docs = documents(spark, *rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    wanted = {c for _, _, c in _plain_components(rows)}
    assert Counter(i for (i,) in rows_of(kept, "doc_id")) == Counter({i: 1 for i in wanted} | {600: 2})
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_the_shared_hashes_asked_for_are_never_too_many(spark):
    from pyspark.sql import functions as F

    sizes = spark.range(1, 60).select(F.col("id").alias("a")).crossJoin(spark.range(1, 60).select(F.col("id").alias("b")))
    asked = {(r.a, r.b): r.k for r in sizes.select("a", "b", jaccard._fewest_shared(F.col("a"), F.col("b"), 80).alias("k")).collect()}
    rng = random.Random(5)
    for _ in range(3000):
        a, b = rng.randint(1, 59), rng.randint(1, 59)
        common = rng.randint(0, min(a, b))
        if 100 * common < 80 * (a + b - common):
            continue
        order = rng.sample(range(1000), a + b - common)
        x, y = set(order[:a]), set(order[a - common :])
        first = [set(sorted(s)[: len(s) - -(-80 * len(s) // 100) + 1]) for s in (x, y)]
        assert len(first[0] & first[1]) >= asked[a, b]


@pytest.mark.parametrize("percent", [80, 50, 63])
def test_the_bound_of_a_range_is_its_least(spark, percent):
    from pyspark.sql import functions as F

    n, m, low, high = (F.col(c) for c in ("n", "m", "low", "high"))
    sizes = spark.range(1, 161).select(F.col("id").alias("n"))
    fit = spark.range(1, 330).select(F.col("id").alias("m")).join(sizes, jaccard._sizes_fit(n, F.col("m"), percent))
    each = {(r.n, r.m): r.k for r in fit.select("n", "m", jaccard._fewest_shared(n, m, percent).alias("k")).collect()}
    rng, asked = random.Random(8), []
    for k in range(1, 161):
        fits = [b for a, b in each if a == k]
        asked += [(k, *sorted(rng.choices(fits, k=2))) for _ in range(20)]
    ranges = spark.createDataFrame(asked, "n bigint, low bigint, high bigint").withColumn("k", jaccard._fewest_in(n, low, high, percent))
    for r in ranges.collect():
        assert r.k == min(each[r.n, size] for size in range(r.low, r.high + 1))


def test_groups_are_opened_for_every_size_of_their_members(spark):
    rows = []
    for k in range(10):
        words = prose(1000 + k, 130).split()
        b = words[:113]  # 109 shingles; a has 100 and shares 93 of them, c has 110, d 108, and neither is like a
        texts = [words[16:113] + words[120:127], b, words[129:] + b, b[:-1]]
        rows += [(10 * k + j, " ".join(t)) for j, t in enumerate(texts)]
    wanted = _plain_components(rows)
    assert {c for _, _, c in wanted} == {10 * k for k in range(10)}
    got = jaccard.jaccard_components(documents(spark, *rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == wanted


def _plain_contained(rows, items):
    by_set = {}
    for i, t in sorted(items):
        if shingle_set(t):
            by_set.setdefault(shingle_set(t), i)
    out = set()
    for i, t in rows:
        for s, item in by_set.items():
            both = len(s & shingle_set(t))
            if 100 * both >= 80 * len(s):
                out.add((i, item, len(s), both))
    return sorted(out, key=repr)


def test_items_inside_documents_like_all_pairs(spark):
    items = [(k, prose(50 + k, n)) for k, n in enumerate([3, 5, 8, 17, 33, 64, 100, 250])]
    items += [(90, items[3][1].upper()), (91, None), (92, "")]
    rows = []
    for k, (_, t) in enumerate(items[:8]):
        for e in range(6):
            rows.append((10 * k + e, prose(k, 300) + " " + _edited(t, e, e) + " " + prose(-k, 2000 if e == 1 else 40)))
    rows += [(500, items[0][1]), (501, None), (502, ""), (None, rows[6][1]), (503, rows[6][1]), (503, rows[6][1])]
    docs, table = documents(spark, *rows), spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contained_items(docs, table)
    wanted = _plain_contained(rows, items)
    assert rows_of(got, "doc_id", "item_id", "n_item_shingles", "n_shared") == wanted and len(wanted) > 20
    clean = dc.decontaminate(docs, table)
    dirty = {i for i, *_ in wanted}
    assert clean.columns == docs.columns
    assert rows_of(clean, "doc_id") == sorted([(i,) for i, _ in rows if i not in dirty], key=repr)
    assert dc.contained_items(docs.limit(0), table).count() == dc.contained_items(docs, table.limit(0)).count() == 0


def test_items_without_an_id_are_found(spark):
    items = [(None, prose(70, 40)), (None, prose(71, 12)), (1, prose(72, 30)), (None, prose(72, 30))]
    docs = documents(spark, *((k, prose(80 + k, 50) + " " + t) for k, (_, t) in enumerate(items[:3])), (9, prose(90, 50)))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contained_items(docs, table)
    wanted = sorted([(0, None, 36, 36), (1, None, 8, 8), (2, 1, 26, 26)], key=repr)
    assert rows_of(got, "doc_id", "item_id", "n_item_shingles", "n_shared") == wanted
    assert rows_of(dc.decontaminate(docs, table), "doc_id") == [(9,)]


def _plain_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    found = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if found[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kinds", [2000, 1])
def test_repeated_strings_like_a_plain_count(spark, monkeypatch, kinds):
    monkeypatch.setattr(repeats, "KINDS", kinds)
    passage, shared = prose(1, 40), prose(2, 20)
    rows = [(k, prose(20 + k, 20) + passage[k : 200 - k] + prose(40 + k, 10) + shared) for k in range(12)]
    rows += [(50, passage), (51, None), (52, ""), (53, "short"), (54, "a" * 500), (55, "ab" * 300), (56, "\u00e9" * 120)]
    rows += [(57, prose(3, 60)), (57, prose(3, 60)), (None, passage + "x"), (58, prose(4, 3000)), (59, (prose(5, 9) + " ") * 4)]
    got = repeats.remove_repeats(documents(spark, *rows), length=60, span=24)
    assert rows_of(got.selectExpr("doc_id", "n_bytes", "n_removed", "size(starts) n", "kept_sha256"), "*") == _plain_repeats(rows, 60)
    for r in got.collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_removed
    assert repeats.remove_repeats(documents(spark, "x").limit(0)).count() == 0


def test_equal_strings_have_equal_triggers():
    rng = random.Random(1)
    for _ in range(30):
        core = bytes(rng.choice(b"ab") for _ in range(90))
        places = []
        for _ in range(2):
            lead = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 50)))
            first, last, trigger = repeats.phrases(lead + core + lead[::-1], 60, 24)
            of = {p: t for a, b, t in zip(first, last, trigger) for p in range(a, b + 1)}
            places.append([of[len(lead) + k] - len(lead) for k in range(31)])
        assert places[0] == places[1]


def _plain_passages(rows, length):
    texts = [[w for w in GAP.split(t or "") if w] for _, t in rows]
    held = {}
    for row, w in zip(rows, texts):
        for p in range(len(w) - length + 1):
            held.setdefault(tuple(w[p : p + length]), set()).add(row)
    out = []
    for (i, _), w in zip(rows, texts):
        inside = [False] * len(w)
        for p in range(len(w) - length + 1):
            if len(held[tuple(w[p : p + length])]) > 1:
                inside[p : p + length] = [True] * length
        out.append((i, sum(x and (k == 0 or not inside[k - 1]) for k, x in enumerate(inside)), sum(inside)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length, span", [(51, 24), (20, 12), (20, 1)])
def test_passages_of_other_documents_like_a_plain_count(spark, length, span):
    passage, base = prose(1, 80).split(), prose(2, 200)
    rows = [(k, " ".join([prose(20 + k, 30), *passage[k : 80 - 2 * k], prose(40 + k, 15)])) for k in range(14)]
    rows += [(100 + k, _edited(base, k % 5, k)) for k in range(30)]
    rows += [(200, prose(3, 120)), (200, prose(3, 120)), (201, (prose(4, 60) + " ") * 3), (202, "and " * 300), (203, "and " * 90 + "or " * 70)]
    rows += [(204, prose(5, 70)), (205, prose(5, 70).replace(" ", "\n \t")), (None, prose(5, 70)), (206, "\u00e9t\u00e9 \u00a0 " * 60 + base)]
    rows += [(207, " ".join([*base.split()[50:110], prose(6, 9), *base.split()[50:110]])), (208, None), (209, ""), (210, "few words")]
    docs = documents(spark, *rows)
    found = {}
    for r in passages.shared_windows(docs, length, span).join(text_rows(docs), "row").collect():
        found.setdefault(bytes(r.text), set()).add(r.place)
    got = []
    for i, t in rows:
        starts, ends = merged(sorted(found.get((t or "").encode(), ())), length)
        got.append((i, len(starts), int((ends - starts).sum())))
    assert sorted(got, key=repr) == _plain_passages(rows, length)


def test_passages_too_short_for_removal_are_reported(spark, tmp_path):
    passage = " ".join(f"w{k}" for k in range(60))  # under 400 bytes
    rows = [(k, prose(k, 40) + "\n" + passage + " " + prose(10 + k, 40)) for k in range(3)]
    rows += [(3, prose(3, 90)), (4, (prose(4, 60) + " ") * 2), (4, (prose(4, 60) + " ") * 2), (5, None)]
    documents(spark, *rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op4_suffix_dedup(spark, str(tmp_path))
    assert rows_of(got, "doc_id", "n_passages", "n_passage_words") == _plain_passages(rows, 51)
    assert rows_of(got.filter("n_passages > 0"), "doc_id", "n_removed", "n_passage_words") == [(k, 0, 60) for k in range(3)]
    assert rows_of(got.drop("n_passages", "n_passage_words"), "*") == _plain_repeats(rows, 400)
    assert repeats.remove_repeats(documents(spark, "x").limit(0)).count() == 0
