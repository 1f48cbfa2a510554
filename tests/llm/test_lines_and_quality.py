from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_helpers import documents, prose, rows_of
from martwright.llm import lines, quality
from martwright.llm.shingles import WordTable

BLANKS = " \t\n\x0b\x0c\r"


def _plain_lines(rows, limit):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    split = [(i, (t or "").split("\n")) for i, t in rows]
    found = Counter(k for _, ls in split for k in {key(x) for x in ls})
    out = []
    for i, ls in split:
        kept = [x for x in ls if not key(x) or found[key(x)] < limit]
        out.append((i, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=repr)


LINE_ROWS = [
    (1, "Shared line\nown one\n\n"),
    (2, "  shared LINE\t\nown two"),
    (3, "x\nshared line"),
    (4, None),
    (5, ""),
    (6, "\n"),
    (7, "\u00c9t\u00e9\n\u00e9t\u00e9"),
    (8, "\u00e9T\u00e9\n\u00c9t\u00c9"),
    (9, "\u00c9t\u00c9"),
    (9, "\u00c9t\u00c9"),
    (None, "shared line\nnone"),
    (10, "again\n" * 5000 + "last"),
    (11, "again"),
    (12, "again\nshared line"),
]


@pytest.mark.parametrize("limit", [1, 2, 3, 5])
def test_lines_of_many_documents_go(spark, limit):
    got = lines.line_dedup(documents(spark, *LINE_ROWS), limit)
    assert rows_of(got, "doc_id", "text", "n_lines", "n_dropped") == _plain_lines(LINE_ROWS, limit)
    assert set(got.columns) == {*documents(spark, "x").columns, "n_lines", "n_dropped"}


def test_no_documents_no_lines(spark):
    assert lines.line_dedup(documents(spark, (1, "x")).limit(0)).count() == 0


def test_measures_by_hand():
    def counts(text):
        return quality.measure(None if text is None else text.encode(), WordTable())[:5]

    assert counts(None) == counts("") == counts(" \n ") == (0, 0, 0, 0, 0)
    assert counts("a b c d e a b c d e") == (10, 10, 0, 0, 10)
    assert counts("a b c d e f a b c d e") == (11, 11, 0, 0, 10)
    assert counts("#x|\n#x|\n \n \n\u00e9\u00e9") == (3, 8, 4, 1, 0)


def test_counts_like_plain_python():
    import random

    rng = random.Random(4)
    pieces = ["a", "b", "#x", "$", "<b>", "é|", "漢", " ", "  ", "\t", "\n", "\n", " \n", "\x0b", "A&B", "%%"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))
        w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
        lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
        runs = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if runs[tuple(w[k : k + 5])] > 1 for j in range(5)}
        plain = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert quality.measure(text.encode(), WordTable())[:5] == plain, text


def test_repeated_words_like_a_plain_count():
    import random

    rng = random.Random(3)
    for _ in range(200):
        w = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        runs = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if runs[tuple(w[k : k + 5])] > 1 for j in range(5)}
        assert quality.measure(" ".join(w).encode(), WordTable())[4] == len(covered)


def test_the_bound_is_exact():
    def at_most(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    for k, n, error in [(0, 100, 0.05), (3, 100, 0.05), (7, 1000, 0.001), (50, 60, 0.1)]:
        bound = quality.upper_bound(k, n, error)
        assert at_most(k, n, bound) == pytest.approx(error, rel=1e-6)
    assert quality.upper_bound(0, 0, 0.05) == quality.upper_bound(5, 5, 0.05) == 1.0
    assert quality.upper_bound(0, 10**6, 0.05) == pytest.approx(-math.log(0.05) / 10**6, rel=1e-3)


def _labelled(spark, good, bad):
    rows = [(k, f"{prose(k, 30)}") for k in range(good)] + [(good + k, "#$%& " * 3 + prose(-k - 1, 12)) for k in range(bad)]
    labels = spark.createDataFrame([(k, int(k < good)) for k in range(good + bad)], "doc_id bigint, quality int")
    return documents(spark, *rows), labels


def test_cutoffs_need_enough_labels_and_keep_the_good(spark):
    docs, labels = _labelled(spark, 1500, 60)
    out = quality.quality_rules(docs, labels)
    assert out.filter("not kept and doc_id < 1500").count() == 0
    assert out.filter("kept and doc_id >= 1500").count() == 0
    few, labels = _labelled(spark, 40, 10)
    assert quality.quality_rules(few, labels).filter("not kept").count() == 0


def test_certified_cutoffs_hold_the_risk_together(spark):
    docs, labels = _labelled(spark, 1500, 60)
    rows = quality.measured(docs).join(labels, "doc_id").cache()
    table = quality.cutoffs(rows)
    assert table["en"]
    over = " or ".join(f"{name} >= {cutoff}" for name, cutoff in table["en"].items())
    wrong = rows.filter(f"({over}) and quality = 1").count()
    assert quality.upper_bound(wrong, 1500, 0.05) <= 0.02
    assert rows.filter(f"({over}) and quality = 0").count() == 60


def test_three_hundred_good_labels_do(spark):
    docs, labels = _labelled(spark, 300, 10)
    assert quality.quality_rules(docs, labels).filter("kept and doc_id >= 300").count() == 0
    assert quality.last_step([0, 0], [0, 5], 300, 4, quality.Risk()) == 1
    assert quality.last_step([0, 0], [0, 5], 200, 4, quality.Risk()) is None


def test_the_first_step_is_the_first_rule_over_its_cutoff(spark):
    import random

    rng = random.Random(2)
    names = list(quality.LADDERS)
    rows = [[rng.choice([0.0, rng.random(), *quality.LADDERS[n]]) for n in names] for _ in range(300)]
    got = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).select(*names, quality.first_step().alias("step"))
    for row in got.collect():
        wanted = next((k for k, (n, c) in enumerate(quality.PATH) if row[n] >= c), len(quality.PATH))
        assert row.step == wanted
        for last in (0, 20, len(quality.PATH) - 1):
            assert (row.step <= last) == any(row[n] >= c for n, c in quality.cutoffs_at(last).items())
    assert sorted(quality.PATH) == sorted((n, c) for n, steps in quality.LADDERS.items() for c in steps)


def test_the_first_path_that_is_chosen_is_that_of_a_plain_search():
    import random

    rng = random.Random(9)
    for _ in range(100):
        good, bad = ([rng.choice([0, 0, 0, 1, 2]) for _ in range(12)] for _ in range(2))
        total = rng.randint(sum(good), 1200)
        certified = []
        for k in range(12):
            if quality.upper_bound(sum(good[: k + 1]), total, 0.05 / 3) > 0.02:
                break
            certified.append((sum(bad[: k + 1]), -k))
        best = max(certified, default=(0, 0))
        assert quality.last_step(good, bad, total, 3, quality.Risk()) == (-best[1] if best[0] else None)


def test_false_rejections_stay_under_the_rate():
    """Good documents go at each step with a known chance; in 95 of 100 draws the step chosen rejects no more than the rate."""
    import numpy as np

    rng = np.random.default_rng(1)
    chance = np.r_[np.full(20, 0.0004), np.full(20, 0.0012), np.full(20, 0.004)]
    truth, over, used = np.cumsum(chance), 0, 0
    for _ in range(400):
        total = int(rng.integers(300, 3000))
        good = rng.multinomial(total, [*chance, 1 - chance.sum()])[:-1].tolist()
        last = quality.last_step(good, [1] * len(chance), total, 1, quality.Risk())
        used += last is not None
        over += last is not None and truth[last] > 0.02
    assert used > 300 and over <= 0.05 * 400


def test_odd_rows_are_judged(spark):
    docs = documents(spark, (1, None), (1, ""), (None, prose(1, 20)), (2, prose(2, 20)), (2, prose(2, 20)), (3, "a " * 300_000))
    labels = spark.createDataFrame([(None, 1), (2, None), (77, 0), (2, 0), (2, 1)], "doc_id bigint, quality int")
    got = rows_of(quality.quality_rules(docs, labels), "doc_id", "n_words", "base_failed", "kept")
    assert got == sorted(
        [(1, 0, True, False)] * 2 + [(None, 20, False, True)] + [(2, 20, False, True)] * 2 + [(3, 300_000, True, False)],
        key=repr,
    )
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and rows_of(kept, "doc_id") == sorted([(None,), (2,), (2,)], key=repr)
    assert quality.quality_rules(docs.limit(0), labels.limit(0)).count() == 0


def test_strata_beyond_any_number_are_judged_by_themselves(spark):
    """None of 130 strata has labels for a certificate of its own; those of the smaller 70 together would do for one."""
    rows = [(f"big{s}", prose(k, 15), 1) for s in range(60) for k in range(46)]
    rows += [(f"small{s}", prose(k, 15), 1) for s in range(70) for k in range(40)]
    rows += [(f"small{s}", "#$%& " * 3 + prose(-s, 12), 0) for s in range(70)]
    rows += [(lang, "#$%& " * 3 + prose(s, 12), None) for s, lang in enumerate(["small3", "unlabelled"])]
    docs = spark.createDataFrame([(k, lang, text) for k, (lang, text, _) in enumerate(rows)], "doc_id bigint, lang string, text string")
    labels = spark.createDataFrame([(k, q) for k, (_, _, q) in enumerate(rows)], "doc_id bigint, quality int")
    assert quality.quality_rules(docs, labels).filter("not kept").count() == 0
    assert quality.keep_good(docs, labels).count() == len(rows)


def test_only_the_strata_with_a_certificate_have_cutoffs(spark):
    rows = [("en", prose(k, 15), 1) for k in range(3000)] + [("en", "#$%& " * 3 + prose(-k, 12), 0) for k in range(60)]
    rows += [(f"l{s}", "#$%& " * 3 + prose(s, 12), 1) for s in range(70)] + [("(other)", rows[-1][1], None), (None, rows[-1][1], None)]
    docs = spark.createDataFrame([(k, lang, text) for k, (lang, text, _) in enumerate(rows)], "doc_id bigint, lang string, text string")
    labels = spark.createDataFrame([(k, q) for k, (_, _, q) in enumerate(rows)], "doc_id bigint, quality int")
    judged = quality.quality_rules(docs, labels)
    assert rows_of(judged.filter("not kept"), "doc_id") == sorted([(k,) for k in range(3000, 3060)], key=repr)
    assert rows_of(quality.keep_good(docs, labels), "doc_id") == rows_of(judged.filter("kept"), "doc_id")
