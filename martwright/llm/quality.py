"""Quality rules whose cutoffs come with a guarantee against rejecting good documents.

Every rule is a measure of the text and a ladder of cutoffs. All steps of all ladders make one fixed path, from the
laxest to the strictest, on which each step tightens one rule and keeps the others; so the rules in force reject more
and more documents, and a document has a first step at which it goes. For each stratum a labelled holdout counts
how many good documents go up to each step, whichever rule takes them. An exact (Clopper-Pearson) binomial bound
turns the count into an upper limit of the true rate of false rejections by all rules together. The path is followed to the first step whose bound
exceeds the risk, so its steps need no correction (fixed-sequence testing); strata share the error probability
evenly (Bonferroni). Of the certified steps the first that rejects as many of the labelled bad documents as any is used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import expect_skew
from .common import SHINGLE, saved, ship
from .shingles import WordTable, hashes_of, run_hashes

BLANK_BYTES = b" \t\n\x0b\x0c\r"
SYMBOL_BYTES = b"#*$%&|<>"
UPPER_BYTES = bytes(range(65, 91))
LETTER_BYTES = UPPER_BYTES + bytes(range(97, 123))
MARK_BYTES = bytes(c for c in range(33, 127) if not chr(c).isalnum())

#: The base rule: fewest words, and the most repeated words in percent.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: measure -> cutoffs from the laxest to the strictest; a document is rejected at or above the cutoff.
LADDERS: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "mark_share": (0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08),
    "upper_share": (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "repeat_share": (0.19, 0.17, 0.15, 0.13, 0.11, 0.09, 0.07, 0.05, 0.04, 0.03),
    "same_word_share": (0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6),
}
#: All steps in the order in which they are tested: by how far up its ladder each one is.
PATH: list[tuple[str, float]] = [
    step
    for _, step in sorted(
        (((k + 1) / len(cutoffs), at), (name, cutoff))
        for at, (name, cutoffs) in enumerate(LADDERS.items())
        for k, cutoff in enumerate(cutoffs)
    )
]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = ", ".join([f"{c} long" for c in COUNTS] + [f"{m} double" for m in LADDERS])
CUTOFFS = ", ".join(["stratum string"] + [f"{m}_cutoff double" for m in LADDERS])


@dataclass(frozen=True)
class Risk:
    """Of the good documents of a stratum that pass the base rule at most ``rate`` go, with probability ``1 - error``."""

    rate: float = 0.02
    error: float = 0.05


def measure(text: bytes | None, table: WordTable) -> tuple:
    """The counts and measures of one text; a null text counts as empty."""
    text = text or b""
    found = text.split()
    letters_only = text.translate(None, BLANK_BYTES)
    word_chars = len(letters_only.decode())
    symbols = len(text) - len(text.translate(None, SYMBOL_BYTES))
    lines = [line for line in text.split(b"\n") if line.translate(None, BLANK_BYTES)]
    dup_lines = len(lines) - len(set(lines))
    hashes = hashes_of(found, table)
    repeated = 0
    runs = run_hashes(hashes)
    if len(runs):
        _, group, count = np.unique(runs, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[group] > 1)
        if len(starts):
            edge = np.zeros(len(found) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + SHINGLE, -1)
            repeated = int(np.count_nonzero(np.cumsum(edge)[:-1]))
    letters = len(text) - len(text.translate(None, LETTER_BYTES))
    upper = len(text) - len(text.translate(None, UPPER_BYTES))
    marks = len(text) - len(text.translate(None, MARK_BYTES))
    n = len(found)
    return (
        n,
        word_chars,
        symbols,
        dup_lines,
        repeated,
        symbols / max(word_chars, 1),
        marks / max(word_chars, 1),
        upper / letters if letters >= 20 else 0.0,
        dup_lines / len(lines) if lines else 0.0,
        repeated / n if n else 0.0,
        1 - len(np.unique(hashes)) / n if n >= 50 else 0.0,
    )


def _measures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    table = WordTable()
    names = [*COUNTS, *LADDERS]
    for batch in batches:
        rows = pd.DataFrame([measure(t, table) for t in batch["text"]], columns=names)
        rows.insert(0, "stratum", batch["stratum"].to_numpy())
        rows.insert(0, "text_hash", batch["text_hash"].to_numpy())
        rows.insert(0, "doc_id", batch["doc_id"].to_numpy())
        yield rows.astype({c: "int64" for c in COUNTS})


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, text_hash, stratum``, the counts, the measures and ``base_failed`` of every row."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    ).mapInPandas(_measures, f"doc_id string, text_hash long, stratum string, {MEASURED}")
    return rows.withColumns(
        {
            "doc_id": F.col("doc_id").cast("long"),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        }
    )


def upper_bound(rejected: int, total: int, error: float) -> float:
    """The largest rate that would give at most ``rejected`` of ``total`` with probability ``error`` (Clopper-Pearson)."""
    if total <= 0 or rejected >= total:
        return 1.0

    def at_most(rate: float) -> float:
        """P(X <= rejected), summed from its largest term downwards."""
        log = [math.log(rate), math.log1p(-rate)]
        lead = math.lgamma(total + 1)
        term = math.exp(
            lead
            - math.lgamma(rejected + 1)
            - math.lgamma(total - rejected + 1)
            + rejected * log[0]
            + (total - rejected) * log[1]
        )
        out = 0.0
        for k in range(rejected, -1, -1):
            out += term
            if term < out * 1e-17:
                break
            term *= k * (1 - rate) / ((total - k + 1) * rate)
        return out

    low, high = rejected / total, 1.0 - 1e-15
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at_most(middle) > error else (low, middle)
    return high


def last_step(good: list[int], bad: list[int], total: int, strata: int, risk: Risk) -> int | None:
    """The step to stop at, of the good and bad rows that go at each step of the path; None if none is certified and of use.

    ``total`` counts the good rows, those that never go included; ``strata`` share the error.
    """
    best, taken, caught = None, 0, 0
    for step in range(len(good)):
        taken, caught = taken + good[step], caught + bad[step]
        if upper_bound(taken, total, risk.error / max(1, strata)) > risk.rate:
            break
        if caught > (best[0] if best else 0):
            best = (caught, step)
    return best[1] if best else None


def cutoffs_at(step: int) -> dict[str, float]:
    """The cutoffs in force at a step of the path."""
    return dict(PATH[: step + 1])  # later steps of a rule replace earlier ones


def _certify(strata: int, risk: Risk):
    """Counts of strata to their certified cutoffs (null: none), where there is one."""

    def chosen(steps: list, total: int) -> dict[str, float]:
        good, bad = [0] * len(PATH), [0] * len(PATH)
        for s in steps:
            if s["step"] < len(PATH):
                good[s["step"]], bad[s["step"]] = s["good"], s["bad"]
        last = last_step(good, bad, total, strata, risk)
        return {} if last is None else cutoffs_at(last)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["stratum", *(f"{name}_cutoff" for name in LADDERS)]
        for batch in batches:
            found = [(s, chosen(steps, total)) for s, steps, total in zip(batch["stratum"], batch["steps"], batch["good"])]
            rows = [(s, *(rules.get(name) for name in LADDERS)) for s, rules in found if rules]
            yield pd.DataFrame(rows, columns=columns).astype({c: "float64" for c in columns[1:]})

    return work


def first_step():
    """The first step of the path at which a ``measured`` row goes; the path's length if it stays."""
    where: dict[str, list[tuple[float, int]]] = {name: [] for name in LADDERS}
    for at, (name, cutoff) in enumerate(PATH):
        where[name].append((cutoff, at))

    def of(name: str):
        step = F.when(F.lit(False), 0)
        for cutoff, at in where[name]:
            step = step.when(F.col(name) >= cutoff, at)
        return step.otherwise(len(PATH))

    return F.least(*(of(name) for name in LADDERS))


def certified_cutoffs(holdout: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """``stratum`` and a cutoff of each measure (null: none), of all strata that have a certified one, from the
    ``measured`` columns and ``quality`` (1: good) of all labelled rows.

    Spark counts, for each stratum and step of the path, the good and bad rows that go there, and certifies
    every stratum by itself, however many there are.
    """
    good, bad = F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)
    steps = holdout.groupBy("stratum", first_step().alias("step")).agg(good.alias("good"), bad.alias("bad"))
    table = saved(
        steps.groupBy("stratum").agg(F.collect_list(F.struct("step", "good", "bad")).alias("steps"), F.sum("good").alias("good")),
        "steps",
    )
    return saved(table.mapInPandas(_certify(table.count(), risk), CUTOFFS), "cutoffs")


def _as_dict(table: DataFrame) -> dict[str, dict[str, float]]:
    """``certified_cutoffs`` as stratum -> measure -> cutoff."""
    found = {row["stratum"]: {name: row[f"{name}_cutoff"] for name in LADDERS} for row in table.collect()}
    return {s: {name: cutoff for name, cutoff in rules.items() if cutoff is not None} for s, rules in found.items()}


def cutoffs(holdout: DataFrame, risk: Risk = Risk()) -> dict[str, dict[str, float]]:
    """stratum -> measure -> certified cutoff."""
    return _as_dict(certified_cutoffs(holdout, risk))


def learned_cutoffs(rows: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """``certified_cutoffs`` from all ``measured`` rows that have a label and pass the base rule, which takes the others anyway."""
    judged = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return certified_cutoffs(rows.filter("not base_failed").join(judged, "doc_id"), risk)


def rejects():
    """The rules as one expression over the ``measured`` columns and the cutoffs of the row's stratum."""
    over = [F.coalesce(F.col(name) >= F.col(f"{name}_cutoff"), F.lit(False)) for name in LADDERS]
    return reduce(or_, over)


def quality_rules(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), stratum: str = "lang") -> DataFrame:
    """One row per row of ``docs (doc_id, text, <stratum>)``: ``doc_id``, ``text_hash``, the counts, the measures,
    ``base_failed`` and ``kept``.

    ``labels (doc_id, quality)``: 1 good, 0 bad; several labels of a document count as the worst, rows without a
    document or label count for nothing. A null text is empty (and fails the base rule), a null stratum is a stratum
    of its own, a null doc_id has no label, equal rows get equal verdicts. Strata without enough labels for a
    certificate, an empty label table among them, are judged by the base rule alone. Other columns are ignored.
    """
    expect_skew(docs.sparkSession)
    rows = saved(measured(docs, stratum), "quality")
    judged = rows.join(learned_cutoffs(rows, labels, risk), "stratum", "left")
    return judged.select(*rows.columns, (~F.col("base_failed") & ~rejects()).alias("kept"))


def passes(table: dict[str, dict[str, float]]):
    """The verdict as a function of text and stratum, for rows that are to be filtered where they lie."""
    names = [*COUNTS, *LADDERS]

    @F.pandas_udf("boolean")
    def good(texts: pd.Series, strata: pd.Series) -> pd.Series:
        words, out = WordTable(), []
        for text, stratum in zip(texts, strata):
            found = dict(zip(names, measure(text, words)))
            rules = table.get(stratum, {})
            base_failed = (
                found["n_words"] < MIN_WORDS or 100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"]
            )
            out.append(not base_failed and not any(found[name] >= cutoff for name, cutoff in rules.items()))
        return pd.Series(out, dtype=bool)

    return good


def keep_good(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), stratum: str = "lang") -> DataFrame:
    """``docs`` without the rows that ``quality_rules`` rejects; all their columns.

    Texts are measured once to learn the cutoffs and once to apply them, which costs less than to move them.
    """
    good = passes(_as_dict(learned_cutoffs(saved(measured(docs, stratum), "quality"), labels, risk)))
    return docs.filter(good(F.col("text").cast("binary"), F.coalesce(F.col(stratum).cast("string"), F.lit(""))))
