"""Toxicity: terms learned from labels, misspelled ones caught by Levenshtein automata over their trie.

Labels say which documents are toxic. The lexicon are the words that toxic documents hold far more often. A word of
a text, or a run of letters joined by single digits or signs, is a hit if it is a term or one edit away from one of four letters or
more, and not itself a word of clean documents; the edits are found by walking the word's
Levenshtein automaton through the trie of all terms. A window around each hit tells quotation from abuse. Sums
of both kinds of hits go into a logistic regression.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, ship

#: Labelled rows the model learns from, at most, of each label: those of the least hash of their id.
SAMPLE = 10_000
#: Every FOLDS-th checksum of an id is held out.
FOLDS = 5
#: A term stands in this many toxic sample documents, is this many times as frequent there, and so by chance for
#: less than one of all words met. Every such word is a term; the sample bounds their number.
MIN_DOCUMENTS = 3
MIN_RATIO = 8.0
#: Terms this long may be misspelled by EDITS edits.
FUZZY_LENGTH = 4
EDITS = 1
#: Characters on either side of a hit in which quotation marks are looked for.
WINDOW = 60
QUOTES = "\"“”„«»‘’‹›"
#: Words a worker remembers as no hits; it only saves time.
TABLE = 600_000

#: Runs of letters; and runs of them joined by single digits or signs, which spell a term with some of its letters hidden.
_WORD = re.compile(r"[^\W\d_]+")
_JOINED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:(?:[^\s\w]|[\d_])[^\W\d_]++)++")


def tokens(lower: str) -> list[str]:
    return _WORD.findall(lower) + _JOINED.findall(lower)


def shortened(word: str, edits: int) -> set[str]:
    """``word`` with up to ``edits`` characters left out."""
    out = layer = {word}
    for _ in range(edits):
        layer = {w[:k] + w[k + 1 :] for w in layer for k in range(len(w))}
        out = out | layer
    return out


class Levenshtein:
    """The automaton of all words within ``edits`` of ``word``. States are sets of (characters read, edits made)."""

    def __init__(self, word: str, edits: int):
        self.word, self.edits = word, edits

    def start(self) -> frozenset:
        return frozenset({(0, 0)})

    def step(self, state: frozenset, char: str) -> frozenset:
        word, out = self.word, set()
        for at, made in state:
            if at < len(word) and word[at] == char:
                out.add((at + 1, made))
            if made < self.edits:
                out.add((at, made + 1))
                if at < len(word):
                    out.add((at + 1, made + 1))
                for skip in range(1, self.edits - made + 1):
                    if at + skip < len(word) and word[at + skip] == char:
                        out.add((at + skip + 1, made + skip))
        return frozenset(out)

    def accepts(self, state: frozenset) -> bool:
        return any(len(self.word) - at <= self.edits - made for at, made in state)


_END = ""


def trie_of(terms: Iterable[str]) -> dict:
    """Nodes by character; behind a term's last one stands the term itself, under _END."""
    root: dict = {}
    for term in terms:
        node = root
        for char in term:
            node = node.setdefault(char, {})
        node[_END] = term
    return root


class Lexicon:
    """Terms with weights, and which of them a misspelled word can be."""

    def __init__(self, terms: dict[str, float], harmless: frozenset[str] = frozenset()):
        self.terms, self.harmless = terms, harmless
        self.near: dict[str, list[str]] = {}
        for term in terms:
            if len(term) >= FUZZY_LENGTH:
                for part in shortened(term, EDITS):
                    self.near.setdefault(part, []).append(term)
        self.longest = max(map(len, self.near), default=0) + EDITS
        self.no: set[str] = set()

    def close(self, word: str) -> str | None:
        """The least term within EDITS of ``word``.

        Two words so close have a common word when up to EDITS characters of each are left out. That picks the
        branches of the trie that the automaton is run through: none for most words, and few for the others.
        """
        if len(word) > self.longest:
            return None
        likely = {term for part in shortened(word, EDITS) for term in self.near.get(part, ())}
        if not likely:
            return None
        automaton, found = Levenshtein(word, EDITS), []
        stack = [(trie_of(likely), automaton.start())]
        while stack:
            node, state = stack.pop()
            for char, child in node.items():
                if char == _END:
                    if automaton.accepts(state):
                        found.append(child)
                else:
                    following = automaton.step(state, char)
                    if following:
                        stack.append((child, following))
        return min(found, default=None)

    def look_up(self, words: set[str]) -> dict[str, tuple[str, bool]]:
        """The hits among ``words``: word -> (term, whether it is spelled so)."""
        out = {}
        for word in words.difference(self.no):
            if word in self.terms:
                out[word] = (word, True)
                continue
            term = self.close(word) if word not in self.harmless else None
            if term:
                out[word] = (term, False)
            elif len(self.no) < TABLE:
                self.no.add(word)
        return out


def quoted(text: str, start: int, end: int) -> float:
    """1 for a hit between quotation marks of its line's window, half for one with a mark on one side, else 0."""
    before = text[max(0, start - WINDOW) : start].rpartition("\n")[2]
    after = text[end : end + WINDOW].partition("\n")[0]
    return 0.5 * any(q in before for q in QUOTES) + 0.5 * any(q in after for q in QUOTES)


N_FEATURES = 5


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Weights of abusive, quoted and misspelled hits, different terms, and hits per hundred words; all logarithmic."""
    text = text or ""
    lower = text.lower()
    if len(lower) != len(text):
        text = lower
    words = _WORD.findall(lower)
    hits = lexicon.look_up({*words, *_JOINED.findall(lower)})
    if not hits:
        return [0.0] * N_FEATURES
    abuse = quotation = misspelled = 0.0
    count, terms = 0, set()
    for found in chain(_WORD.finditer(lower), _JOINED.finditer(lower)):
        if found[0] in hits:
            term, exact = hits[found[0]]
            weight, share = lexicon.terms[term], quoted(text, found.start(), found.end())
            if exact:
                abuse += weight * (1 - share)
                quotation += weight * share
            else:
                misspelled += weight * (1 - share)
            terms.add(term)
            count += 1
    return [*map(math.log1p, (abuse, quotation, misspelled, len(terms), 100 * count / len(words)))]


@dataclass(frozen=True)
class Model:
    """A lexicon and the coefficients (intercept first) of its features."""

    terms: dict[str, float]
    harmless: frozenset[str]
    coefficients: tuple[float, ...]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.coefficients[0] + rows @ np.array(self.coefficients[1:]), -30, 30)))


def fit_logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> tuple[float, ...]:
    """Coefficients by Newton's method, with a quadratic penalty on all but the intercept."""
    design = np.column_stack((np.ones(len(rows)), rows))
    weights = np.zeros(design.shape[1])
    ridge = np.diag([1e-6, *[penalty] * (design.shape[1] - 1)])
    for _ in range(50):
        expected = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (labels - expected) - ridge @ weights
        curve = (design * (expected * (1 - expected))[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(weights.tolist())


def _held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words = [list(set(tokens((t or "").lower()))) for t in batch["text"]]
        yield pd.DataFrame({"word": list(chain.from_iterable(words)), "toxic": np.repeat(batch["toxic"].to_numpy(), [len(w) for w in words])})


def _divergence(seen, share: float):
    """Of a rate ``seen`` from ``share``, in nats. Times the number of trials, it bounds the log of chance's odds (Chernoff)."""
    rest = F.when(seen < 1, (1 - seen) * F.log((1 - seen) / (1 - share))).otherwise(0.0)
    return seen * F.log(seen / share) + rest


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the texts of labelled rows that are not held out, at most SAMPLE of each label.

    Word counts are Spark's; the driver gets the sample's size, the terms, the sample's words close to them
    in clean documents, and N_FEATURES numbers for each sample document.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    usable = known.filter(~_held_out(F.col("doc_id")))
    chosen = [usable.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for t in (0, 1)]
    # At most 2 * SAMPLE rows of two numbers: small enough to broadcast whatever the tables hold.
    sample = F.broadcast(saved(chosen[0].union(chosen[1]), "toxic-sample"))
    train = saved(docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "toxic", "text"), "toxic-train")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model({}, frozenset(), (float(30 * (toxic > 0) - 30 * (clean > 0)), *[0.0] * N_FEATURES))
    counts = saved(
        train.select("toxic", "text")
        .mapInPandas(_words_of, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")),
        "toxic-words",
    )
    ratio = ((F.col("bad") + 0.5) / (toxic + 1)) / ((F.col("good") + 0.5) / (clean + 1))
    number, share = F.col("bad") + F.col("good"), toxic / (toxic + clean)
    best = (
        counts.filter(F.col("bad") >= MIN_DOCUMENTS)
        .withColumns({"ratio": ratio, "evidence": number * _divergence(F.col("bad") / number, share)})
        .filter((F.col("ratio") >= MIN_RATIO) & (F.col("evidence") >= math.log(max(counts.count(), 2))))
    )
    terms = {r["word"]: math.log(r["ratio"]) for r in best.collect()}

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for batch in batches:
            yield batch[[w not in terms and lexicon.close(w) is not None for w in batch["word"]]]

    near = counts.filter("good > 0 and good >= bad").select("word").mapInPandas(close, "word string")
    harmless = frozenset(r["word"] for r in near.collect())

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms, harmless)
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "row": [features(t, lexicon) for t in batch["text"]]})

    rows = train.select("toxic", "text").mapInPandas(measure, "toxic int, row array<double>").collect()
    rows.sort()
    design = np.array([r["row"] for r in rows], float).reshape(-1, N_FEATURES)
    return Model(terms, harmless, fit_logistic(design, np.array([r["toxic"] for r in rows], float)))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs (doc_id, text)``.

    ``labels (doc_id, toxic)`` teach the model, except those whose id's checksum is held out; several labels of a document count as
    the worst. The score depends on the text alone. A null text is empty and gets the score of a text without hits; a null
    doc_id has no label and is not held out; repeated rows get equal scores. Without labels of both kinds
    everything gets one score, below a half unless all labels are 1. Other columns are ignored; an empty table gives no row.
    """
    ship(docs.sparkSession)
    model = learn(docs, labels)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(model.terms, model.harmless)
        for batch in batches:
            rows = np.array([features(t, lexicon) for t in batch["text"]], float).reshape(-1, N_FEATURES)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.scores(rows)})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(work, "doc_id string, score double").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(_held_out(F.col("doc_id").cast("long")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
