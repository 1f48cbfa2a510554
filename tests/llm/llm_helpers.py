"""What the tests of the training-data operators share."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, spans string, host string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
GAP = re.compile("[\x20\x09-\x0d]+")


def documents(spark, *rows):
    """A table of texts or (id, text) pairs, with further columns whose names clash with results."""
    full = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
    table = [(i, t, "en", "s", None if t is None else len(t), "mine", "own", "other") for i, t in full]
    return spark.createDataFrame(table, DOCS)


def prose(seed, words: int) -> str:
    """Text without any repetition to speak of."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(words))


def words_of(text: str | None) -> list[str]:
    return [w for w in GAP.split((text or "").translate(UPPER)) if w]


def shingle_set(text: str | None) -> frozenset:
    w = words_of(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def rows_of(df, *columns):
    """The rows as plain tuples, sorted whatever they hold."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
