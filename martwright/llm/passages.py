"""Passages of many words that stand in more than one document, found as in ``repeats``, over words and by document.

Triggers cut the words of a text into phrases. Phrases whose core only one document holds are dropped in the first count; those
met as a whole in two documents are settled; the rest are taken apart once each, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import expect_skew
from .common import saved, ship
from .phrases import by_trigger, press_texts, rolling, text_rows

#: The length in words of a window: passages are over 50 words long.
PASSAGE = 51
#: Starts among which the least hash is the trigger.
SPAN = 24


def word_places(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """``raw, begins, ends``: the words, runs of bytes outside ``[\\x20\\x09-\\x0D]``, joined by one blank, and their places."""
    raw = b" ".join(text.split())
    gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    return raw, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)]))


def word_phrases(raw: bytes, begins: np.ndarray, length: int = PASSAGE, span: int = SPAN):
    """``first, last, trigger``: runs of windows of ``length`` words that have their trigger at the same word.

    The trigger of a window is the word among its first ``span`` from which on the bytes have the least rolling hash (the
    leftmost of equals), so equal windows have theirs at the same place. The last of them and
    the 8 words behind it must fill the hash: ``span`` may be at most ``length`` less 8.
    """
    starts = len(begins) - length + 1
    if starts <= 0:
        none = np.empty(0, np.int64)
        return none, none, none
    hashes = rolling(np.frombuffer(raw, np.uint8))[begins[: starts + span - 1]]
    return by_trigger(hashes, starts, span)


def _digests(raw: bytes, begins: np.ndarray, ends: np.ndarray) -> list[int]:
    digest = xxhash.xxh3_64_intdigest
    return [digest(raw[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]


def _longs(values: list) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, np.int64)


def _parse(length: int, span: int, whole: bool):
    """The core and row of every phrase and, if asked for, its whole and place (first start << 16 | further starts)."""
    core = length - span + 1

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cores, wholes, rows, places = [], [], [], []
            for row, text in zip(batch["row"], batch["text"]):
                raw, begins, ends = word_places(text)
                first, last, trigger = word_phrases(raw, begins, length, span)
                cores += _digests(raw, begins[trigger], ends[trigger + core - 1])
                rows.append(np.full(len(first), row, np.int64))
                if whole:
                    wholes += _digests(raw, begins[first], ends[last + length - 1])
                    places.append(first << 16 | last - first)
            out = {"core": _longs(cores), "row": _joined(rows)}
            yield pd.DataFrame(out | {"whole": _longs(wholes), "place": _joined(places)} if whole else out)

    return work


def _windows(length: int):
    """Every window of the listed phrases of each text: which of its phrase it is, and its digest."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out, windows, skips, sizes = [], [], [], []
            for row, blob, items in zip(batch["row"], batch["blob"], batch["items"]):
                raw, begins, ends = word_places(press.decompress(blob))
                for item in items:
                    first, count = item["place"] >> 16, (item["place"] & 0xFFFF) + 1
                    windows += _digests(raw, begins[first : first + count], ends[first + length - 1 : first + length - 1 + count])
                    skips.append(np.arange(count))
                    sizes.append(count)
                    out.append((item["core"], item["whole"], row, item["high"]))
            phrases = np.array(out, np.int64).reshape(-1, 4).repeat(sizes, axis=0)
            frame = pd.DataFrame(phrases, columns=["core", "whole", "low", "high"])
            yield frame.assign(skip=_joined(skips).astype(np.int64), window=_longs(windows))

    return work


def shared_windows(docs: DataFrame, length: int = PASSAGE, span: int = SPAN) -> DataFrame:
    """``row, place``: runs of windows of ``length`` words that stand in another document too, by row of ``docs``.

    A place is the first window's first word << 16 | further windows. Rows of equal id and text are one document. Words are
    compared byte for byte; a null text has none. Equality is that of two 64-bit hashes, of a core and of the window.
    """
    ship(docs.sparkSession)
    expect_skew(docs.sparkSession)
    texts = text_rows(docs)
    cores = texts.mapInPandas(_parse(length, span, whole=False), "core long, row long")
    held = cores.groupBy("core").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    met = saved(held.filter("low < high").select("core"), "passage-cores")
    parse = texts.mapInPandas(_parse(length, span, whole=True), "core long, row long, whole long, place long")
    left = saved(parse.join(met, "core", "left_semi"), "passage-parse")
    wholes = saved(
        left.groupBy("core", "whole").agg(F.min(F.struct("row", "place")).alias("one"), F.max("row").alias("high")),
        "passage-wholes",
    )
    single, several = F.col("one.row") == F.col("high"), F.col("one.row") < F.col("high")
    settled = left.join(wholes.filter(several).select("core", "whole"), ["core", "whole"], "left_semi")
    apart = (
        wholes.join(wholes.filter(single).select("core").distinct(), "core", "left_semi")
        .select("one.row", F.struct("core", "whole", "one.place", "high").alias("item"))
        .groupBy("row")
        .agg(F.collect_list("item").alias("items"))
    )
    windows = saved(
        texts.mapInPandas(press_texts, "row long, blob binary")
        .join(apart, "row")
        .mapInPandas(_windows(length), "core long, whole long, low long, high long, skip long, window long"),
        "passage-windows",
    )
    again = windows.groupBy("core", "window").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high")
    found = (
        windows.filter("low = high")
        .join(again.select("core", "window"), ["core", "window"], "left_semi")
        .select("core", "whole", "skip")
        .distinct()
    )
    single_places = left.join(found, ["core", "whole"]).select(
        "row", F.shiftleft(F.shiftright("place", 16) + F.col("skip"), 16).alias("place")
    )
    return settled.select("row", "place").union(single_places)
