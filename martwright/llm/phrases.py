"""Texts cut into phrases at the least rolling hash, which depends on nothing but the bytes around it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes under the rolling hash.
ROLL = 16

_FACTORS = [np.uint32(pow(0x01000193, 1 << k, 1 << 32)) for k in range(4)]


def rolling(raw: np.ndarray) -> np.ndarray:
    """A hash of the ROLL bytes from each position on, by doubling."""
    out = raw.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)
    out ^= out >> np.uint32(15)
    for k, factor in enumerate(_FACTORS):
        step = 1 << k
        out = out[:-step] * factor + out[step:]
    out ^= out >> np.uint32(16)
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    out *= np.uint32(0xC2B2AE35)
    return out ^ (out >> np.uint32(16))


def by_trigger(hashes: np.ndarray, starts: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, trigger``: runs of the first ``starts`` positions that have the least of their ``span`` hashes in one place."""
    least = (hashes.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    trigger = (least[:starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(trigger)) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change, [starts])) - 1
    return first, last, trigger[first]


def text_rows(docs: DataFrame) -> DataFrame:
    """``row``: what a row is known by, its id and text; equal rows share it."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.xxhash64("doc_id", "text").alias("row"), text.alias("text"))


def press_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield batch.drop(columns="text").assign(blob=[press.compress(t) for t in batch["text"]])


def merged(places: Sequence[int] | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of positions under the strings of ``length`` that start at ``places``; none for null."""
    if places is None or not len(places):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.asarray(places, np.int64)
    first = places >> 16
    order = np.argsort(first, kind="stable")
    start, end = first[order], (first + (places & 0xFFFF) + length)[order]
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))
    return start[new], reach[last]
