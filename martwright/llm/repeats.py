"""Byte strings that occur more than once in a corpus, by prefix-free parsing.

A rolling hash over the bytes sets triggers, and triggers cut every text into phrases that depend on nothing but the bytes
around them, so equal passages are cut alike wherever they stand. As in prefix-free parsing, the order of all
suffixes of the corpus follows from two smaller ones: where a suffix stands in its phrase, and what follows the
phrase. Here the order is only asked down to a fixed depth, LENGTH bytes: two suffixes are neighbours to that depth if
their first LENGTH bytes are equal. So both smaller orders shrink to groups of equal keys, which Spark counts:

* the parse: a phrase with all the bytes that strings starting in it reach. Met twice, every string that
  starts in it repeats; this settles copies and the inside of passages, one row per phrase;
* the dictionary: what is left are phrases that are new as a whole but share their core with others (at the edges
  of passages). Each distinct one is taken apart once, into the strings that start in it.

A phrase whose core is met once has no repeated string, which settles all ordinary text in the first count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import expect_skew
from .common import saved, ship
from .passages import PASSAGE, shared_windows
from .phrases import by_trigger, merged, press_texts, rolling, text_rows

#: The length in bytes from which strings count as repeated.
LENGTH = 400
#: Starts among which the least hash is the trigger.
SPAN = 192
#: Contexts of one core that a task compares by itself; cores with more are compared string by string in Spark.
KINDS = 2000
#: Starts that are compared together first in those.
BLOCK = 16


def phrases(raw: bytes, length: int = LENGTH, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, trigger``: runs of starts of ``length``-byte strings whose trigger is the same position.

    The trigger of a string is the least rolling hash (the leftmost of equals) among its first ``span`` positions, so
    equal strings have theirs at the same place.
    """
    starts = len(raw) - length + 1
    if starts <= 0:
        none = np.empty(0, np.int64)
        return none, none, none
    hashes = rolling(np.frombuffer(raw, np.uint8))[: starts + span - 1]
    return by_trigger(hashes, starts, span)


def _cores(length: int, span: int):
    core = length - span + 1

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out = []
            for text in batch["text"]:
                out += [digest(text[t : t + core]) for t in phrases(text, length, span)[2].tolist()]
            yield pd.DataFrame({"core": np.array(out, np.uint64).view(np.int64)})

    return work


def _parse(length: int, span: int):
    core = length - span + 1

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            cores, wholes, rows, places = [], [], [], []
            for row, text in zip(batch["row"], batch["text"]):
                first, last, trigger = phrases(text, length, span)
                cores += [digest(text[t : t + core]) for t in trigger.tolist()]
                wholes += [digest(text[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
                rows.append(np.full(len(first), row, np.int64))
                places.append(first << 16 | last - first)
            yield pd.DataFrame(
                {
                    "core": np.array(cores, np.uint64).view(np.int64),
                    "whole": np.array(wholes, np.uint64).view(np.int64),
                    "row": np.concatenate(rows) if rows else np.empty(0, np.int64),
                    "place": np.concatenate(places) if places else np.empty(0, np.int64),
                }
            )

    return work


def _contexts(length: int):
    """The listed phrases of each text, with all the bytes that strings starting in them reach."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for row, blob, items in zip(batch["row"], batch["blob"], batch["items"]):
                text = press.decompress(blob)
                for item in items:
                    first, more = item["place"] >> 16, item["place"] & 0xFFFF
                    reach = text[first : first + more + length]
                    out.append((item["core"], item["kinds"], row, item["place"], item["often"], reach))
            yield pd.DataFrame(out, columns=["core", "kinds", "row", "place", "often", "reach"])

    return work


def _strings(reach: bytes, length: int) -> list[int]:
    digest = xxhash.xxh3_64_intdigest
    return [digest(reach[p : p + length]) for p in range(len(reach) - length + 1)]


def _blocks(length: int, span: int):
    """The starts of every context in blocks of BLOCK, counted from its trigger.

    ``inner`` are the bytes that all strings of a full block share, ``outer`` all bytes that those of the block reach.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out = []
            for core, row, place, often, reach in zip(
                batch["core"], batch["row"], batch["place"], batch["often"], batch["reach"]
            ):
                first, count = place >> 16, (place & 0xFFFF) + 1
                trigger = int(phrases(reach, length, span)[2][0])
                for block in range((trigger - count + 1) // BLOCK, trigger // BLOCK + 1):
                    high, low = trigger - block * BLOCK, trigger - (block + 1) * BLOCK + 1
                    inner = digest(reach[high : low + length])
                    a, b = max(low, 0), min(high, count - 1)
                    outer = digest(reach[a : b + length], seed=b - a)
                    out.append((core, block, _signed(inner), _signed(outer), row, (first + a) << 16 | b - a, often, reach[a : b + length]))
            yield pd.DataFrame(out, columns=_BLOCK_COLUMNS)

    return work


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_BLOCK_COLUMNS = ["core", "block", "inner", "outer", "row", "place", "often", "reach"]
_BLOCK_TYPES = "core long, block int, inner long, outer long, row long, place long, often long, reach binary"


def _take_apart(length: int):
    """Every string of every block, as a row: for cores of any number of contexts."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            strings = [np.array(_strings(r, length), np.uint64).view(np.int64) for r in batch["reach"]]
            sizes = [len(s) for s in strings]
            at = [p + np.arange(n) for p, n in zip(batch["place"].to_numpy() >> 16, sizes)]
            yield pd.DataFrame(
                {
                    "core": np.repeat(batch["core"].to_numpy(), sizes),
                    "string": np.concatenate(strings) if strings else np.empty(0, np.int64),
                    "row": np.repeat(batch["row"].to_numpy(), sizes),
                    "at": np.concatenate(at) if at else np.empty(0, np.int64),
                    "often": np.repeat(batch["often"].to_numpy(), sizes),
                }
            )

    return work


def _runs(found: list[int]) -> list[int]:
    """Neighbouring starts as places."""
    out: list[list[int]] = []
    for at in found:
        if out and out[-1][1] + 1 == at:
            out[-1][1] = at
        else:
            out.append([at, at])
    return [a << 16 | b - a for a, b in out]


def _compare(length: int):
    """Repeated starts of the contexts that are met once, core by core; rows arrive sorted by core."""

    def settle(group: list[tuple]) -> Iterator[tuple[int, int]]:
        seen: dict[int, int] = {}
        for _, place, often, strings in group:
            for s in strings:
                seen[s] = seen.get(s, 0) + often
        for row, place, often, strings in group:
            if often == 1:
                first = place >> 16
                for run in _runs([first + k for k, s in enumerate(strings) if seen[s] > 1]):
                    yield row, run

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        core, group = None, []
        for batch in batches:
            out = []
            for this, row, place, often, reach in zip(
                batch["core"], batch["row"], batch["place"], batch["often"], batch["reach"]
            ):
                if this != core:
                    out += settle(group)
                    core, group = this, []
                group.append((row, place, often, _strings(reach, length)))
            yield pd.DataFrame(out, columns=["row", "place"])
        yield pd.DataFrame(list(settle(group)), columns=["row", "place"])

    return work


def repeated_places(docs: DataFrame, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """``row, place``: runs of starts of repeated strings (first start << 16 | further starts), by row of ``docs``."""
    expect_skew(docs.sparkSession)
    texts = text_rows(docs)
    cores = texts.select("text").mapInPandas(_cores(length, span), "core long")
    met = saved(cores.groupBy("core").count().filter("count > 1").select("core"), "cores")
    parse = texts.mapInPandas(_parse(length, span), "core long, whole long, row long, place long")
    left = saved(parse.join(met, "core", "left_semi"), "parse")
    wholes = saved(
        left.groupBy("core", "whole").agg(
            F.count(F.lit(1)).alias("often"), F.min(F.struct("row", "place")).alias("one")
        ),
        "wholes",
    )
    settled = left.join(wholes.filter("often > 1").select("core", "whole"), ["core", "whole"], "left_semi")
    open_cores = wholes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("often").alias("rarest"))
    apart = (
        wholes.join(open_cores.filter("kinds > 1 and rarest = 1").drop("rarest"), "core")
        .select("one.row", F.struct("core", "kinds", "one.place", "often").alias("item"))
        .groupBy("row")
        .agg(F.collect_list("item").alias("items"))
    )
    blobs = texts.mapInPandas(press_texts, "row long, blob binary")
    contexts = saved(
        blobs.join(apart, "row").mapInPandas(
            _contexts(length), "core long, kinds long, row long, place long, often long, reach binary"
        ),
        "contexts",
    )
    few = (
        contexts.filter(F.col("kinds") <= KINDS)
        .repartition("core")
        .sortWithinPartitions("core")
        .mapInPandas(_compare(length), "row long, place long")
    )
    # Cores of many contexts: the same again with blocks of a phrase for phrases, then the strings of the blocks left.
    blocks = saved(
        contexts.filter(F.col("kinds") > KINDS)
        .drop("kinds")
        .mapInPandas(_blocks(length, span), _BLOCK_TYPES),
        "blocks",
    )
    inner, outer = ["core", "block", "inner"], ["core", "block", "inner", "outer"]
    outers = saved(
        blocks.groupBy(*outer).agg(F.sum("often").alias("times"), F.min(F.struct("row", "place")).alias("one")), "outers"
    )
    whole_blocks = blocks.filter("often = 1").join(outers.filter("times > 1").select(*outer), outer, "left_semi")
    mixed = (
        outers.groupBy(*inner)
        .agg(F.sum("times").alias("met"), F.min("times").alias("rarest"))
        .filter("met > 1 and rarest = 1")
        .select(*inner)
    )
    chosen = outers.join(mixed, inner, "left_semi").select("core", "one.row", "one.place", F.col("times").alias("often"))
    strings = saved(
        blocks.drop("often")
        .join(chosen, ["core", "row", "place"])
        .select("core", "row", "place", "often", "reach")
        .mapInPandas(_take_apart(length), "core long, string long, row long, at long, often long"),
        "strings",
    )
    again = strings.groupBy("core", "string").agg(F.sum("often").alias("times")).filter("times > 1")
    single = (
        strings.filter("often = 1")
        .join(again.select("core", "string"), ["core", "string"], "left_semi")
        .select("row", F.shiftleft("at", 16).alias("place"))
    )
    return settled.select("row", "place").union(few).union(whole_blocks.select("row", "place")).union(single)


def _cut(length: int, passage: int, keep_text: bool):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc_id, blob, places, windows in zip(batch["doc_id"], batch["blob"], batch["places"], batch["windows"]):
                text = press.decompress(blob)
                starts, ends = merged(places, length)
                passages = merged(windows, passage)
                cuts = [0, *np.column_stack((starts, ends)).ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                out.append(
                    (
                        doc_id,
                        len(text),
                        len(text) - len(kept),
                        starts.tolist(),
                        ends.tolist(),
                        hashlib.sha256(kept).hexdigest(),
                        kept if keep_text else None,
                        passages[0].tolist(),
                        passages[1].tolist(),
                    )
                )
            yield pd.DataFrame(out, columns=_CUT)

    return work


_CUT = ["doc_id", "n_bytes", "n_removed", "starts", "ends", "kept_sha256", "kept", "passage_starts", "passage_ends"]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, span: int = SPAN, keep_text: bool = True, passage: int = PASSAGE
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, starts, ends, kept_sha256, kept, passage_starts, passage_ends`` of every row of
    ``docs (doc_id, text)``.

    Every byte under a ``length``-byte string that starts anywhere else too, in any row, is removed. ``starts`` and
    ``ends`` are the removed runs, ``kept`` the bytes left (null unless ``keep_text``). Texts are UTF-8 bytes; a null
    text is empty, shorter ones than ``length`` lose nothing. Rows with equal id and text are two rows: their strings repeat.
    A null doc_id stays null, an empty table gives no row, other columns are ignored.

    ``passage_starts`` and ``passage_ends`` number the words (from 0, ends exclusive) of the passages: maximal runs under
    windows of ``passage`` words that stand in another document too. They are found beside the removal, as such passages may
    be shorter than ``length``, and remove nothing; rows of equal id and text are one document here. ``passage`` is at least 32.

    Four shuffles carry a row per phrase (two about ``span``/2 bytes of text, two about 12 words), three the texts,
    compressed. Equality is that of two 64-bit hashes, of a core and of the whole string. ``span`` may be at most ``length`` less ROLL.
    """
    ship(docs.sparkSession)
    places = repeated_places(docs, length, span).groupBy("row").agg(F.collect_list("place").alias("places"))
    windows = shared_windows(docs, passage).groupBy("row").agg(F.collect_set("place").alias("windows"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    blobs = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), text.alias("text")
    ).mapInPandas(press_texts, "doc_id string, row long, blob binary")
    types = "doc_id string, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept_sha256 string, kept binary, passage_starts array<long>, passage_ends array<long>"
    found = blobs.join(places, "row", "left").join(windows, "row", "left").select("doc_id", "blob", "places", "windows")
    out = found.mapInPandas(_cut(length, passage, keep_text), types)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
