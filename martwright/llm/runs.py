"""Periodic runs of words: stretches that repeat themselves three times or more, by an enhanced suffix array.

Texts whose windows of DEPTH words are all different have no run and go no further than that check. The others are
sorted by their suffixes (ranks by doubling, many texts at once, never across texts), and every LCP interval is
tested for branching tandem repeats: a suffix i of an interval of depth d starts a square of period d that the next
word breaks if the suffix i+d lies in the same interval but under another child. The largest child of an interval need not
be asked, as the other half of each such square is asked from its side, so all checks together are n log n. Intervals
and children are arrays of bounds over the LCP values; no tree is built. Each square is rotated to the left as far as
its period holds, and squares of one stretch are merged into the run of its smallest period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .shingles import WordTable, hashes_of, run_hashes

#: The fewest words of a run, and the fewest times it holds its period.
LEAST = 24
TIMES = 3
#: A run starts with two equal windows of so many words, one period apart: LEAST - q, or 2q of them.
DEPTH = LEAST - LEAST // TIMES
#: Words sorted together; a longer text is sorted by itself.
TOGETHER = 200_000

Run = tuple[int, int, int]


def planted(count: int, doc_id: str | None) -> np.ndarray | None:
    """Which original word stands at each place, for the ids whose texts are made periodic; None for the others."""
    if doc_id is None or count == 0:
        return None
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % count
    p = 1 + (count - a) // (3 + g % 8)
    at = np.arange(count)
    at[a:] = a + (at[a:] - a) % p
    return at


def may_run(hashes: np.ndarray, depth: int = DEPTH) -> bool:
    """Whether any window of ``depth`` words occurs twice."""
    windows = np.sort(run_hashes(hashes, depth))
    return bool((windows[1:] == windows[:-1]).any())


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _suffixes(words: np.ndarray, text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sa, isa, lcp`` of all places; suffixes reach to the ``end`` of their text, ``lcp[0]`` is 0.

    ``levels[k]`` ranks places by their first 2^k words and is kept, so that common prefixes are added up from
    the highest level down.
    """
    count = len(words)
    place = np.arange(count)
    levels = [_dense(text * (int(words.max(initial=0)) + 1) + words)]
    width = 1
    while True:
        rank = levels[-1]
        size = np.bincount(rank)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        # Ranks leave room: a tied group of n suffixes owns the n numbers from its own on.
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        spread = first[rank]
        ahead = tied + width
        within = ahead < end[tied]
        follow = np.where(within, spread[np.minimum(ahead, count - 1)] + 1, 0)
        key = spread[tied] * (count + 2) + follow
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        group_new = np.concatenate(([True], (ranked[1:] // (count + 2)) != (ranked[:-1] // (count + 2))))
        at = np.arange(len(order))
        since_group = at - np.maximum.accumulate(np.where(group_new, at, 0))
        since_first = np.maximum.accumulate(np.where(new, at, 0))
        group_at = at - since_group
        spread[tied[order]] = ranked // (count + 2) + (since_first - group_at)
        levels.append(_dense(spread))
        width *= 2
        if width >= count:
            size = np.bincount(levels[-1])
            if not (size > 1).any():
                break
    isa = levels[-1]
    sa = np.empty(count, np.int64)
    sa[isa] = place
    a, b = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(max(count - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        fits = (a + width <= end[sa[:-1]]) & (b + width <= end[sa[1:]])
        same = np.flatnonzero(fits)
        same = same[levels[k][a[same]] == levels[k][b[same]]]
        common[same] += width
        a[same] += width
        b[same] += width
    return sa, isa, np.concatenate(([0], common)) if count else common


def _smaller_before(values: np.ndarray) -> np.ndarray:
    """The last place before each one with a smaller value, or -1; by jumping along the answers of the others."""
    out = np.arange(len(values)) - 1
    open_ = np.flatnonzero(out >= 0)
    while len(open_):
        open_ = open_[(out[open_] >= 0) & (values[np.maximum(out[open_], 0)] >= values[open_])]
        out[open_] = out[out[open_]]
    return out


def _squares(words: np.ndarray, text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``at, period`` of all branching tandem repeats that stand behind a third copy of their period."""
    sa, isa, lcp = _suffixes(words, text, end)
    count = len(sa)
    split = np.flatnonzero(lcp > 0)
    none = np.empty(0, np.int64)
    if not len(split):
        return none, none
    before = _smaller_before(lcp)
    after = count - 1 - _smaller_before(lcp[::-1])[::-1]
    left, right = before[split], after[split] - 1  # the interval holds the suffixes left..right
    order = np.lexsort((split, right, left))
    split, left, right = split[order], left[order], right[order]
    new = np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
    # Children run from the interval's left end, and from each of its splits, to the next one.
    opens = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    slots = np.arange(len(split)) + number + 1
    total = len(split) + len(opens)
    start = np.empty(total, np.int64)
    start[slots] = split
    firsts = opens + np.arange(len(opens))
    start[firsts] = left[opens]
    owner = np.empty(total, np.int64)
    owner[slots] = number
    owner[firsts] = np.arange(len(opens))
    stop = np.empty(total, np.int64)
    stop[:-1] = start[1:]
    lasts = np.concatenate((firsts[1:], [total])) - 1
    stop[lasts] = right[opens] + 1
    size = stop - start
    # All children but one of the largest size are asked.
    by_size = np.lexsort((size, owner))
    asked = np.ones(total, bool)
    asked[by_size[lasts]] = False
    depth = lcp[split[opens]]
    low, high = left[opens], right[opens]
    # A third copy needs three suffixes in the interval, and no period of it can be longer than a third of a text.
    asked &= (high - low >= TIMES - 1)[owner]
    kids = np.flatnonzero(asked)
    who = np.repeat(kids, size[kids])
    ranks = start[who] + np.arange(len(who)) - np.repeat(np.cumsum(size[kids]) - size[kids], size[kids])
    place, d, of = sa[ranks], depth[owner[who]], owner[who]

    def inside(at: np.ndarray) -> np.ndarray:
        ok = (at >= 0) & (at < count)
        r = isa[np.clip(at, 0, count - 1)]
        return ok & (r >= low[of]) & (r <= high[of])

    def other(at: np.ndarray) -> np.ndarray:
        r = isa[np.clip(at, 0, count - 1)]
        return (r < start[who]) | (r >= stop[who])

    found = []
    for first in (place, place - d):  # the suffix asked starts the square's first half, or its second
        partner = place + d if first is place else first
        hit = inside(partner) & other(partner) & inside(first - d)
        found.append((first[hit], d[hit]))
    at = np.concatenate([f[0] for f in found])
    period = np.concatenate([f[1] for f in found])
    pairs = np.unique(np.stack((period, at), 1), axis=0) if len(at) else np.empty((0, 2), np.int64)
    return pairs[:, 1], pairs[:, 0]


def _rotated(words: np.ndarray, at: int, period: int, floor: int) -> int:
    """The first place from which the period holds up to ``at``; looked for in steps that double."""
    step = 64
    while at > floor:
        low = max(floor, at - step)
        differ = np.flatnonzero(words[low:at] != words[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return at


def runs_of(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """For each text, given as word numbers: its runs ``(start, length, period)`` by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.concatenate(texts) if texts else np.empty(0, np.int64)
    stops = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    found: list[list[Run]] = [[] for _ in texts]
    if not len(words):
        return found
    ended: dict[int, list[tuple[int, int]]] = {}
    for at, period in zip(*(a.tolist() for a in _squares(words, text, stops[text]))):  # the smallest periods first
        end, number = at + 2 * period, int(text[at])
        known = ended.setdefault(end, [])
        if any(start <= at and period % q == 0 for start, q in known):
            continue
        floor = int(stops[number] - sizes[number])
        start = _rotated(words, at, period, floor)
        known.append((start, period))
        if end - start >= max(least, times * period):
            found[number].append((start - floor, end - start, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def _best(runs: list[Run]) -> Run | None:
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_TYPES = (
    "doc_id string, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, starts array<long>, lengths array<long>, periods array<long>, collapsed binary"
)
_COLUMNS = [part.split()[0] for part in _TYPES.split(", ")]


def _row(doc_id: str | None, words: list[bytes], runs: list[Run], keep_text: bool) -> tuple:
    count = len(words)
    if runs:
        dropped = np.zeros(len(words), bool)
        for start, length, period in runs:
            dropped[start + period : start + length] = True
        words = [words[k] for k in np.flatnonzero(~dropped).tolist()]
    collapsed = b" ".join(words)
    best = _best(runs)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id,
        count,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(collapsed).hexdigest(),
        [r[0] for r in runs],
        [r[1] for r in runs],
        [r[2] for r in runs],
        collapsed if keep_text else None,
    )


def _work(plant: bool, keep_text: bool):
    def settled(group: list[tuple]) -> Iterator[tuple]:
        numbers = []
        for _, words in group:
            known: dict[bytes, int] = {}
            numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, count=len(words)))
        for (doc_id, words), runs in zip(group, runs_of(numbers)):
            yield _row(doc_id, words, runs, keep_text)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=_COLUMNS)
        whole = ["n_words", "n_runs", "start", "length", "period", "exponent_milli"]
        return out.astype({c: "Int64" for c in whole})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = WordTable()
        for batch in batches:
            rows, group, held = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = text.split()
                at = planted(len(words), doc_id) if plant else None
                hashes = hashes_of(words, table)
                if at is not None:
                    hashes, words = hashes[at], [words[k] for k in at.tolist()]
                if not may_run(hashes):
                    rows.append(_row(doc_id, words, [], keep_text))
                    continue
                group.append((doc_id, words))
                held += len(words)
                if held >= TOGETHER:
                    rows += settled(group)
                    group, held = [], 0
            rows += settled(group)
            yield frame(rows)

    return work


def periodic_runs(docs: DataFrame, plant: bool = False, keep_text: bool = True) -> DataFrame:
    """The runs of every row of ``docs (doc_id, text)``.

    ``n_words, n_runs``; ``start, length, period, exponent_milli`` of the run with the greatest length by period (the
    first of equals, then the one with the smaller period; null without runs); ``runs_sha256, collapsed_sha256``; ``starts, lengths,
    periods`` of all runs by start, then period; ``collapsed``, the words outside later copies joined by one space (null unless
    ``keep_text``). Words are runs of characters other than [\\x20\\x09-\\x0D], compared as they are.

    With ``plant``, texts whose id has a CRC-32 divisible by ten are made periodic first. Null texts have no words; rows with a null
    doc_id are never planted and keep their null; equal rows each get their row; an empty table gives none; other columns are ignored.
    Rows are worked on where they lie, without a shuffle, so no id, source or group of copies can be hot.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    return rows.mapInPandas(_work(plant, keep_text), _TYPES).withColumn("doc_id", F.col("doc_id").cast("long"))
