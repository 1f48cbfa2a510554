"""Secrets in texts: keywords by an Aho-Corasick automaton, anchored patterns beside them, checksums inside them."""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .shingles import LOWER

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _has_crc32(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of those between prefix and checksum, in base 62."""
    body, check = match[2][:-6], match[2][-6:]
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits.encode() == check


def _is_token(match: re.Match) -> bool:
    """The head of the three-part token is JSON that names its algorithm."""
    head = match[1]
    try:
        stated = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(stated, dict) and isinstance(stated.get("alg"), str)


@dataclass(frozen=True)
class Kind:
    """A secret: a pattern anchored at its keywords, what a match must fulfil, and whether case counts in keywords.

    A match that fails still takes its place: the next one of the kind starts behind it.
    """

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]
    any_case: bool = False


#: The base kinds, in their order. A run of hex digits has no keyword; its prefilter is the run itself.
ASSIGN = Kind(
    "assign",
    ("password", "passwd", "secret", "token", "apikey", "api_key"),
    re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE),
    lambda m: len(m[2]) >= 8,
    any_case=True,
)
ACCESS = Kind("access", ("AKIA",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16)
HEX = "hex"
HEX_DIGITS = 32
#: Kinds with an embedded check.
GITHUB = Kind(
    "github",
    ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    re.compile(rb"(gh[pousr]_)([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    _has_crc32,
)
NPM = Kind("npm", ("npm_",), re.compile(rb"(npm_)([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _has_crc32)
JWT = Kind(
    "jwt", ("eyJ",), re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), _is_token
)
KEYED = (ASSIGN, ACCESS, GITHUB, NPM, JWT)
NAMES = ("assign", "access", HEX, "github", "npm", "jwt")
BASE = NAMES[:3]

_HEX_CLASS = bytes(104 if c in b"0123456789abcdef" else 46 for c in range(256))
_HEX_RUN = re.compile(rb"[0-9a-f]+")


class Scanner:
    """Finds the spans of all kinds in one text."""

    def __init__(self, kinds: tuple[Kind, ...] = KEYED):
        self.kinds = kinds
        words: dict[str, list[int]] = {}
        for at, kind in enumerate(kinds):
            for keyword in kind.keywords:
                words.setdefault(keyword.lower(), []).append(at)
        self.automaton = ahocorasick.Automaton()
        for word, at in words.items():
            self.automaton.add_word(word, (len(word), at))
        self.automaton.make_automaton()

    def spans(self, raw: bytes) -> list[tuple[int, int, str]]:
        """``start, end, kind`` in bytes, leftmost and apart within a kind, by start and then by the order of NAMES."""
        found = self._keyed(raw) + self._hex(raw)
        return sorted(found, key=lambda s: (s[0], NAMES.index(s[2]), s[1]))

    def _keyed(self, raw: bytes) -> list[tuple[int, int, str]]:
        hits = sorted(
            (end + 1 - size, at)
            for end, (size, kinds) in self.automaton.iter(raw.translate(LOWER).decode("latin-1"))
            for at in kinds
        )
        found, behind = [], [0] * len(self.kinds)
        for start, at in hits:
            kind = self.kinds[at]
            if start < behind[at]:
                continue
            match = kind.pattern.match(raw, start)
            if match:
                behind[at] = match.end()
                if kind.valid(match):
                    found.append((start, match.end(), kind.name))
        return found

    @staticmethod
    def _hex(raw: bytes) -> list[tuple[int, int, str]]:
        classes, wanted = raw.translate(_HEX_CLASS), b"h" * HEX_DIGITS
        found, at = [], classes.find(wanted)
        while at >= 0:
            end = _HEX_RUN.match(raw, at).end()
            found.append((at, end, HEX))
            at = classes.find(wanted, end)
        return found


def in_characters(raw: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte offsets as code points. Spans are ASCII, so a span is as long in either."""
    if raw.isascii():
        return spans
    out, at, before = [], 0, 0
    for start, end, kind in spans:
        before += len(raw[at:start].decode())
        at = start
        out.append((before, before + end - start, kind))
    return out


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    scanner = Scanner()
    for batch in batches:
        found = []
        for text in batch["text"]:
            raw = text or b""
            found.append([{"start": s, "end": e, "kind": k} for s, e, k in in_characters(raw, scanner.spans(raw))])
        yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": found})


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row of ``docs (doc_id, text)``; spans are ``start, end, kind`` in code points, end exclusive.

    They are ordered by start, then by the order of NAMES. A null or empty text has none, a text may be of any length, rows
    that share a doc_id are scanned each by itself, a null doc_id stays null, other columns are ignored. Rows are
    scanned where they lie: no shuffle, one text at a time.
    """
    ship(docs.sparkSession)
    types = "doc_id string, spans array<struct<start: long, end: long, kind: string>>"
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(_scan, types).withColumn("doc_id", F.col("doc_id").cast("long"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
