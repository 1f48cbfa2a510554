"""Token ids of texts by a public tokenizer file, with a table of pieces already met."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words, and pieces of words of several, that a worker process remembers; the first ones met, common ones among
#: them, stay. It only saves time, and is kept small as idle workers hold their tables.
WORDS = 400_000
PIECES = 100_000
#: Letters that every normaliser leaves alone once they are lower-case.
_LOWER = "a-z\xdf-\xf6\xf8-\xff"
_SIMPLE = re.compile(f"[A-Z\xc0-\xd6\xd8-\xde{_LOWER}\t-\r -~]*")
#: How a tokenizer that PieceIds serves parts its texts, and the same for simple texts.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIMPLE_PARTS = re.compile(f"[{_LOWER}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[!-/:-@\\[-`{{-~]+")


_NONE = np.empty(0, "<u4")


class PieceIds(dict):
    """piece -> its ids as little-endian 32-bit bytes."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.model = tokenizer.model
        letters = [chr(c) for c in [*range(0xDF, 0xF7), *range(0xF8, 0x100)]]
        self.shown = {chr(c): chr(c) for c in range(0x21, 0x7F)}
        self.shown |= {c: tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def ids_of(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(map(self.shown.__getitem__, piece))
        return np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        value = self.ids_of(piece)
        if len(self) < PIECES:
            self[piece] = value
        return value


def _by_pieces(stated: dict) -> bool:
    """Whether a tokenizer file lower-cases, drops blanks and parts texts by _PARTS before its merges."""
    normalizers = (stated.get("normalizer") or {}).get("normalizers", [])
    splits = (stated.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        {"type": "Lowercase"} in normalizers
        and len(splits) == 2
        and splits[0].get("pattern", {}).get("Regex") == _PARTS
        and splits[0].get("invert", False)
        and splits[1].get("type") == "ByteLevel"
    )


class Words(PieceIds):
    """word without blanks -> its ids."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(tokenizer)
        self.piece = PieceIds(tokenizer)

    def __missing__(self, word: str) -> bytes:
        parts = _SIMPLE_PARTS.findall(word)
        value = self.ids_of(word) if parts == [word] else b"".join(map(self.piece.__getitem__, parts))
        if len(self) < WORDS:
            self[word] = value
        return value


class Encoder:
    """Texts to ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.words = Words(self.tokenizer) if _by_pieces(stated) else None
        self.special = [t["content"] for t in stated["added_tokens"]]

    def _simple(self, text: str) -> bool:
        return self.words is not None and bool(_SIMPLE.fullmatch(text)) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Simple texts are looked up word by word, all distinct words of ``texts`` once."""
        out: list[np.ndarray] = [_NONE] * len(texts)
        simple = []
        for at, text in enumerate(texts):
            if text and self._simple(text):
                simple.append(at)
            elif text:
                out[at] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        if not simple:
            return out
        lists = pc.ascii_split_whitespace(pa.array([texts[at].lower() for at in simple], pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        values = list(map(self.words.__getitem__, coded.dictionary.to_pylist()))
        ids = np.frombuffer(b"".join(values), "<u4")
        sizes = np.fromiter(map(len, values), np.int64, count=len(values)) // 4
        starts = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy(zero_copy_only=False)
        size = sizes[word]
        ends = np.cumsum(size)
        ids = ids[np.repeat(starts[word] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate(([0], ends))[lists.offsets.to_numpy()]
        for at, start, end in zip(simple, bounds[:-1], bounds[1:]):
            out[at] = ids[start:end]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
