"""Vector bin packing of token runs into training sequences.

A piece of a document asks for three things at once: tokens, one segment, and loss-bearing tokens. A sequence
is filled by the dot-product heuristic: of all waiting pieces that fit, take the one whose demands point most
along the room that is left; when none fits whole, cut the best one to the room. A sequence that cannot be filled
to its last token gives pieces back until its length is a power of two, so no sequence needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .tokens import encoder


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048


#: The id that ends every document.
END = 1
#: Pieces among which the heuristic chooses; text encoded at a time, in characters.
WAITING = 512
CHUNK = 4_000_000
PIECES = "doc_id long, start long, length long, doc_tokens long, loss_tokens long, sequence_id long, offset long, ids binary"


class Packer:
    """Packs documents as they come; ``rows`` are finished pieces."""

    def __init__(self, limits: Limits, first_sequence: int = 0):
        self.limits, self.sequence = limits, first_sequence
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.waiting: list[tuple] = []  # (doc_id, ids, running loss, start, end)
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray, loss: np.ndarray | None = None) -> None:
        """``loss``: which ids bear loss; all if None."""
        running = np.arange(len(ids) + 1) if loss is None else np.concatenate(([0], np.cumsum(loss)))
        start, full = 0, self.limits.tokens
        while len(ids) - start >= full and running[start + full] - running[start] <= self.limits.loss_tokens:
            self._close([(doc_id, ids, running, start, start + full)])
            start += full
        if start < len(ids):
            self.waiting.append((doc_id, ids, running, start, len(ids)))
        while len(self.waiting) >= WAITING:
            self._fill(WAITING // 2)

    def finish(self) -> None:
        while self.waiting:
            self._fill(0)

    def _demands(self) -> np.ndarray:
        return np.array([(e - s, 1, r[e] - r[s]) for _, _, r, s, e in self.waiting], float).reshape(-1, 3)

    def _fill(self, leave: int) -> None:
        """Fill sequences until at most ``leave`` pieces wait."""
        demands = self._demands()
        alive = np.ones(len(self.waiting), bool)
        back: list[tuple] = []
        while alive.sum() > leave:
            room, taken = self.caps.copy(), []
            while room[0] >= 1 and room[1] >= 1 and alive.any():
                score = np.where(alive, (demands / self.caps) @ (room / self.caps), -1.0)
                fits = alive & (demands <= room).all(axis=1)
                at = int(np.argmax(np.where(fits, score, -1.0) if fits.any() else score))
                doc_id, ids, running, start, end = self.waiting[at]
                stop = end
                if not fits[at]:
                    stop = min(start + int(room[0]), int(np.searchsorted(running, running[start] + room[2], "right")) - 1)
                    stop = min(stop, end)
                    if stop <= start:
                        break
                taken.append((doc_id, ids, running, start, stop))
                room -= (stop - start, 1, running[stop] - running[start])
                if stop < end:
                    self.waiting[at] = (doc_id, ids, running, stop, end)
                    demands[at] = (end - stop, 1, running[end] - running[stop])
                else:
                    alive[at] = False
            taken, rest = self._even(taken)
            self._close(taken)
            back += rest
        self.waiting = [w for w, a in zip(self.waiting, alive) if a] + back

    def _even(self, taken: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        """``taken`` cut to a length that needs no padding, and what was cut off."""
        length = sum(e - s for *_, s, e in taken)
        wanted = length if length == self.limits.tokens else 1 << (length.bit_length() - 1)
        back = []
        while length > wanted:
            doc_id, ids, running, start, end = taken.pop()
            cut = max(start, end - (length - wanted))
            back.append((doc_id, ids, running, cut, end))
            length -= end - cut
            if cut > start:
                taken.append((doc_id, ids, running, start, cut))
        return taken, back

    def _close(self, taken: list[tuple]) -> None:
        offset = 0
        for doc_id, ids, running, start, end in taken:
            loss = int(running[end] - running[start])
            row = (doc_id, start, end - start, len(ids), loss, self.sequence, offset, ids[start:end].tobytes())
            self.rows.append(row)
            offset += end - start
        self.sequence += 1


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), text: str = "text", prompt: str | None = None
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, loss_tokens, sequence_id, offset, ids``.

    ``tokenizer`` is a tokenizer file every executor has. A document is the ids of ``prompt`` (which bear no loss,
    for instruction data; none if None), those of ``text``, and the id 1; a null text is empty, so it is that id
    alone. Every id lies in exactly one piece; ``ids`` holds them as little-endian 32-bit numbers. No sequence breaks
    ``limits``; its length is ``limits.tokens`` or a power of two. Rows that share a doc_id are packed each by
    itself, a null doc_id stays null, an empty table gives no row, and other columns are ignored.

    Nothing is shuffled: each input partition makes sequences of its own, numbered from its partition number
    times 2^33, so a lost task is repeated alone and leaves at most a dozen short sequences. A task holds
    WAITING pieces and one chunk of texts.
    """
    columns = [F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text")]
    columns.append((F.col(prompt) if prompt else F.lit(None).cast("string")).alias("prompt"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).encode
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        names = [c.split()[0] for c in PIECES.split(", ")]

        def finished() -> pd.DataFrame:
            rows, packer.rows = packer.rows, []
            return pd.DataFrame(rows, columns=names)

        for batch in batches:
            rows = list(zip(batch["doc_id"], batch["text"], batch["prompt"]))
            for chunk in _chunks(rows):
                texts, prompts = encode([t or "" for _, t, _ in chunk]), None
                if prompt:
                    prompts = encode([p or "" for *_, p in chunk])
                for at, (doc_id, *_) in enumerate(chunk):
                    lead = prompts[at] if prompts else texts[at][:0]
                    ids = np.concatenate((lead, texts[at], np.array([END], "<u4")))
                    loss = np.arange(len(ids)) >= len(lead) if len(lead) else None
                    packer.add(None if doc_id is None else int(doc_id), ids, loss)
                yield finished()
        packer.finish()
        yield finished()

    ship(docs.sparkSession)
    return docs.select(columns).mapInPandas(work, PIECES)


def _chunks(rows: list[tuple]) -> Iterator[list[tuple]]:
    """``rows`` in runs of about CHUNK characters."""
    chunk, size = [], 0
    for row in rows:
        chunk.append(row)
        size += sum(len(t) for t in row[1:] if t)
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk
