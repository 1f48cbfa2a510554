"""Conversations formatted by a compiled template, with the spans that bear loss, and read back again."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, ship
from .template import TURN_END, Escaper, Template

#: The production template: a line for each turn, assistants' texts under the loss.
TURNS = (
    "{% set head = '###' ~ ' ' %}{% for m in messages %}{{ head }}{{ m.role | key }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
CONTROLS = ("###", "</turn>")
KEY_CONTROLS = (":",)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.DOTALL)

#: A formatted conversation is one row until it has this many characters; longer ones go on in further rows.
PART_CHARS = 1_000_000
PARTS = "conv_id string, part long, text string, loss array<struct<start: long, end: long>>, split boolean"
#: Parts of a stretch of turns count on from its number times this.
STRETCH_PARTS = 1 << 32

#: Conversations that hold over a 1,024th of all turns (so there are at most 1,023 of them), and at least so many, are
#: cut into stretches between quantiles of their turn numbers.
HOT_SHARE = 1024
HOT_TURNS = 1000
STRETCHES = 128


def _cuts(turns: DataFrame) -> DataFrame:
    """``conv_id, cuts, last_turn`` of the conversations that hold a large share of all turns."""
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    total = turns.agg(F.count(F.lit(1)).alias("n")).scalar()
    hot = counts.where((F.col("n") >= HOT_TURNS) & (F.col("n") * HOT_SHARE > total)).select(F.col("conv_id").alias("hot_id"))
    fractions = F.array(*[F.lit(k / STRETCHES) for k in range(1, STRETCHES)])
    return (
        turns.join(F.broadcast(hot), F.col("conv_id").eqNullSafe(F.col("hot_id")))
        .groupBy("hot_id")
        .agg(
            F.array_distinct(F.percentile_approx("turn", fractions, F.lit(10 * STRETCHES))).alias("cuts"),
            F.max("turn").alias("last_turn"),
        )
    )


def _ordered(conversations: DataFrame, in_stretches: bool) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").cast("string").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    if in_stretches:
        # Written, so that a task run again finds the same cuts.
        cuts = saved(_cuts(rows.select("conv_id", "turn")), "chat-cuts")

        def stretch(turn: Column) -> Column:
            passed = F.size(F.filter("cuts", lambda cut: cut < turn))
            return F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(passed)

        # At most 1,023 rows of 127 numbers.
        rows = rows.join(F.broadcast(cuts), F.col("conv_id").eqNullSafe(F.col("hot_id")), "left").select(
            "conv_id", "turn", "role", "text", stretch(F.col("turn")).alias("stretch"), stretch(F.col("last_turn")).alias("last")
        )
    else:
        rows = rows.withColumns({"stretch": F.lit(0), "last": F.lit(0)})
    return rows.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "turn", "role", "text")


def _messages(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch["conv_id"], batch["stretch"], batch["last"], batch["role"], batch["text"])


def _frames(rows: Iterator[tuple], columns: list[str], size) -> Iterator[pd.DataFrame]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= PART_CHARS:
            yield pd.DataFrame(held, columns=columns)
            held, total = [], 0
    yield pd.DataFrame(held, columns=columns)


def _parts(chunks: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, list[dict]]]:
    """Rendered chunks as texts with loss spans, cut behind a turn once they are long."""
    texts, spans, length = [], [], 0
    for chunk in chunks:
        if chunk is TURN_END:
            if length >= PART_CHARS:
                yield "".join(texts), spans
                texts, spans, length = [], [], 0
            continue
        text, generated = chunk
        if generated and text:
            spans.append({"start": length, "end": length + len(text)})
        texts.append(text)
        length += len(text)
    if texts or not length:
        yield "".join(texts), spans


def format_conversations(
    conversations: DataFrame, template: str = TURNS, controls=CONTROLS, key_controls=KEY_CONTROLS
) -> DataFrame:
    """``conv_id, part, text, loss``: every conversation as its template renders it.

    ``conversations (conv_id, turn, role, text)`` are put in order of turn (null first), equal turns in order of role
    and text; repeated rows are repeated turns. Null roles and texts are empty; rows without a conv_id are one conversation,
    of id null. ``loss`` are the spans, in code points of ``text``, that the template marks as generation; empty ones are
    left out. A conversation over PART_CHARS goes on in further parts, cut between turns, so a task holds
    one part however long the conversation; ``part`` rises but may leave numbers out. One that holds much of the table is rendered
    in stretches of turns by many tasks (``split``), if the template lets a turn depend on others by ``loop.first`` and ``loop.last`` only;
    rows of one turn number stay together. Other columns are ignored; an empty table gives no row.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = Template(template, controls, key_controls)

        def rows() -> Iterator[tuple]:
            for (conv_id, stretch, last), turns in groupby(_messages(batches), key=lambda m: m[:3]):
                said = ({"role": role, "text": text} for *_, role, text in turns)
                chunks = compiled.render_stretch(said, stretch == 0, stretch == last) if last else compiled.render(said)
                for part, (text, spans) in enumerate(_parts(chunks), int(stretch) * STRETCH_PARTS):
                    yield conv_id, part, text, spans, bool(last)

        yield from _frames(rows(), ["conv_id", "part", "text", "loss", "split"], lambda row: len(row[2]))

    ship(conversations.sparkSession)
    rows = _ordered(conversations, Template(template, controls, key_controls).by_turn)
    return rows.mapInPandas(work, PARTS).withColumn("conv_id", F.col("conv_id").cast("long"))


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the turns that TURNS has written."""
    at = 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        yield Escaper.undo(found[1]), Escaper.undo(found[2])
        at = found.end()


_DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_READ = ["part", *_DIGESTS, "turns", "loss"]
_READ_TYPES = (
    "part long, conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, turns binary, loss binary"
)


def _read_part(text: str, spans) -> tuple[int, bytes, int, bytes]:
    """Turns, what their digest is taken of, characters under the loss, and their bytes."""
    turns = [f"{role}\n{said}\n" for role, said in read_turns(text)]
    loss = "".join(Escaper.undo(text[span["start"] : span["end"]]) for span in spans)
    return len(turns), "".join(turns).encode(), len(loss), loss.encode()


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of conversations that are whole here; the bytes to digest, part by part, of those that are split."""

    def parts() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch["conv_id"], batch["split"], batch["part"], batch["text"], batch["loss"])

    def rows() -> Iterator[tuple]:
        for (conv_id, split), group in groupby(parts(), key=lambda p: p[:2]):
            digests, n_turns, loss_chars, formatted = (hashlib.sha256(), hashlib.sha256()), 0, 0, 0
            for _, _, part, text, spans in group:
                n, turns, chars, loss = _read_part(text, spans)
                if split:
                    yield part, conv_id, n, None, chars, None, len(text), turns, loss
                    continue
                digests[0].update(turns)
                digests[1].update(loss)
                n_turns, loss_chars, formatted = n_turns + n, loss_chars + chars, formatted + len(text)
            if not split:
                yield 0, conv_id, n_turns, digests[0].hexdigest(), loss_chars, digests[1].hexdigest(), formatted, None, None

    yield from _frames(rows(), _READ, lambda row: 1000 + len(row[7] or b""))


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from what ``_read`` gives, in order of part."""

    def found() -> Iterator[tuple]:
        for batch in batches:
            yield from batch[_READ].itertuples(index=False, name=None)

    def rows() -> Iterator[tuple]:
        for conv_id, group in groupby(found(), key=lambda r: r[1]):
            digests, sums = (hashlib.sha256(), hashlib.sha256()), [0, 0, 0]
            for _, _, n_turns, turns_sha256, chars, loss_sha256, formatted, turns, loss in group:
                sums = [a + b for a, b in zip(sums, (n_turns, chars, formatted))]
                if turns_sha256 is None:
                    digests[0].update(turns)
                    digests[1].update(loss)
            hexes = [d.hexdigest() for d in digests] if turns_sha256 is None else [turns_sha256, loss_sha256]
            yield conv_id, sums[0], hexes[0], sums[1], hexes[1], sums[2]

    yield from _frames(rows(), _DIGESTS, lambda row: 1000)


def read_back(formatted: DataFrame) -> DataFrame:
    """What ``format_conversations`` wrote, read from its texts and spans, one row per conversation.

    The parts of a conversation that is not split must stand one after the other, as they do where they were made. Of a
    split one every part is read where it lies; as SHA-256 is sequential, one task then takes the bytes, part by part.
    """
    types = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = formatted.select(F.col("conv_id").cast("string").alias("conv_id"), "split", "part", "text", "loss")
    read = rows.mapInPandas(_read, _READ_TYPES).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return read.mapInPandas(_digest, types).withColumn("conv_id", F.col("conv_id").cast("long"))
