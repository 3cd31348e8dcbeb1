"""Chat formatting: conversations rebuilt from an event log, rendered with a reversible template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightflux.llm.common import batches

#: Template: a turn is OPEN, the role, MIDDLE, the text, CLOSE.
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
ROLE_LOSS = "assistant"
#: Inside roles and texts the escape sign and the first sign of each control string get the escape sign before them.
ESCAPE = "\\"
MARKED = re.compile(r"[\\#<:]")
UNMARK = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Puts the escape sign before itself and before every sign that a control string starts with."""
    return MARKED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return UNMARK.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text starts and ends (both 0 without loss), in code points."""
    head = OPEN + escape(_shown(role)) + MIDDLE
    body = escape(text)
    start = len(head) if role == ROLE_LOSS else 0
    return head + body + CLOSE, start, start + len(body) if start else 0


def _shown(role: str) -> str:
    """Lower-case roles with a capital; others, which that would not give back, after an equals sign."""
    capital = role.capitalize()
    return capital if capital.lower() == role and not role.startswith("=") else "=" + role


def parse(turn: str) -> tuple[str, str]:
    """Role and text back from a rendered turn."""
    at = next(m.start() for m in re.finditer(": ", turn) if turn[m.start() - 1] != ESCAPE or _even(turn, m.start()))
    shown = unescape(turn[len(OPEN) : at])
    role = shown[1:] if shown.startswith("=") else shown.lower()
    return role, unescape(turn[at + len(MIDDLE) : len(turn) - len(CLOSE)])


def _even(text: str, at: int) -> bool:
    """Whether an even number of escape signs stands before a place."""
    n = len(text[:at]) - len(text[:at].rstrip(ESCAPE))
    return n % 2 == 0


def _folded(order: list[str]):
    names = ["conv_id", "place", "role", "turn", "loss_start", "loss_end", "n_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = message = role = None
        place, text, made, size = -1, [], [], 0
        begun = False

        def close() -> None:
            nonlocal size
            if message is not None:
                turn, start, end = render(role or "", "".join(text))
                made.append((conv, place, role or "", turn, start, end, len(turn)))
                size += len(turn)

        def batch_out() -> pa.RecordBatch:
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)
            made.clear()
            size = 0
            return out

        for batch in batches(stream, 2048):
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")), strict=True)
            for owner, kind, by, part in rows:
                if not begun or owner != conv:
                    close()
                    begun, conv, message, place, text = True, owner, None, -1, []
                if kind == "start":
                    close()
                    message, role, text = True, by, []
                    place += 1
                elif kind == "delta":
                    text.append(part or "")
                elif kind == "edit":
                    text = [part or ""]
                elif kind == "regenerate":
                    text = []
                if size > 4_000_000 or len(made) >= 2000:
                    yield batch_out()
        close()
        if made:
            yield batch_out()

    return run


def formatted(events: DataFrame, order: list[str | Column]) -> DataFrame:
    """Final turns of every conversation: ``conv_id``, ``place``, ``role``, ``turn``, ``loss_start``, ``loss_end``, ``n_chars``.

    ``events`` has ``conv_id``, ``kind``, ``role``, ``text`` and the columns of ``order``, which put
    the log of a conversation in sequence.  Kinds: ``start`` opens a message by ``role``, ``delta`` appends to it, ``edit`` sets its text,
    ``regenerate`` empties it; other kinds, and events before the first start, change nothing.  A null text is empty, a null role too.

    The log is partitioned by conversation and sorted by sequence; a task then streams through it and holds one
    message at a time, so a conversation of any length needs no memory.  A turn is one row: the formatted conversation is its
    turns in order, and never has to fit one string.  ``loss_start`` and ``loss_end`` bound the assistant's text in it.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    log = events.withColumn("conv_id", F.col("conv_id").cast("long")).repartition("conv_id").sortWithinPartitions("conv_id", *keys)
    schema = "conv_id long, place long, role string, turn string, loss_start long, loss_end long, n_chars long"
    return log.select("conv_id", "kind", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).mapInArrow(_folded([]), schema)


def digests(turns: DataFrame) -> DataFrame:
    """What the formatted output says of each conversation, parsed back from it: the contract's columns.

    Needs ``conv_id``, ``place``, ``turn``, ``loss_start``, ``loss_end``.  Digests run along a conversation in order, so its turns
    stream through one task, a turn at a time.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, made = None, None, []

        def close() -> None:
            if state:
                made.append((conv, state["n"], state["turns"].hexdigest(), state["loss"], state["mask"].hexdigest(), state["chars"]))

        for batch in batches(stream, 2048):
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "loss_start", "loss_end")), strict=True)
            for owner, turn, start, end in rows:
                if state is None or owner != conv:
                    close()
                    conv, state = owner, {"n": 0, "turns": hashlib.sha256(), "loss": 0, "mask": hashlib.sha256(), "chars": 0}
                role, text = parse(turn)
                masked = unescape(turn[start:end])
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["loss"] += len(masked)
                state["mask"].update(masked.encode())
                state["chars"] += len(turn)
            if len(made) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)
                made.clear()
        close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

    rows = turns.select("conv_id", "place", "turn", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def events_of(conversations: DataFrame) -> DataFrame:
    """An event log of finished conversations (``conv_id, turn, role, text``), as a chat service would have written it.

    A message starts, streams its text in two deltas, and every third one was drafted and regenerated before; so the fold has all
    kinds to undo.  Rows of one turn follow each other by role and text; ``step`` orders the events of a row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    half = (F.length(text) / 2).cast("int")
    event = lambda kind, part: F.struct(F.lit(kind).alias("kind"), part.alias("part"))
    none = F.lit(None).cast("string")
    plain = F.array(event("start", none), event("delta", F.substr(text, F.lit(1), half)), event("delta", F.substr(text, half + 1)))
    again = F.array(event("start", none), event("delta", F.lit("draft")), event("regenerate", none), event("delta", F.lit("x")), event("edit", F.substr(text, F.lit(1), half)), event("delta", F.substr(text, half + 1)))
    rows = conversations.select("conv_id", "turn", "role", text.alias("whole"), F.monotonically_increasing_id().alias("row"), F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == 0, again).otherwise(plain).alias("all"))
    rows = rows.select("conv_id", "turn", "role", "whole", "row", F.posexplode("all").alias("step", "event"))
    return rows.select("conv_id", "turn", "role", F.xxhash64("whole").alias("key"), "row", "step", "event.kind", F.col("event.part").alias("text"))
