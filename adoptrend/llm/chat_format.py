"""Conversations as training text, through a template that is only ever called, never looked into.

A template is a function from turns ``[(role, text), ...]`` to text. Successive beginnings of a
conversation are rendered, and each output is compared with the one before: what the output adds is
the turn's span. A second rendering of each beginning, with a text no conversation holds in place
of the last one, shows where in that span the turn's own text lies, so that marks are never part of a
loss mask. A template that changes what an earlier output had settled rewrites history; such
conversations are reported, with the first turn at which it happened.

``bracketed`` is the template of the registered query. Inside texts, its control strings are broken by
a backslash, and backslashes are doubled, which ``unescaped`` takes back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import arrow_batches
from adoptrend.session import cut

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

# the control strings of the template; each begins with a character that none has further in
BOS, EOS = "<s>", "</s>"
USER, USER_END = "[INST]", "[/INST]"
SYSTEM, SYSTEM_END = "[SYS]", "[/SYS]"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
CONTROLS = (BOS, EOS, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, ROLE_END)

_BREAK = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)]))
_MARK = re.compile("|".join(map(re.escape, CONTROLS)))

LOSS_ROLE = "assistant"
# a character for private use: the probe is longer than any run of it in the conversation
PROBE = "\ue000"


def escaped(text: str) -> str:
    if not ("\\" in text or "<" in text or "[" in text):
        return text
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def unescaped(text: str) -> str:
    # a doubled backslash is one, any other one broke a control string
    return re.sub(r"\\(\\?)", r"\1", text)


def bracketed(turns: Turns) -> str:
    parts = [BOS]
    for role, text in turns:
        text = escaped(text)
        if role == "user":
            parts += [USER, " ", text, " ", USER_END]
        elif role == "system":
            parts += [SYSTEM, " ", text, " ", SYSTEM_END]
        elif role == "assistant":
            parts += [" ", text, EOS]
        else:
            parts += [ROLE, escaped(role), ROLE_END, text, EOS]
    return "".join(parts)


def read_back(formatted: str) -> Turns:
    """The turns that ``bracketed`` was given."""

    def take(at: int, mark: str) -> tuple[str, int]:
        """What lies between here and the next control string, which has to be ``mark``."""
        found = _MARK.search(formatted, at)
        if found is None or found[0] != mark:
            raise ValueError(f"no {mark} after {at}")
        return formatted[at : found.start()], found.end()

    def inner(text: str) -> str:
        if not (len(text) > 1 and text[0] == text[-1] == " "):
            raise ValueError("no space inside a mark")
        return unescaped(text[1:-1])

    if not formatted.startswith(BOS):
        raise ValueError("no beginning")
    turns, at = [], len(BOS)
    while at < len(formatted):
        if formatted.startswith(USER, at):
            text, at = take(at + len(USER), USER_END)
            turns.append(("user", inner(text)))
        elif formatted.startswith(SYSTEM, at):
            text, at = take(at + len(SYSTEM), SYSTEM_END)
            turns.append(("system", inner(text)))
        elif formatted.startswith(ROLE, at):
            role, at = take(at + len(ROLE), ROLE_END)
            text, at = take(at, EOS)
            turns.append((unescaped(role), unescaped(text)))
        else:
            text, at = take(at, EOS)
            if not text.startswith(" "):
                raise ValueError("no space before an answer")
            turns.append(("assistant", unescaped(text[1:])))
    return turns


def _alike(one: str, other: str) -> int:
    """Characters at which two texts begin alike."""
    if other.startswith(one):
        return len(one)
    return len(os.path.commonprefix([one, other]))


def spans(turns: Turns, template: Template) -> tuple[str, list[tuple[int, int, int, int]], int | None]:
    """The rendered conversation, ``(start, end, text_start, text_end)`` of each turn, and where history is rewritten.

    A turn's span is what its rendering adds to that of the turns before; marks that only close the
    last output, and are gone from or move in the next, don't count as history. The text's place is
    where the probe stands when it is rendered instead; it is empty where the template drops the
    text. From the turn (from 0) at which history is rewritten the conversation has no spans; the
    third result is None where it never is. Work grows with turns times length of the output.
    """
    longest = max((len(run) for turn in turns for said in turn for run in re.findall(f"{PROBE}+", said)), default=0)
    probe = PROBE * (longest + 1)
    before, settled, found = template([]), 0, []
    for k in range(1, len(turns) + 1):
        out = template(turns[:k])
        start = _alike(before, out)
        if start < settled:
            return template(turns), [], k - 1
        probed = template([*turns[: k - 1], (turns[k - 1][0], probe)])
        place = probed.find(probe, start)
        tail = len(probed) - place - len(probe)
        text_end = len(out) - tail
        if place >= 0 and text_end >= place and out[:place] == probed[:place] and out[text_end:] == probed[place + len(probe) :]:
            settled = text_end
        else:
            # the text has no place of its own; nothing of it may be learned
            place = text_end = len(out)
        if found:
            found[-1] = (found[-1][0], start, *found[-1][2:])
        found.append((start, len(out), place, text_end))
        before = out
    return before, found, None


FORMATTED = (
    "conv_id long, n_turns long, formatted string, rewritten_at int, "
    "spans array<struct<role:string,start:int,end:int,text_start:int,text_end:int>>"
)


def chat_format(
    turns: DataFrame,
    template: Template = bracketed,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv_id, n_turns, formatted, rewritten_at, spans)``, one row per conversation, rendered when it is read.

    Spans are those of ``spans``, in code points of ``formatted``, with the role of each turn.
    Where ``rewritten_at`` is not null the template rewrites history and there are no spans. Turns go
    by number, absent first; equal numbers by role, then text; repeated rows are turns each time.
    Absent roles and texts are empty; rows without conversation id are one conversation. No rows
    give no rows. A conversation is one text in the end, so it has to fit in a task.
    """
    row = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    listed = turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), row.alias("turn")).groupBy("conv_id")
    listed = listed.agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    parts = pa.struct([("role", pa.string()), *((n, pa.int32()) for n in ("start", "end", "text_start", "text_end"))])

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, listed in zip(batch.column("conv_id").to_pylist(), batch.column("turns"), strict=True):
                said = [(t["role"], t["text"]) for t in listed.as_py()]
                out, placed, rewritten = spans(said, template)
                named = [dict(zip(parts.names, (role, *p), strict=True)) for (role, _), p in zip(said, placed, strict=False)]
                rows.append((own, len(said), out, rewritten, named))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "n_turns", "formatted", "rewritten_at", "spans"]
            )

    return listed.mapInArrow(formatted, FORMATTED)


def digests(formatted: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """What the outputs of ``bracketed`` say when they are read again, and the text under the loss mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                out = row["formatted"]
                said = read_back(out)
                whole = "".join(f"{role}\n{text}\n" for role, text in said)
                loss = "".join(unescaped(out[s["text_start"] : s["text_end"]]) for s in row["spans"] if s["role"] == loss_role)
                sha = [hashlib.sha256(t.encode()).hexdigest() for t in (whole, loss)]
                rows.append((row["conv_id"], len(said), sha[0], len(loss), sha[1], len(out)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    with arrow_batches(formatted.sparkSession):
        return cut(formatted.select("conv_id", "formatted", "spans").mapInArrow(read, kinds))
