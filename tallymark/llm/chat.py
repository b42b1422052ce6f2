"""Chat formatting: a declarative template, a finite-state machine over roles, loss flags.

A conversation's rows stand in the order of their turns in one task and stream through the
machine: no conversation is held in memory, however long. Each turn becomes three segments
(before, text, after); `loss` marks the texts of the template's trained roles. Control
strings of the template inside a text are broken up by a backslash behind their first letter,
so that no text holds one as it stands, for a tokenizer that knows it either. `parse` undoes
that, so the formatted conversation can be read back to its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.text import map_batches


@dataclass(frozen=True)
class Template:
    """What stands around each role's text, who may follow whom, and whose text is trained.

    around: role -> (before, after). A role that has no entry gets `other` with its name, its
    control strings escaped, between the two halves of the opening mark. after: role -> roles
    that may follow; "" is the start. The marks of `around` and `other` are control strings.
    """

    around: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    follows: dict[str, tuple[str, ...]]
    trained: tuple[str, ...]
    last: tuple[str, ...]
    start: str = "<s>"
    escape: str = "\\"
    controls: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self) -> None:
        marks = {self.start, *self.other, *(m for pair in self.around.values() for m in pair)}
        if any(len(mark) == 1 or self.escape in mark for mark in marks):
            raise ValueError("a control string has two letters or more and no escape sign")
        object.__setattr__(self, "controls", tuple(sorted(marks - {""}, key=lambda m: (-len(m), m))))


INST = Template(
    around={
        "system": ("<<SYS>>", "<</SYS>>"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("[ANS]", "</s>"),
    },
    other=("[ROLE]", "[/ROLE]", "[END]"),
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    trained=("assistant",),
    last=("assistant",),
)


def escaper(template: Template) -> Callable[[str], str]:
    """Doubles the escape sign and puts one behind the first letter of every control string,
    of those that overlap too."""
    sign, marks = re.escape(template.escape), "|".join(re.escape(m) for m in template.controls)
    found = re.compile(f"{sign}|(?=(?:{marks})).", re.DOTALL)
    return lambda text: found.sub(lambda m: m[0] + template.escape, text)


def unescaper(template: Template) -> Callable[[str], str]:
    found = re.compile(re.escape(template.escape) + "(.)", re.DOTALL)
    return lambda text: found.sub(lambda m: m[1], text)


@dataclass
class Machine:
    """Accepts the roles of one conversation; counts the turns that may not stand there."""

    template: Template
    state: str = ""
    faults: int = 0
    turns: int = 0

    def step(self, role: str) -> bool:
        fits = role in self.template.follows.get(self.state, ())
        self.state = role
        self.faults += not fits
        self.turns += 1
        return fits

    def valid(self) -> bool:
        return self.turns > 0 and not self.faults and self.state in self.template.last


def segments(template: Template, role: str, text: str, first: bool) -> list[tuple[str, bool]]:
    """(segment, loss) of one turn."""
    escape = escaper(template)
    if role in template.around:
        before, after = template.around[role]
    else:
        opening, closing, after = template.other
        before = opening + escape(role) + closing
    return [
        ((template.start if first else "") + before, False),
        (escape(text), role in template.trained),
        (after, False),
    ]


def parse(template: Template, formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    sign = re.escape(template.escape)
    token = re.compile(f"{sign}.|" + "|".join(re.escape(m) for m in template.controls), re.DOTALL)
    undo = unescaper(template)
    opening = {before: role for role, (before, _) in template.around.items()}
    turns, role, start = [], None, 0
    name_from = None
    for mark in token.finditer(formatted):
        found = mark[0]
        if found.startswith(template.escape) or found == template.start:
            continue
        if role is None and found in opening:
            role, start = opening[found], mark.end()
        elif role is None and found == template.other[0]:
            name_from = mark.end()
        elif role is None and found == template.other[1] and name_from is not None:
            role, start, name_from = undo(formatted[name_from : mark.start()]), mark.end(), None
        elif role is not None:
            turns.append((role, undo(formatted[start : mark.start()])))
            role = None
        else:
            raise ValueError(f"{found!r} does not belong here")
    return turns


# --- tables


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order. Equal turn numbers stand in the order of
    role and text, a null number behind the others, so that a rerun agrees."""
    narrow = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return narrow.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "role", "text"
    )


def _format(template: Template):
    names = ["conv_id", "position", "role", "segment", "loss", "fits"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, current, position = None, None, 0
        for batch in batches:
            out: list[tuple] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))
            for conv, role, text in rows:
                if machine is None or conv != current:
                    machine, current, position = Machine(template), conv, 0
                fits = machine.step(role)
                for segment, loss in segments(template, role, text, machine.turns == 1):
                    out.append((conv, position, role, segment, loss, fits))
                    position += 1
            columns = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def format_chats(turns: DataFrame, template: Template = INST) -> DataFrame:
    """Segments of all conversations: conv_id, position, role, segment, loss, fits.

    position numbers the segments of a conversation; its formatted text is the segments one
    behind the other. loss marks the segments to train on; fits is false for a turn that may
    not follow the one before it. Rows are formatted even where the order of roles is not
    valid. A null text or role is empty; rows of a null conv_id form one conversation, which one
    task reads as a stream, as any: a digest over its turns has no parallel form. Repeated rows are turns of their own; an empty table gives no rows. The rows come out
    partitioned by conversation and in order.
    """
    schema = "conv_id long, position long, role string, segment string, loss boolean, fits boolean"
    return map_batches(_ordered(turns), _format(template), schema)


class _Reader:
    """Reads one conversation back, segment by segment as its text grows, and digests it."""

    def __init__(self, template: Template) -> None:
        self.template = template
        self.turns, self.trained = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.pending: list[str] = []
        self.machine = Machine(template)
        self.undo = unescaper(template)
        ends = {after for _, after in template.around.values()} | {template.other[2]}
        self.ends = re.compile("|".join(re.escape(mark) for mark in sorted(ends - {""})))

    def add(self, segment: str, loss: bool) -> None:
        self.chars += len(segment)
        self.pending.append(segment)
        if loss:
            text = self.undo(segment)
            self.loss_chars += len(text)
            self.trained.update(text.encode())
        if self.ends.search(segment):  # no text holds a mark as it stands
            self.turn_ends()

    def turn_ends(self) -> None:
        """What is pending are whole turns: they are parsed from the formatted text alone."""
        for role, text in parse(self.template, "".join(self.pending)):
            self.machine.step(role)
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        self.pending.clear()

    def row(self, conv) -> tuple:
        self.turn_ends()
        return (
            conv,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.trained.hexdigest(),
            self.chars,
            self.machine.valid(),
        )


def _read(template: Template):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def table(rows: Iterable[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current = None, None
        for batch in batches:
            done = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss")))
            for conv, segment, loss in rows:
                if reader is None or conv != current:
                    if reader is not None:
                        done.append(reader.row(current))
                    reader, current = _Reader(template), conv
                reader.add(segment, loss)
            yield table(done)
        if reader is not None:
            yield table([reader.row(current)])

    return run


def digests(formatted: DataFrame, template: Template = INST) -> DataFrame:
    """One row per conversation, read back from the rows of `format_chats` as they stand."""
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, valid boolean"
    )
    return map_batches(formatted, _read(template), schema)
