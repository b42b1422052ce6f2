"""Repair of conversations by weighted CYK parsing.

A conversation is legal when its roles read `(s?(ua)+)?`: system first or not at all, then user
and assistant in turn. The grammar of repairs, in Chomsky normal form, has one nonterminal for
each pair of positions (p, q) in that pattern: `p>q` derives the edits that lead from p to q.
Its rules are `p>q -> p>r r>q` and, for one row, Keep, Rerole or Delete. A cell holds for each
nonterminal the least (cost, audit) of its span, audit being the initials of the edits in order.
Inserted rows take no span, so each row's cell is closed under them on both sides. Cells are
combined bottom-up by span length; in a block of BLOCK rows over every split of every span.

No conversation has to fit a task until its result is written. Rows are sorted over all tasks;
a task parses the part of a conversation that it holds and gives one cell, and the few
cells of a conversation are combined in order. Only letters travel to the parser: a row's
role initial and its fault. The digest of the repaired texts runs over a conversation's rows as a
stream, since a hash has no parallel form.

Least audits stay least when spans are joined: two audits of one span and one cost never are
one the beginning of the other, because what the longer has more could only be insertions,
which cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.text import map_batches
from tallymark.sources.tables import materialize

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5

#: Positions in `(s?(ua)+)?`: nothing yet, after system, after user, after assistant.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {
    (BEGIN, "s"): SYSTEM,
    (BEGIN, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
LEGAL_ENDS = (BEGIN, ASSISTANT)
PAIRS = [(p, q) for p in range(4) for q in range(4) if p <= q or (p, q) == (ASSISTANT, USER)]
RULES = [((p, q), (p, r), (r, q)) for p, q in PAIRS for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS]
ROLES = {"u": "user", "a": "assistant"}

#: Rows parsed over every split; longer runs are joined from blocks, two by two.
BLOCK = 8

#: Parsed spans a task remembers before it forgets them all.
REMEMBERED = 50_000

#: Parts of a row's letter: its role initial, then what is wrong with it.
FINE, CUT, GONE = "=", "~", "x"

Cell = dict[tuple[int, int], tuple[int, str]]


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two spans one behind the other."""
    out: Cell = {}
    for pair, first, second in RULES:
        if first in left and second in right:
            a, b = left[first], right[second]
            cost = a[0] + b[0]
            best = out.get(pair)
            if best is None or cost < best[0]:
                out[pair] = (cost, a[1] + b[1])
            elif cost == best[0]:
                out[pair] = min(best, (cost, a[1] + b[1]))
    return out


def better(one: Cell, other: Cell) -> Cell:
    """The least of both, nonterminal by nonterminal."""
    return {
        pair: min(cell[pair] for cell in (one, other) if pair in cell) for pair in PAIRS if pair in one or pair in other
    }


def insertions() -> Cell:
    """The empty span: nothing, or rows put in."""
    once = {(p, q): (COST[INSERT], INSERT) for (p, role), q in MOVES.items() if role in ROLES}
    closed: Cell = {(p, p): (0, "") for p in range(4)}
    while True:
        longer = better(closed, join(closed, once))
        if longer == closed:
            return closed
        closed = longer


INSERTED = insertions()


def row_cell(letter: tuple[str, str]) -> Cell:
    """The cell of one row, given its role initial and fault."""
    initial, fault = letter
    cell: Cell = {(p, p): (COST[DELETE], DELETE) for p in range(4)}
    if fault != GONE:
        more = TRUNCATED_COST if fault == CUT else 0
        reroled = {(p, q): (COST[REROLE] + more, REROLE) for (p, role), q in MOVES.items() if role in ROLES}
        kept = {(p, q): (COST[KEEP] + more, KEEP) for (p, role), q in MOVES.items() if role == initial}
        cell = better(cell, better(reroled, kept))
    return join(join(INSERTED, cell), INSERTED)


def parse_block(letters: tuple[tuple[str, str], ...], known: dict[tuple, Cell]) -> Cell:
    """CYK over one block: every span by length, every split of a span. A span's cell depends on
    its letters alone, so one that `known` has seen, in any conversation, is not built again; known
    holds all spans of what it holds."""
    for length in range(1, len(letters) + 1):
        for start in range(len(letters) - length + 1):
            span = letters[start : start + length]
            if span in known:
                continue
            if length == 1:
                known[span] = row_cell(span[0])
                continue
            cell: Cell = {}
            for split in range(1, length):
                cell = better(cell, join(known[span[:split]], known[span[split:]]))
            known[span] = cell
    return known[letters]


def join_all(cells: list[Cell]) -> Cell:
    """Neighbours are joined two by two, so that a span doubles at each step."""
    while len(cells) > 1:
        pairs = [join(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[2 * len(pairs) :]
    return cells[0] if cells else INSERTED


class Parser:
    """Parses letters as they come and remembers spans it has seen."""

    def __init__(self) -> None:
        self.known: dict[tuple, Cell] = {}

    def block(self, letters: tuple[tuple[str, str], ...]) -> Cell:
        found = self.known.get(letters)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = parse_block(letters, self.known)
        return found

    def add(self, spans: list[tuple[int, Cell]], letters: tuple[tuple[str, str], ...]) -> None:
        """Spans of equal length at the end are joined at once: a counter in base two."""
        spans.append((1, self.block(letters)))
        while len(spans) > 1 and spans[-1][0] == spans[-2][0]:
            size, right = spans.pop()
            _, left = spans.pop()
            spans.append((2 * size, join(left, right)))


def least_repair(cell: Cell) -> tuple[int, str]:
    return min(cell[BEGIN, end] for end in LEGAL_ENDS if (BEGIN, end) in cell)


# --- rows as they come to the repair


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _rows(turns: DataFrame, role: Column, text: Column, copies: Column) -> DataFrame:
    """conv_id, turn, role, text, copies. What a row without copies holds is of no account."""
    there = copies > 0
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, role).otherwise("").alias("role"),
        F.when(there, text).otherwise("").alias("text"),
        copies.cast("long").alias("copies"),
    )


def as_given(turns: DataFrame) -> DataFrame:
    """Turns as rows to repair; a null role or text is one space."""
    return _rows(turns, _text("role"), _text("text"), F.lit(1))


def damage(turns: DataFrame, every: int = 20) -> DataFrame:
    """Turns as rows to repair, spoilt by a checksum of `conv_id:turn`. Of its `every`
    remainders 0 drops a row (it stays without copies, so that its conversation is known), 1
    empties its text, 2 takes its sentence ends, 3 gives it twice, 4 makes its role user. Nulls
    in the checksum, in role and in text are one space."""
    hit = F.crc32(F.concat_ws(":", _text("conv_id"), _text("turn")).cast("binary")) % every
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(_text("text"), "[.!?]", ""))
    return _rows(
        turns,
        F.when(hit == 4, "user").otherwise(_text("role")),
        text.otherwise(_text("text")),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1),
    )


def _words() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256).alias("words")


def _order() -> list[Column]:
    """Rows of a conversation: null turns first, rows of one turn by role and digest of the text."""
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("words")]


def _faults(rows: DataFrame) -> DataFrame:
    """Equal rows as one: conv_id, turn, role, words (a digest of the text), blank, cut,
    copies, first (no equal role and text stands earlier in the conversation).

    The first of equal rows comes from two aggregates whose partial sums are taken before the
    exchange; no key, however frequent, has to meet in a window or a join.
    """
    end = F.substring(F.regexp_replace("text", r"[ \t-\r]+$", ""), -1, 1)
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        _words(),
        (~F.col("text").rlike(r"[^ \t-\r]")).alias("blank"),
        (~end.isin(".", "!", "?")).alias("cut"),
        "copies",
    )
    earliest = (
        narrow.filter("copies > 0")
        .groupBy("conv_id", "role", "words", "blank", "cut")
        .agg(F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("turn"))
        .withColumn("turn", F.when(~F.col("unnumbered"), F.col("turn")))
        .withColumn("copies", F.lit(0).cast("long"))
        .withColumn("first", F.lit(True))
        .drop("unnumbered")
    )
    return (
        narrow.withColumn("first", F.lit(False))
        .unionByName(earliest)
        .groupBy("conv_id", "turn", "role", "words", "blank", "cut")
        .agg(F.sum("copies").alias("copies"), F.bool_or("first").alias("first"))
    )


# --- parsing over sorted rows

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
NEIGHBOURS = ("su", "ua", "au")

_PART = (
    "conv_id long, task int, blank long, duplicate long, truncated long, illegal long, turns long,"
    " first_turn long, last_turn long, head string, tail string, costs array<long>, audits array<string>"
)
_PARSED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(field.split() for field in schema.split(", ")))
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(columns, types)], names=list(names))


class _Part:
    """The rows of one conversation in one task, as far as they have been read."""

    def __init__(self, parser: Parser) -> None:
        self.parser, self.spans, self.letters = parser, [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.head = self.tail = None

    def add(self, turn, role: str, blank: bool, cut: bool, copies: int, first: bool) -> None:
        """Equal rows of one turn. If one of them is sound it is the foremost."""
        if not copies:
            return
        initial, sound = role[:1], first and not blank
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - sound
        self.truncated += sound and cut
        self.illegal += (self.tail is not None and self.tail + initial not in NEIGHBOURS) + copies - 1
        self.head = initial if self.head is None else self.head
        self.tail = initial
        if sound:
            self.letter((initial, CUT if cut else FINE))
        for _ in range(copies - sound):
            self.letter((initial, GONE))

    def letter(self, letter: tuple[str, str]) -> None:
        self.letters.append(letter)
        if len(self.letters) == BLOCK:
            self.flush()

    def flush(self) -> None:
        if self.letters:
            self.parser.add(self.spans, tuple(self.letters))
            self.letters = []

    def row(self, conv, task: int) -> tuple:
        self.flush()
        cell = join_all([cell for _, cell in self.spans])
        costs, audits = zip(*(cell.get(pair, (None, None)) for pair in PAIRS))
        counts = (self.blank, self.duplicate, self.truncated, self.illegal)
        ends = (self.turns, self.first_turn, self.last_turn, self.head, self.tail)
        return (conv, task, *counts, *ends, list(costs), list(audits))


def _parse_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser, part, current, task = Parser(), None, None, 0
    names = ["conv_id", "task", "turn", "role", "blank", "cut", "copies", "first"]
    for batch in batches:
        done = []
        for conv, task, *row in zip(*(batch.column(name).to_pylist() for name in names)):
            if part is None or conv != current:
                if part is not None:
                    done.append(part.row(current, task))
                part, current = _Part(parser), conv
            part.add(*row)
        yield _table(done, _PART)
    if part is not None:
        yield _table([part.row(current, task)], _PART)


#: The largest number a column holds; a wider gap is given as this.
MOST = (1 << 63) - 1


def _joined(parts: list[dict]) -> tuple:
    """One conversation from its parts in order."""
    blank, duplicate, truncated, illegal, turns = (
        sum(part[name] for part in parts) for name in ("blank", "duplicate", "truncated", "illegal", "turns")
    )
    numbered = [part for part in parts if part["first_turn"] is not None]
    turns -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(numbered, numbered[1:]))
    gaps = numbered[-1]["last_turn"] - numbered[0]["first_turn"] + 1 - turns if numbered else 0
    filled = [part for part in parts if part["head"] is not None]
    illegal += sum(a["tail"] + b["head"] not in NEIGHBOURS for a, b in zip(filled, filled[1:]))
    cells = [
        {pair: (cost, audit) for pair, cost, audit in zip(PAIRS, part["costs"], part["audits"]) if cost is not None}
        for part in parts
    ]
    found = (blank, duplicate, truncated, illegal, *least_repair(join_all(cells)))
    return (parts[0]["conv_id"], min(gaps, MOST), *found)


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for batch in batches:
        done = []
        for part in batch.to_pylist():
            if held and part["conv_id"] != held[0]["conv_id"]:
                done.append(_joined(held))
                held = []
            held.append(part)
        yield _table(done, _PARSED)
    if held:
        yield _table([_joined(held)], _PARSED)


#: Rows that one task sorts and parses.
TASK_ROWS = 500_000


def parse(rows: DataFrame) -> DataFrame:
    """conv_id, the COUNTS, cost and audit of every conversation of `damage` or `as_given`."""
    faults = materialize(_faults(rows), "faults")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-faults.count() // TASK_ROWS))
    ordered = faults.repartitionByRange(tasks, *_order()).sortWithinPartitions(*_order())
    parts = map_batches(ordered.withColumn("task", F.spark_partition_id()), _parse_parts, _PART)
    together = parts.repartition("conv_id").sortWithinPartitions("conv_id", "task")
    return map_batches(together, _join_parts, _PARSED)


# --- repaired texts


class _Repaired:
    """A conversation's repaired rows while its rows pass by. Roles follow from the audit
    alone: a new or reroled row is an answer where a user waits for one, else a user's."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.position = audit, 0, BEGIN

    def _new(self, text: str) -> tuple[str, str]:
        initial = "a" if self.position == USER else "u"
        self.position = MOVES[self.position, initial]
        return ROLES[initial], text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._new("")

    def add(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == REROLE:
            yield self._new(text)
        elif edit == KEEP:
            self.position = MOVES[self.position, role[:1]]
            yield role, text


def _stream(rows: DataFrame) -> DataFrame:
    """Each conversation's parse, then its rows in order, all in one task."""
    marks = parse(rows).withColumn("kind", F.lit(0))
    each = rows.filter("copies > 0").withColumn("kind", F.lit(1)).withColumn("words", _words())
    return (
        marks.unionByName(each, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", *_order()[1:])
        .drop("words", "turn", "kind")
    )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[tuple | None, str, str]]]:
    """Batch by batch (parse, "", "") where a conversation begins and (None, role, text) for
    each of its repaired rows; at last a beginning of nothing, which ends the last one."""
    state = None
    parsed = [field.split()[0] for field in _PARSED.split(", ")]
    for batch in batches:
        out: list[tuple[tuple | None, str, str]] = []
        heads = zip(*(batch.column(name).to_pylist() for name in parsed))
        bodies = zip(*(batch.column(name).to_pylist() for name in ("role", "text", "copies")))
        for head, (role, text, copies) in zip(heads, bodies):
            if copies is None:
                if state is not None:
                    out += [(None, *row) for row in state.inserted()]
                out.append((head, "", ""))
                state = _Repaired(head[-1])
                continue
            for _ in range(copies):
                out += [(None, *row) for row in state.add(role, text)]
        yield out
    if state is not None:
        yield [*[(None, *row) for row in state.inserted()], ((), "", "")]


_TURN = "conv_id long, position long, role string, text string"
_REPORT = f"{_PARSED}, repaired_sha256 string, repaired_rows long"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, position = None, 0
    for events in _edited(batches):
        out = []
        for head, role, text in events:
            if head is None:
                position += 1
                out.append((conv, position, role, text))
            elif head:
                conv, position = head[0], 0
        yield _table(out, _TURN)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest, count = (), hashlib.sha256(), 0
    for events in _edited(batches):
        out = []
        for head, role, text in events:
            if head is None:
                digest.update(f"{chr(10) if count else ''}{role}:{text}".encode())
                count += 1
                continue
            if current:
                out.append((*current, digest.hexdigest(), count))
            current, digest, count = head, hashlib.sha256(), 0
        yield _table(out, _REPORT)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations of rows from `as_given` or `damage`: conv_id, position from
    1, role, text. A conversation of which nothing is left has no row."""
    return map_batches(_stream(rows), _turns, _TURN)


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of `as_given` or `damage`: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256 (of the rows of `repair` as `role:text`, one a line)
    and repaired_rows.

    Rows of a null conv_id form one conversation. Rows stand by turn, null turns first, rows of
    one turn by role and then by digest of the text. A null role or text is one space, so the
    text is blank and the role has to go. Repeated rows are duplicates. A role counts by its first
    letter alone; an empty one fits nowhere. Texts may have any length: a task holds one
    batch of rows and one audit, a letter for each edit. Gaps leave null turns out; without any turn
    number there are none. A conversation without rows has zeros, an empty audit and the digest of
    nothing. Further columns are left aside; an empty table gives no rows.
    """
    return map_batches(_stream(rows), _report, _REPORT)
