"""Packing documents into sequences by best-fit decreasing.

Texts become token ids inside tasks. A document longer than a window is first cut into full
windows, which need no partner; what is left of each document is packed. The rests are dealt
by a hash into groups of about GROUP_ROWS rows, so a group is bounded at any input size, and
best-fit decreasing runs in each group: longest first, each into the open window with the
least room that still takes it. The window is found in a segment tree over remaining room.
With thousands of rests in a group the padding is a small fraction of a percent; cutting
the corpus into groups costs at most a few half-empty windows each.

Only lengths travel: a row of a rest is a few numbers, whatever its text's length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.text import chunks, map_batches
from tallymark.sources.tables import materialize

WINDOW = 2048
END = 1
GROUP_ROWS = 20_000

#: How the vocabulary's pre-tokenizer splits a text. Fixed value.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1
    letters stand for themselves, the other bytes for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _require_applied(file: dict) -> None:
    """Refuse a file that asks for more than is applied here: byte-level letters, split by PATTERN,
    neither normalized nor put behind a space, merged in the order of the ids."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = {"dropout": None, "unk_token": None, "byte_fallback": False, "ignore_merges": False}
    unlike = [name for name, value in plain.items() if model.get(name, value) != value]
    unlike += [name for name in ("continuing_subword_prefix", "end_of_word_suffix") if model.get(name)]
    unlike += [name for name in ("normalizer", "truncation", "padding") if file.get(name)]
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        unlike.append("pre_tokenizer")
    if model.get("type", "BPE") != "BPE" or unlike:
        raise ValueError(f"settings of the tokenizer file that are not applied: {unlike or model.get('type')}")


def load_encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE file without its added tokens. Its ids are the order
    of its merges, which is all that is needed to apply them."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    _require_applied(model)
    special = {token["content"] for token in model.get("added_tokens", [])}
    byte = _bytes_of_letters()
    ranks = {
        bytes(byte[letter] for letter in token): rank
        for token, rank in model["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def added_ids(path: str) -> dict[str, int]:
    """The added tokens of a file, which a text holds wherever it quotes them."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    for token in added:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token with a flag that is not applied: {token}")
    return {token["content"]: token["id"] for token in added}


#: The pre-tokenizer goes back over a run of spaces letter by letter, on a bounded stack.
LONG_RUN = 100_000

#: What \s is to the pre-tokenizer; Python's has four control letters more.
SPACES = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_SPACES = re.compile(f"(?<!{SPACES}){SPACES}{{{LONG_RUN},}}")


class Encoder:
    """Texts to ids. With `added` a quoted added token is its id, else it is text."""

    def __init__(self, path: str, added: bool) -> None:
        self.encoding = load_encoding(path)
        self.added = added_ids(path) if added else {}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.splits = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def __call__(self, text: str) -> list[int]:
        if not any(token in text for token in self.added):
            return self.plain(text)
        ids: list[int] = []
        for at, part in enumerate(self.splits.split(text)):
            ids += [self.added[part]] if at % 2 else self.plain(part)
        return ids

    def plain(self, text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return self.encoding.encode_ordinary(text)
        ids, start = [], 0
        for run in _LONG_SPACES.finditer(text):
            # a run is one piece, without its last space where anything follows
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[start : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            start = end
        return ids + self.encoding.encode_ordinary(text[start:])


def _cut(path: str, window: int, end: int, with_ids: bool, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, added)
        for batch in batches:
            for part in chunks(batch, "text"):
                docs, starts, lengths, checks, totals, ids_out = [], [], [], [], [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array([*encode(text or ""), end], dtype="<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        docs.append(doc)
                        starts.append(start)
                        lengths.append(len(piece))
                        checks.append(zlib.crc32(piece.tobytes()))
                        totals.append(len(ids))
                        if with_ids:
                            ids_out.append(piece.astype(np.int32))
                columns = [pa.array(c, pa.int64()) for c in (docs, starts, lengths, checks, totals)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(ids_out, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    end: int = END,
    with_ids: bool = False,
    added: bool = False,
) -> DataFrame:
    """Documents as token pieces of at most one window: doc_id, start, length, ids_crc32,
    doc_tokens and, on request, the ids. A null text is empty: its one token is the end. Where
    a text quotes an added token of the tokenizer, it is that token with `added` and text without."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""
    run = _cut(tokenizer or default_tokenizer(), window, end, with_ids, added)
    return map_batches(docs.select("doc_id", "text"), run, schema)


class RoomTree:
    """Which remaining rooms have an open window, as a segment tree over 1..window."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.used = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = self.leaves + room
        while node and not self.used[node]:
            self.used[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room that is at least `need`, removed."""
        used, node = self.used, self.leaves + need
        while not used[node]:
            while node & 1:  # a right child: nothing further on at this height
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if used[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.open[room].pop()
        if not self.open[room]:
            used[node] = 0
            while node > 1 and not (used[node] or used[node ^ 1]):
                node >>= 1
                used[node] = 0
        return room, sequence


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """The sequence and the offset of each length, in the given order."""
    tree, count = RoomTree(window), 0
    sequences, offsets = [0] * len(lengths), [0] * len(lengths)
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[at])
        if found is None:
            found, count = (window, count), count + 1
        room, sequence = found
        sequences[at], offsets[at] = sequence, window - room
        if room > lengths[at]:
            tree.add(room - lengths[at], sequence)
    return sequences, offsets


#: A group's sequences are numbered from its number times this.
GROUP_IDS = 1 << 24


def place(cut: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces with sequence_id and offset. cut: a written table with column length."""
    numbered = cut.withColumn("piece", F.monotonically_increasing_id())
    rests = cut.filter(F.col("length") < window).count()
    groups = max(1, -(-rests // group_rows))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        sequences, offsets = best_fit_decreasing(rows["length"].tolist(), window)
        first = int(rows["group"].iloc[0]) * GROUP_IDS
        rows = rows.drop(columns=["group", "piece"])
        return rows.assign(sequence_id=[first + s for s in sequences], offset=offsets)

    group = F.pmod(F.xxhash64("piece"), F.lit(groups))
    rest = numbered.filter(F.col("length") < window).withColumn("group", group)
    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes) + ", sequence_id long, offset long"
    packed = rest.groupBy("group").applyInPandas(pack, schema)
    full = numbered.filter(F.col("length") == window).withColumn(
        "sequence_id", F.lit(groups * GROUP_IDS) + F.col("piece")
    )
    return packed.unionByName(full.drop("piece").withColumn("offset", F.lit(0).cast("long")))


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    end: int = END,
    with_ids: bool = False,
    added: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids). Every token of every document lies in exactly one piece; the pieces of a
    sequence lie one behind the other from 0 and never pass the window. Repeated rows are
    packed as often as they come; a null doc_id stays null. An empty table gives no rows. For
    `added` see `pieces`."""
    cut = materialize(pieces(docs, tokenizer, window, end, with_ids, added), "pieces")
    return place(cut, window)
