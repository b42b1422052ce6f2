"""Token counts by a whole-token shortcut.

Most words of a text are tokens as they stand. Which strings of the vocabulary encode alone as
one token is proved once, offline, by asking the model itself (`whole_tokens`); the set is as
large as the vocabulary and goes to the tasks. A task normalizes a text, splits it into
pre-tokens as the tokenizer's file says, counts those that are in the set and runs the merges
of byte-pair encoding for the rest only, each distinct rest once while it is remembered.

The tokenizer's own library normalizes and merges. Pre-tokens come from a pattern of the file;
the `regex` package runs it, on texts whose every letter it is seen to put in the same class
as the library does. Texts with any other letter go through the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallymark.llm.text import chunks, map_batches

LIMIT = 2048

#: Merged pre-tokens a task remembers before it forgets them all.
REMEMBERED = 200_000

#: A pre-token up to this length is remembered; a longer one is hardly met again.
LONGEST_REMEMBERED = 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _load(path: str) -> tuple[Tokenizer, dict]:
    if not path.endswith(".json"):
        raise ValueError(f"not a file of the tokenizers library: {path}")
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    for token in parts.get("added_tokens") or []:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token with a flag that is not applied: {token}")
    if parts["model"].get("type", "BPE") != "BPE" or parts["model"].get("dropout"):
        raise ValueError("only byte-pair encoding without dropout gives fixed counts")
    return Tokenizer.from_file(path), parts


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    letters stand for themselves, the other bytes for the letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, further = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else further))
        further += byte not in plain
    return letters


def whole_tokens(path: str) -> list[str]:
    """The pre-tokens, in the model's letters, that encode alone as one token. Proved by
    encoding each string of the vocabulary with the model itself."""
    tokenizer, parts = _load(path)
    suffix = parts["model"].get("end_of_word_suffix") or ""
    added = {token["content"] for token in parts.get("added_tokens") or []}
    names = (name for name in parts["model"]["vocab"] if name not in added)
    alone = {name[: len(name) - len(suffix)] for name in names if name.endswith(suffix)} - {""}
    return sorted(piece for piece in alone if len(tokenizer.model.tokenize(piece)) == 1)


def split_pattern(parts: dict) -> str | None:
    """The pattern of a file that keeps its matches and then writes them in byte letters;
    None where the file splits in another way."""
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [step["type"] for step in steps] != ["Split", "ByteLevel"]:
        return None
    split, byte_level = steps
    kept = split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"]
    plain = not byte_level["add_prefix_space"] and not byte_level["use_regex"]
    return split["pattern"]["Regex"] if kept and plain else None


class Counter:
    """Counts the tokens of texts as the library does with add_special_tokens=False."""

    def __init__(self, path: str, whole: Iterable[str]) -> None:
        self.tokenizer, parts = _load(path)
        self.model, self.splitter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.normalizer = self.tokenizer.normalizer
        added = sorted((t["content"] for t in parts.get("added_tokens") or []), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        pattern = split_pattern(parts)
        self.pattern = regex.compile(pattern) if pattern else None
        self.letters = byte_letters()
        self.whole = dict.fromkeys(whole, 1)
        self.by_piece = dict(self.whole)
        self.by_word = self._words(self.whole)
        self.agreed: set[str] = set()
        self.odd: set[str] = set()

    def _words(self, pieces: Iterable[str]) -> dict[str, int]:
        """Pieces read back as text, without those that are only parts of a letter."""
        byte = {letter: value for value, letter in enumerate(self.letters)}
        words = {}
        for piece in pieces:
            if all(letter in byte for letter in piece):
                raw = bytes(byte[letter] for letter in piece)
                try:
                    words[raw.decode()] = 1
                except UnicodeDecodeError:
                    continue
        return words

    def _agrees(self, letter: str) -> bool:
        """Whether pattern and library split alike around a letter, next to each class."""
        for side in "a1! ":
            text = side + letter + side
            ours = [self._in_letters(word) for word in self.pattern.findall(text)]
            if ours != [piece for piece, _ in self.splitter.pre_tokenize_str(text)]:
                return False
        return True

    def _in_letters(self, word: str) -> str:
        return "".join(map(self.letters.__getitem__, word.encode()))

    def _merged(self, known: dict[str, int], key: str, piece: str) -> int:
        count = len(self.model.tokenize(piece))
        if len(key) <= LONGEST_REMEMBERED:
            if len(known) > len(self.whole) + REMEMBERED:
                known.clear()
                known.update(self.whole if known is self.by_piece else self._words(self.whole))
            known[key] = count
        return count

    def _plain(self, text: str) -> int:
        """Tokens of a text between two added tokens."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if not text:
            return 0
        if self.pattern is not None:
            letters = set(text)
            for letter in letters - self.agreed - self.odd:
                (self.agreed if self._agrees(letter) else self.odd).add(letter)
            if not letters & self.odd:
                known, total = self.by_word, 0
                for word in self.pattern.findall(text):
                    count = known.get(word)
                    total += count if count else self._merged(known, word, self._in_letters(word))
                return total
        known, total = self.by_piece, 0
        pieces = self.splitter.pre_tokenize_str(text) if self.splitter is not None else [(text, None)]
        for piece, _ in pieces:
            count = known.get(piece)
            total += count if count else self._merged(known, piece, piece)
        return total

    def __call__(self, text: str) -> int:
        if self.added is None:
            return self._plain(text)
        total, start = 0, 0
        for quoted in self.added.finditer(text):
            total += self._plain(text[start : quoted.start()]) + 1
            start = quoted.end()
        return total + self._plain(text[start:])


def _count(path: str, whole, limit: int):
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, whole.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = [text or "" for text in part.column("text").to_pylist()]
                tokens = [counter(text) for text in texts]
                sizes = [len(text.encode()) for text in texts]
                over = [count > limit for count in tokens]
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64())]
                columns += [pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    tokenizer is a byte-pair file of the tokenizers library, found under the same path on
    every machine. Counts are those of its `encode` without begin, end or added special
    tokens; where a text quotes an added token, that is one token. A null text is empty: no
    byte, no token. Each row is counted by itself, whatever its length: repeated rows and
    ids give a row each, a null doc_id stays null, further columns are left aside, and an
    empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    narrow = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(narrow, _count(path, whole, limit), schema)
