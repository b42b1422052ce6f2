"""Quality rules: base rules on words and lines, then a calibrated n-gram classifier.

The classifier is a logistic regression on hashed word 1- and 2-grams and character 3- and
4-grams: a text's logit is a constant plus the mean weight of its word n-grams plus the mean
weight of its character n-grams. It is fitted on a bounded sample of labelled rows; a part of
the sample that the weights do not see calibrates the probability (Platt scaling). Texts are
scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.text import chunks, map_batches, mix, split_words, text_key, windows, word_hashes
from tallymark.sources.tables import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"

#: Labelled rows the classifier is fitted on at most: those with the least hashes.
TRAIN_ROWS = 3_000

BITS = 16
WORD_GRAMS = (1, 2)
CHAR_GRAMS = (3, 4)

#: A text is kept at this calibrated probability or more.
THRESHOLD = 0.5

_CHAR_FACTORS = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], np.uint32)


# --- base rules, inside tasks


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of flags between consecutive starts."""
    before = np.concatenate([[0], np.cumsum(flags)])
    return before[starts[1:]] - before[starts[:-1]]


def repeated_words(hashes: np.ndarray, starts: np.ndarray, width: int = 3) -> np.ndarray:
    """For each text the words in windows of `width` words that the text has twice or more."""
    every = windows(hashes, width)
    lengths = np.diff(starts)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    covered = np.zeros(len(hashes), bool)
    if len(every):
        inside = owner[: len(every)] == owner[width - 1 :]
        at = np.flatnonzero(inside)
        keys = every[at] ^ mix(owner[at].astype(np.uint64))
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for step in range(width):
            covered[at[twice] + step] = True
    return _per_text(covered, starts)


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """For each text the lines with a word that are equal to an earlier line."""
    lines = pc.split_pattern(texts, "\n")
    counts = pc.list_value_length(lines).to_numpy()
    coded = lines.flatten().dictionary_encode()
    words = pc.not_equal(pc.ascii_trim_whitespace(coded.dictionary), "").to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(counts)), counts)
    real = words[codes] if len(codes) else np.zeros(0, bool)
    pairs = owner[real].astype(np.int64) * max(len(words), 1) + codes[real]
    first = np.unique(pairs) // max(len(words), 1)
    return np.bincount(owner[real], minlength=len(counts)) - np.bincount(first, minlength=len(counts))


@dataclass
class Counts:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    def failed(self) -> np.ndarray:
        repeats = 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words
        return (self.n_words < MIN_WORDS) | repeats


def base_counts(texts: pa.Array, words: pa.Array, starts: np.ndarray, hashes: np.ndarray) -> Counts:
    letters = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return Counts(
        np.diff(starts),
        _per_text(letters, starts),
        pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64),
        duplicate_lines(texts),
        repeated_words(hashes, starts),
    )


# --- hashed n-grams, inside tasks


def _word_grams(hashes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, starts of the texts in them) for each width."""
    for width in WORD_GRAMS:
        yield _inside(windows(hashes, width) >> np.uint64(64 - BITS), starts, width)


def _inside(grams: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Drops windows that reach over the end of their text."""
    lengths = np.diff(starts)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = owner[: len(grams)] == owner[width - 1 :] if len(grams) else np.zeros(0, bool)
    counts = np.maximum(lengths - width + 1, 0)
    return grams[inside].astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


def _char_grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    letters = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))])
    for width in CHAR_GRAMS:
        count = max(len(letters) - width + 1, 0)
        with np.errstate(over="ignore"):
            total = np.full(count, width, np.uint32)
            for step in range(width):
                total += letters[step : step + count] * _CHAR_FACTORS[step]
            total ^= total >> np.uint32(15)
            total *= np.uint32(2246822507)
            total ^= total >> np.uint32(13)
        yield _inside(total >> np.uint32(32 - BITS), starts, width)


def _groups(texts: pa.Array, hashes: np.ndarray, starts: np.ndarray):
    """The two groups of n-grams whose mean weights are added: of words and of characters."""
    return [list(_word_grams(hashes, starts)), list(_char_grams(texts))]


@dataclass
class Model:
    """weights[group][bucket], a constant, and the calibration of the logit."""

    weights: np.ndarray
    constant: float
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, groups) -> np.ndarray:
        total = None
        for weights, grams in zip(self.weights, groups):
            sums = counts = 0
            for buckets, starts in grams:
                sums = sums + _per_text(weights[buckets].astype(np.float64), starts)
                counts = counts + np.diff(starts)
            means = sums / np.maximum(counts, 1)
            total = means if total is None else total + means
        return total + self.constant

    def probabilities(self, groups) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(groups) + self.shift, -700, 700)))


def constant_model(probability: float) -> Model:
    low = min(max(probability, 1e-6), 1 - 1e-6)
    return Model(np.zeros((2, 1 << BITS), np.float32), float(np.log(low / (1 - low))))


# --- fitting


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean n-gram counts of labelled texts, sparse: buckets of words, then of characters, in two
    bytes each, how many of them are of words, and the values."""
    for batch in batches:
        for part in chunks(batch, "text"):
            texts = pc.fill_null(part.column("text"), "")
            words, starts = split_words(texts)
            groups = _groups(texts, word_hashes(words), starts)
            columns, values, word_buckets = [], [], []
            for row in range(len(texts)):
                own_columns, own_values = [], []
                for grams in groups:
                    own = np.concatenate([b[s[row] : s[row + 1]] for b, s in grams])
                    buckets, counts = np.unique(own, return_counts=True)
                    own_columns.append(buckets.astype(np.uint16))
                    own_values.append((counts / max(len(own), 1)).astype(np.float32))
                word_buckets.append(len(own_columns[0]))
                columns.append(np.concatenate(own_columns).tobytes())
                values.append(np.concatenate(own_values).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("order"),
                    part.column("label"),
                    pa.array(word_buckets, pa.int32()),
                    pa.array(columns, pa.binary()),
                    pa.array(values, pa.binary()),
                ],
                names=["order", "label", "word_buckets", "columns", "values"],
            )


def _platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the logits' probabilities fit the labels (Newton steps on
    smoothed targets)."""
    good, bad = labels.sum(), (1 - labels).sum()
    goal = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    design = np.column_stack([logits, np.ones_like(logits)])
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ found, -50, 50)))
        slope = design.T @ (p - goal) + 1e-3 * (found - [1.0, 0.0])
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        found = found - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(found[0], 1e-3)), float(found[1])


#: Features worked on at once while fitting.
FIT_CHUNK = 500_000


def _cuts(ends: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows that hold about FIT_CHUNK features; one row may hold more."""
    cuts, start = [], 0
    while start < len(ends) - 1:
        end = max(int(np.searchsorted(ends, ends[start] + FIT_CHUNK, "right")) - 1, start + 1)
        cuts.append((start, end))
        start = end
    return cuts


def fit_rows(rows: list[tuple], rounds: int = 150, ridge: float = 1e-7, rate: float = 0.5) -> Model:
    """rows: (order, label, word buckets, columns, values), the last two as arrays. Every fourth row
    calibrates."""
    rows = sorted(rows, key=lambda r: r[0])
    labels = np.array([float(r[1]) for r in rows])
    if not len(rows) or labels.min() == labels.max():
        return constant_model(float(labels.mean()) if len(rows) else 1.0)
    held = np.arange(len(rows)) % 4 == 3
    words = np.array([r[2] for r in rows])
    sizes = np.array([len(r[3]) for r in rows])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    cols = np.concatenate([r[3] for r in rows])
    vals = np.concatenate([r[4] for r in rows])
    del rows  # the driver holds the features once
    size, count = 2 << BITS, len(labels)
    cuts = _cuts(ends)

    def columns_of(start: int, end: int) -> np.ndarray:
        """Columns of some rows: buckets of characters lie behind those of words."""
        lengths = np.stack([words[start:end], sizes[start:end] - words[start:end]], 1).reshape(-1)
        first = np.repeat(np.tile([0, 1 << BITS], end - start), lengths)
        return cols[ends[start] : ends[end]] + first

    def logits_of(weights: np.ndarray, constant: float) -> np.ndarray:
        out = np.full(count, constant)
        for start, end in cuts:
            held_here = slice(ends[start], ends[end])
            owner = np.repeat(np.arange(end - start), np.diff(ends[start : end + 1]))
            part = vals[held_here] * weights[columns_of(start, end)]
            out[start:end] += np.bincount(owner, weights=part, minlength=end - start)
        return out

    learn = ~held
    balance = np.where(labels > 0, 0.5 / max(labels[learn].sum(), 1), 0.5 / max((1 - labels[learn]).sum(), 1))
    balance = np.where(learn, balance, 0.0)
    weights, constant = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(logits_of(weights, constant), -50, 50)))
        error = balance * (p - labels)
        slope = np.append(ridge * weights, error.sum())
        for start, end in cuts:
            held_here = slice(ends[start], ends[end])
            each = np.repeat(error[start:end], np.diff(ends[start : end + 1]))
            slope[:-1] += np.bincount(columns_of(start, end), weights=vals[held_here] * each, minlength=size)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
        weights -= move[:-1]
        constant -= move[-1]
    logits = logits_of(weights, constant)
    slope, shift = 1.0, 0.0
    if 0 < labels[held].sum() < held.sum():
        slope, shift = _platt(logits[held], labels[held])
    return Model(weights.reshape(2, -1).astype(np.float32), float(constant), slope, shift)


def labelled_features(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Features of at most `rows` labelled rows, different in (doc_id, label, text): those with the
    least hashes. A doc_id that many rows share, or one text of it that comes often, adds no more
    than its part of the bound. Null ids, null labels and ids that docs lacks teach nothing."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.select("doc_id", F.col("quality").cast("double").alias("label")).distinct()
    keyed = docs.select("doc_id", text_key().alias("text_key"), "text")
    each = keyed.select("doc_id", "text_key").distinct().join(known, "doc_id")
    order = F.xxhash64("doc_id", "label", "text_key")
    chosen = each.orderBy(order, "doc_id", "label", "text_key").limit(rows)
    chosen = F.broadcast(materialize(chosen, "labelled"))  # at most `rows` rows
    texts = keyed.join(chosen, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key", "label"])
    texts = texts.select(order.alias("order"), "label", "text")
    schema = "order long, label double, word_buckets int, columns binary, values binary"
    return map_batches(texts, _features, schema)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fits the classifier on the labelled rows of docs. labels: doc_id, quality (0 or 1).

    At most `rows` rows are used, see `labelled_features`. Being bounded they meet in one task,
    which fits the weights; the driver gets the model alone. Without both kinds of labels the
    probability is their share (1 where there are none, or no rows)."""
    features = labelled_features(docs, labels, rows).repartition(1)
    schema = "weights binary, constant double, slope double, shift double"
    found = map_batches(features, _fit_task, schema).collect()  # one row, or none
    if not found:
        return fit_rows([])
    weights = np.frombuffer(found[0].weights, np.float32).reshape(2, -1)
    return Model(weights, found[0].constant, found[0].slope, found[0].shift)


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = fit_rows([row for batch in batches for row in _views(batch)])
    row = (model.weights.astype(np.float32).tobytes(), model.constant, model.slope, model.shift)
    types = [pa.binary(), pa.float64(), pa.float64(), pa.float64()]
    columns = [pa.array([value], kind) for value, kind in zip(row, types)]
    yield pa.RecordBatch.from_arrays(columns, names=["weights", "constant", "slope", "shift"])


def _views(batch: pa.RecordBatch) -> list[tuple]:
    """Rows of features whose arrays lie in the batch's own memory."""
    plain = zip(*(batch.column(name).to_pylist() for name in ("order", "label", "word_buckets")))
    arrays = [
        [np.frombuffer(value.as_buffer(), kind) for value in batch.column(name)]
        for name, kind in (("columns", np.uint16), ("values", np.float32))
    ]
    return [(*row, *own) for row, *own in zip(plain, *arrays)]


# --- tables


def _score(model: Model, threshold: float, keep: list[str] | None):
    """Rows of counts and verdicts, or with `keep` the rows themselves that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = pc.fill_null(part.column("text"), "")
                words, starts = split_words(texts)
                hashes = word_hashes(words)
                counts = base_counts(texts, words, starts, hashes)
                failed = counts.failed()
                chance = model.probabilities(_groups(texts, hashes, starts))
                kept = ~failed & (chance >= threshold)
                if keep is not None:
                    yield part.filter(pa.array(kept))
                    continue
                numbers = (
                    counts.n_words,
                    counts.word_chars,
                    counts.n_symbols,
                    counts.n_dup_lines,
                    counts.n_repeat_words,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(n.astype(np.int64)) for n in numbers),
                        pa.array(failed),
                        pa.array(kept),
                        pa.array(chance),
                    ],
                    names=[
                        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "probability",
                    ],
                )

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, probability.

    A null text has no words and fails the base rules. Repeated rows are judged alike; a null
    doc_id stays null; an empty table gives no rows.
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, base_failed boolean, kept boolean, probability double"
    )
    return map_batches(docs.select("doc_id", "text"), _score(model, threshold, None), schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that pass. Rows without words go, whatever their other
    columns hold; repeated rows are judged alike, a null doc_id does not matter, a text is read
    whole, and an empty table stays empty."""
    return map_batches(docs, _score(model, threshold, docs.columns), docs.schema)
