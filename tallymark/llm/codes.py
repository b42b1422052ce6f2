"""Compact codes of vectors: each part of a vector becomes the index of a codebook entry.

Vectors become integers and are cut into equal parts. The parts of one position are sorted along
a Hilbert curve and lie in flat blocks; a block keeps the box around its parts and their sums. In
a round of k-means every block first compares its box with the codebook: an entry that is farther
than another one everywhere in the box is struck off. Where one entry is left the block's sums
go to it as a whole and no part is looked at; otherwise the parts are compared with the entries
on the short list alone, in integers. Since blocks hold neighbours, short lists are short.

All arithmetic is exact, so codebooks and codes do not depend on blocks, tasks or their order. A
round sends one sum per entry and component from each task, never a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.text import map_batches
from tallymark.sources.tables import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

#: Parts in a block.
BLOCK_ROWS = 256

#: Parts that one task sorts: some tens of megabytes.
TASK_PARTS = 1_000_000

#: Larger components are held to this, so that the sums of a block are 64-bit numbers.
LARGEST = 1 << 54

#: A squared distance is held to this, so that a vector's error stays a 64-bit number.
FARTHEST = 1 << 59

#: Labels up to this many are joined by broadcast.
FEW_LABELS = 100_000


# --- vectors as integers


def integers(vectors: DataFrame, vector: str, scale: int, parts: int) -> DataFrame:
    """row, vec_id, label, x: the vectors that take part, written once so that `row` stays."""
    limit = F.lit(float(LARGEST))

    def finite(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, limit), -limit)).cast("long")

    kept = vectors.filter(F.col(vector).isNotNull() & F.forall(vector, finite)).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.transform(vector, whole).alias("x"),
    )
    numbered = materialize(kept, "integers")
    lengths = numbered.groupBy(F.size("x").alias("n")).count().filter(f"n > 0 and n % {parts} = 0")
    usual = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    return numbered.filter(F.size("x") == (usual.n if usual else -1))


class Range:
    """What the components of a table need: the kind of number and the scale of the curve."""

    def __init__(self, low: int, high: int, mean: float, spread: float, width: int) -> None:
        most = max(abs(low), abs(high))
        self.cell = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        #: Differences of squared distances stay below 8 * width * most ** 2.
        self.number = np.int64 if 8 * width * most**2 < 1 << 62 else object
        self.low, self.span = mean - 4 * spread, max(8 * spread, 1.0)
        self.width = width
        self.axes = min(width, 62)
        self.bits = max(1, min(16, 62 // self.axes))

    def curve(self, cells: np.ndarray) -> np.ndarray:
        """Places on the curve of parts given as rows."""
        steps = (1 << self.bits) - 1
        scaled = (cells[:, : self.axes].astype(np.float64) - self.low) * (steps / self.span)
        return hilbert(np.clip(scaled, 0, steps).astype(np.int64), self.bits)


def measure(numbered: DataFrame, parts: int) -> Range | None:
    total = lambda f: F.aggregate("x", F.lit(0.0), lambda a, x: a + f(x.cast("double")))
    found = numbered.agg(
        F.min(F.array_min("x")).alias("low"),
        F.max(F.array_max("x")).alias("high"),
        F.max(F.size("x")).alias("n"),
        (F.sum(total(lambda x: x)) / F.sum(F.size("x"))).alias("mean"),
        (F.sum(total(lambda x: x * x)) / F.sum(F.size("x"))).alias("square"),
    ).first()
    if found.n is None:
        return None
    spread = max(found.square - found.mean**2, 0.0) ** 0.5
    return Range(found.low, found.high, found.mean, spread, found.n // parts)


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row on the Hilbert curve through a cube of 2 ** bits a side.

    Axes are turned and mirrored from the coarsest bit to the finest, then read as a Gray code,
    bit by bit over all axes."""
    axes = axes.T.copy()
    count = len(axes)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in range(count):
            upper = (axes[axis] >> bit & 1).astype(bool)
            swap = np.where(upper, 0, (axes[0] ^ axes[axis]) & below)
            axes[0] ^= np.where(upper, below, swap)
            if axis:
                axes[axis] ^= swap
    for axis in range(1, count):
        axes[axis] ^= axes[axis - 1]
    flip = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0)
    axes ^= flip
    place = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(count):
            place = place << 1 | axes[axis] >> bit & 1
    return place


# --- blocks

_PARTS = "part int, place long, row long, cells binary"
_BLOCKS = (
    "part int, count int, low array<long>, high array<long>, sums array<long>, rows binary, cells binary"
)
_LONGS = pa.list_(pa.int64())


def _cut(scope: Range, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            cells = flat.reshape(batch.num_rows, parts, scope.width)
            rows = batch.column("row")
            for part in range(parts):
                own = np.ascontiguousarray(cells[:, part, :])
                raw = own.astype(scope.cell).tobytes()
                step = len(raw) // len(own)
                columns = [
                    pa.array(np.full(len(own), part, np.int32)),
                    pa.array(scope.curve(own)),
                    rows,
                    pa.array([raw[at : at + step] for at in range(0, len(raw), step)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "place", "row", "cells"])

    return run


def _lay(scope: Range):
    """Sorted parts into blocks of BLOCK_ROWS; a block holds parts of one position."""

    def block(part: int, rows: list[int], cells: list[bytes]) -> tuple:
        raw = b"".join(cells)
        values = np.frombuffer(raw, scope.cell).reshape(len(rows), scope.width).astype(np.int64)
        box = values.min(0).tolist(), values.max(0).tolist()
        return part, len(rows), *box, values.sum(0).tolist(), np.array(rows, "<i8").tobytes(), raw

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), _LONGS, _LONGS, _LONGS, pa.binary(), pa.binary()]
        names = [field.split()[0] for field in _BLOCKS.split(", ")]
        current, rows, cells = None, [], []
        for batch in batches:
            done = []
            for part, row, cell in zip(*(batch.column(c).to_pylist() for c in ("part", "row", "cells"))):
                if rows and (part != current or len(rows) == BLOCK_ROWS):
                    done.append(block(current, rows, cells))
                    rows, cells = [], []
                current = part
                rows.append(row)
                cells.append(cell)
            columns = list(zip(*done)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        if rows:
            columns = zip(block(current, rows, cells))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def lay_blocks(numbered: DataFrame, scope: Range, parts: int) -> DataFrame:
    """The parts of all vectors in blocks, sorted by position and place on the curve. Equal parts
    may be any number: the row, which is unique, parts them among the tasks."""
    cut = map_batches(numbered.select("row", "x"), _cut(scope, parts), _PARTS)
    tasks = max(numbered.sparkSession.sparkContext.defaultParallelism, numbered.count() * parts // TASK_PARTS)
    ordered = cut.repartitionByRange(tasks, "part", "place", "row").sortWithinPartitions("part", "place", "row")
    return materialize(map_batches(ordered.drop("place"), _lay(scope), _BLOCKS), "blocks")


# --- rounds


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Indexes, ascending, of the entries that may be nearest to some point of a box.

    An entry goes if its least distance from the box is more than the greatest of another one,
    or if it is farther than the entry nearest to the box's middle at every point of the box.
    Entries that tie anywhere stay."""
    zero = low - low
    least = (np.maximum(np.maximum(low - entries, entries - high), zero) ** 2).sum(1)
    most = (np.maximum(np.abs(entries - low), np.abs(high - entries)) ** 2).sum(1)
    stay = np.flatnonzero(least <= most.min())
    if len(stay) > 1:
        rest = entries[stay]
        middle = (low + high) // 2
        best = rest[((rest - middle) ** 2).sum(1).argmin()]
        slope = rest - best
        # |x - best|^2 - |x - rest|^2 at its greatest, in the corner that the slope points to
        lead = (best**2).sum() - (rest**2).sum(1) + 2 * np.where(slope > 0, high * slope, low * slope).sum(1)
        stay = stay[lead >= 0]
    return stay


def nearest(cells: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first of the nearest entries and its squared distance."""
    distances = ((cells[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    found = distances.argmin(1)
    return found, distances[np.arange(len(cells)), found]


def _numbers(column: list, scope: Range) -> np.ndarray:
    return np.array(column, np.int64).astype(scope.number)


def _cells(raw: bytes, scope: Range) -> np.ndarray:
    return np.frombuffer(raw, scope.cell).reshape(-1, scope.width).astype(np.int64).astype(scope.number)


_SUMS = "part int, entry int, position int, total decimal(38,0), count long"


def _sum_up(scope: Range, codebooks: np.ndarray):
    """One round in one task: how much and how many parts each entry gets."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width), scope.number)
        counts = np.zeros((parts, entries), np.int64)
        names = ["part", "count", "low", "high", "sums", "cells"]
        for batch in batches:
            for part, count, low, high, sums, cells in zip(*(batch.column(c) for c in names)):
                part, book = part.as_py(), codebooks[part.as_py()]
                stay = shortlist(_numbers(low.as_py(), scope), _numbers(high.as_py(), scope), book)
                if len(stay) == 1:
                    totals[part, stay[0]] += _numbers(sums.as_py(), scope)
                    counts[part, stay[0]] += count.as_py()
                    continue
                values = _cells(cells.as_py(), scope)
                found, _ = nearest(values, book[stay])
                chosen = (found[None, :] == np.arange(len(stay))[:, None]).astype(scope.number)
                totals[part, stay] += chosen @ values
                counts[part, stay] += np.bincount(found, minlength=len(stay))
        part, entry = np.nonzero(counts)
        each = [np.repeat(index, width) for index in (part, entry)]
        total = [Decimal(int(value)) for value in totals[part, entry].reshape(-1)]
        columns = [pa.array(index.astype(np.int32)) for index in each]
        columns.append(pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))))
        columns.append(pa.array(total, pa.decimal128(38, 0)))
        columns.append(pa.array(np.repeat(counts[part, entry], width)))
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "position", "total", "count"])

    return run


def next_round(blocks: DataFrame, scope: Range, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floors of their parts' means; unused entries stay."""
    sums = map_batches(blocks.drop("rows"), _sum_up(scope, codebooks), _SUMS)
    moved = codebooks.copy()
    totals = sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("count").alias("n"))
    for r in totals.collect():  # one number for each component of a codebook
        moved[r.part, r.entry, r.position] = int(r.total) // r.n
    return moved


def _code(scope: Range, codebooks: np.ndarray):
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, low, high, rows, cells in zip(*(batch.column(c) for c in ("part", "low", "high", "rows", "cells"))):
                book = codebooks[part.as_py()]
                stay = shortlist(_numbers(low.as_py(), scope), _numbers(high.as_py(), scope), book)
                found, distances = nearest(_cells(cells.as_py(), scope), book[stay])
                bits = stay[found].astype(np.uint64) << np.uint64(8 * (parts - 1 - part.as_py()))
                columns = [
                    pa.array(np.frombuffer(rows.as_py(), "<i8")),
                    pa.array(bits.view(np.int64)),
                    pa.array(np.minimum(distances, FARTHEST).astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "bits", "error"])

    return run


# --- the operator


def digest(codebooks: np.ndarray) -> str:
    """Hex SHA-256 of all components by part, entry and position, as decimals with commas."""
    return hashlib.sha256(",".join(str(int(value)) for value in codebooks.reshape(-1)).encode()).hexdigest()


def start(numbered: DataFrame, scope: Range, parts: int, entries: int) -> np.ndarray:
    """Codebooks of the parts of the vectors with the smallest ids."""
    first = numbered.orderBy(F.col("vec_id").asc_nulls_last(), "x", "row").limit(entries).select("x").collect()
    vectors = np.array([r.x for r in first], np.int64).astype(scope.number)
    return vectors.reshape(len(first), parts, scope.width).swapaxes(0, 1).copy()


def _label_errors(coded: DataFrame) -> DataFrame:
    """coded with the error summed over its label; the sums are broadcast if they are few."""
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long")
    sums = materialize(coded.groupBy("label").agg(total.alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "__label")
    if sums.count() <= FEW_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def train(
    vectors: DataFrame,
    vector: str = "embedding",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, DataFrame, Range, np.ndarray] | None:
    """(integers, blocks, range, codebooks), or None where no vector takes part."""
    if not (1 <= parts <= 8 and 1 <= entries <= 256):
        raise ValueError("a code holds up to 8 parts of one byte")
    numbered = integers(vectors, vector, scale, parts)
    scope = measure(numbered, parts)
    if scope is None:
        return None
    blocks = lay_blocks(numbered, scope, parts)
    codebooks = start(numbered, scope, parts, entries)
    for _ in range(rounds):
        codebooks = next_round(blocks, scope, codebooks)
    return numbered, blocks, scope, codebooks


def compress(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of each vector; see `train` for
    the settings.

    A component x becomes floor(scale * x). code holds two hex digits a part; error is the sum
    of the parts' squared distances, label_error that of all rows of the label, null labels
    together. Vectors that are null or hold null or non-finite components are left out, as are
    those whose length is not the usual one: of the lengths above zero that the parts
    divide, the most frequent, or the longer of two. Codebooks start with the smallest vec_ids, null
    ids last, equal ids by their components; where there are fewer vectors than entries,
    codebooks are shorter. Repeated rows give a row each and count as often as they come. Scaled
    components are held to 2**54 and a part's squared distance to 2**59. An empty table gives
    no rows; further columns are left aside.
    """
    trained = train(vectors, **settings)
    if trained is None:
        kind = vectors.schema["label"].dataType.simpleString()
        schema = f"vec_id long, label {kind}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    numbered, blocks, scope, codebooks = trained
    digits = 2 * len(codebooks)
    coded = map_batches(blocks, _code(scope, codebooks), "row long, bits long, error long")
    by_row = coded.groupBy("row").agg(F.bit_or("bits").alias("bits"), F.sum("error").alias("error"))
    code = F.lpad(F.lower(F.hex("bits")), digits, "0").alias("code")
    found = numbered.select("row", "vec_id", "label").join(by_row, "row").select("vec_id", "label", code, "error")
    result = _label_errors(materialize(found, "codes"))
    return result.withColumn("codebooks_sha256", F.lit(digest(codebooks)))
