"""Language identification by compression.

Each learned language has a raw-content dictionary: text of that language that a zstandard
compressor may refer back to. A text is cut into blocks, every block is compressed with each
dictionary, and the language whose dictionaries make the text smallest is the answer. Blocks
keep the dictionary in reach over the whole of a long text; a short text is repeated, because
a few bytes are stored as they are and would tell nothing. Case is folded. The margin is the part by which
the best is smaller than the second; a narrow margin rejects the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.text import chunks, map_batches, text_key
from tallymark.sources.tables import materialize

UNDETERMINED = "und"

#: Texts that a language's dictionary is made of at most (least hashes first), and the
#: characters taken of each, at a place that a hash chooses in the whole text.
DICTIONARY_TEXTS = 200
TEXT_CHARS = 2_000

#: Parts of a language that choose texts apart from each other, before they meet.
PARTS = 64

BLOCK_BYTES = 4_000

#: Texts under SHORT_BYTES are compressed SHORT_TIMES over.
SHORT_BYTES = 256
SHORT_TIMES = 4

#: Compression effort, and the shortest match looked for.
LEVEL = 6
MIN_MATCH = 4

#: Texts whose best and second sizes differ by less than this part are rejected.
MIN_MARGIN = 0.005


def held_out() -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """A dictionary of each language, from rows with a lang that are not held out.

    Every language gives at most DICTIONARY_TEXTS texts, different from each other, and of each a
    slice of TEXT_CHARS: all that is gathered is used. Texts are chosen on narrow rows; only the
    slices, a bounded number for each language, go to the driver.
    """
    known = docs.select("doc_id", "text", "lang")
    known = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    narrow = known.select("lang", "doc_id", text_key().alias("key"))
    once = narrow.groupBy("lang", "key").agg(F.min("doc_id").alias("doc_id"))
    # in two steps: a language with most of the texts is first cut down in parts
    part_of = Window.partitionBy("lang", F.pmod("key", F.lit(PARTS))).orderBy(F.xxhash64("key"), "key")
    some = once.withColumn("n", F.row_number().over(part_of)).filter(F.col("n") <= DICTIONARY_TEXTS)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    first = some.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= DICTIONARY_TEXTS)
    first = materialize(first, "dictionary-texts")
    same = (F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))) & (F.col("key") == F.col("text_key"))
    start = F.pmod("text_key", F.greatest(F.length("text") - TEXT_CHARS + 1, F.lit(1)).cast("long"))
    part = F.substring("text", (start + 1).cast("int"), F.lit(TEXT_CHARS)).alias("part")
    texts = known.withColumn("text_key", text_key()).alias("d").join(first.alias("f"), same)
    rows = texts.select(F.col("f.lang").alias("lang"), "n", part).distinct().orderBy("lang", F.desc("n"))
    parts: dict[str, list[bytes]] = {}
    for lang, _, text in rows.toLocalIterator():
        parts.setdefault(lang, []).append(text.lower().encode())
    # the end of a dictionary is the cheapest to refer to: the first texts stand there
    return {lang: b"\n".join(found) for lang, found in sorted(parts.items())}


def has_letter(text: str) -> bool:
    return any(letter.isalpha() for letter in text)


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.langs = list(dictionaries)
        effort = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            min_match=MIN_MATCH,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        self.packers = [
            zstandard.ZstdCompressor(
                compression_params=effort,
                dict_data=zstandard.ZstdCompressionDict(
                    content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
            )
            for content in dictionaries.values()
        ]

    def sizes(self, text: str) -> list[int]:
        raw = text.lower().encode()
        if len(raw) < SHORT_BYTES:
            raw = (raw + b"\n") * SHORT_TIMES
        blocks = [raw[start : start + BLOCK_BYTES] for start in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(packer.compress(block)) for block in blocks) for packer in self.packers]

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(lang, margin); undetermined without a letter or without a learned language."""
        if not text or not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda at: (sizes[at], self.langs[at]))
        if len(order) == 1:
            return self.langs[0], 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        return self.langs[order[0]], (second - best) / second


def _predict(dictionaries: dict[str, bytes], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in batches:
            for part in chunks(batch, "text"):
                found = [classify(text) for text in part.column("text").to_pylist()]
                columns = [part.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array([lang for lang, _ in found], pa.string()),
                        pa.array([score for _, score in found], pa.float64()),
                        pa.array([lang == UNDETERMINED or score < MIN_MARGIN for lang, score in found]),
                    ],
                    names=[*keep, "lang_pred", "score", "rejected"],
                )

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Dictionaries are learned from docs where none are given. score is the margin, 0 to 1.
    rejected: undetermined (null text, no letter, nothing learned) or a narrow margin. Equal
    sizes go to the first language by name. A null doc_id is not held out. Repeated rows are
    judged alike; an empty table gives no rows.
    """
    learned = learn(docs) if dictionaries is None else dictionaries
    narrow = docs.select("doc_id", held_out().alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    return map_batches(narrow, _predict(learned, ["doc_id", "held_out"]), schema)


def _passing(dictionaries: dict[str, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in batches:
            for part in chunks(batch, "text"):
                found = [classify(text) for text in part.column("text").to_pylist()]
                good = [lang != UNDETERMINED and score >= MIN_MARGIN for lang, score in found]
                yield part.filter(pa.array(good, pa.bool_()))

    return run


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """The rows of docs, all columns, whose language is not rejected. Rows without text or
    without a letter go; a null lang, source or doc_id does not matter; repeated rows are judged
    alike; a text is read whole; an empty table stays empty."""
    learned = learn(docs) if dictionaries is None else dictionaries
    return map_batches(docs, _passing(learned), docs.schema)
