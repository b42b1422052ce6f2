"""Language, quality and packing against plain Python, and their awkward rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallymark.llm import language, packing, quality
from tallymark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- language


def test_language_of_held_out_documents(documents):
    got = language.identify(documents)
    rows = got.join(documents.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {
        r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1
    }
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_learns_nothing_from_held_out_rows(documents):
    from pyspark.sql import functions as F

    other = documents.withColumn(
        "text", F.when(language.held_out(), F.lit("xyzzy plugh")).otherwise(F.col("text"))
    )
    assert language.learn(documents) == language.learn(other)


def test_language_of_awkward_rows(awkward):
    got = defaultdict(list)
    for r in language.identify(awkward).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == awkward.count()
    for doc_id in (3, 4, 5):
        assert got[doc_id][0].lang_pred == "und" and got[doc_id][0].rejected
    assert got[7][0] == got[7][1]
    assert not any(r.held_out for r in got[None])
    kept = language.keep_identified(awkward)
    assert kept.columns == awkward.columns
    assert not {3, 4, 5} & {r.doc_id for r in kept.collect()}


def test_language_without_anything_to_learn(no_docs, awkward):
    from pyspark.sql import functions as F

    assert language.identify(no_docs).collect() == []
    nothing = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(nothing).collect()} == {"und"}


# --- quality


def base_of(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def plain_logit(model, text):
    """The classifier's logit, n-gram by n-gram."""
    texts = pa.array([text])
    words, starts = quality.split_words(texts)
    hashes = quality.word_hashes(words)
    total = model.constant
    for weights, grams in zip(model.weights, quality._groups(texts, hashes, starts)):
        own = [float(weights[b]) for buckets, _ in grams for b in buckets]
        total += sum(own) / max(len(own), 1)
    return total


def test_quality_counts_and_verdicts(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.fit(documents, labels)
    texts = {r.doc_id: r.text for r in documents.collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    right = 0
    for r in quality.score(documents, model).collect():
        want = base_of(texts[r.doc_id])
        assert tuple(r)[1:7] == want, r.doc_id
        assert r.kept == (not want[5] and r.probability >= quality.THRESHOLD)
        logit = plain_logit(model, texts[r.doc_id])
        p = 1 / (1 + np.exp(-(model.slope * logit + model.shift)))
        assert abs(p - r.probability) < 1e-6
        if r.doc_id in marks:
            right += (r.probability >= 0.5) == bool(marks[r.doc_id])
    assert right >= 0.95 * len(marks)


def test_quality_is_learned_not_remembered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    unseen = labels.filter("doc_id % 2 = 1")
    rows = quality.score(docs, model).join(unseen, "doc_id").collect()
    assert sum((r.probability >= 0.5) == bool(r.quality) for r in rows) >= 0.95 * len(rows)


def test_quality_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (6, 0), (None, 1), (9, None), (12, 0), (12, 1)], "doc_id long, quality int"
    )
    model = quality.fit(awkward, labels)
    texts = sorted((repr((r.doc_id, base_of(r.text))) for r in awkward.collect()))
    got = quality.score(awkward, model).collect()
    assert sorted(repr((r.doc_id, tuple(r)[1:7])) for r in got) == texts
    assert quality.keep_good(awkward, model).columns == awkward.columns
    assert quality.score(no_docs, model).collect() == []
    alone = quality.fit(no_docs, labels)
    assert {round(r.probability, 3) for r in quality.score(awkward, alone).collect()} == {1.0}


# --- packing


def check_packed(rows, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
    return by_doc


def test_packing_holds_every_token_once(spark, documents):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    known = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    extra = [(10_001, "<|endoftext|> it's 12 \t\n  three   é中 \U0001f600 's"), (10_002, None), (10_003, "")]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = packing.pack(docs, with_ids=True).collect()
    check_packed(rows, packing.WINDOW)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for r in docs.collect():
        want = known.encode(r.text or "", add_special_tokens=False).ids + [packing.END]
        own = sorted(pieces[r.doc_id], key=lambda p: p.start)
        got = [i for p in own for i in p.ids]
        assert got == want
        at = 0
        for p in own:
            assert (p.start, p.length, p.doc_tokens) == (at, len(p.ids), len(want))
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
            at += p.length
    sequences = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) >= 0.98 * sequences * packing.WINDOW


def test_packing_query_has_the_ids_of_the_tokenizer_file(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    known = tokenizers.Tokenizer.from_file(packing.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|>\n it's", "<|endoftext"]
    texts += ["a" + " " * 2_000_000 + "b", "a" + "\n" * 2_000_000, "\u2003\t" * 1_000_000 + "\nb <|endoftext|> "]
    texts += [" " * 100_000 + "b" + " " * 99_999 + "c" + " " * 100_001, " " * 100_000 + "<|endoftext|>x", "\x1c " * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for doc_id, text in enumerate(texts):
        ids = known.encode(text).ids + [packing.END]
        for at in range(0, len(ids), packing.WINDOW):
            piece = np.array(ids[at : at + packing.WINDOW], "<u4")
            want.add((doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    for rows in (
        QUERIES["op6_packing"](spark, str(tmp_path)).collect(),
        corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).collect(),
    ):
        assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)


def test_files_with_other_settings_are_refused(tmp_path):
    import json

    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        given = json.load(file)
    changes = [
        {"normalizer": {"type": "Lowercase"}},
        {"pre_tokenizer": given["pre_tokenizer"] | {"add_prefix_space": True}},
        {"model": given["model"] | {"end_of_word_suffix": "</w>"}},
    ]
    for at, change in enumerate(changes):
        path = tmp_path / f"{at}.json"
        path.write_text(json.dumps(given | change), encoding="utf-8")
        with pytest.raises(ValueError, match="not applied"):
            packing.load_encoding(str(path))


def test_packing_awkward_rows_in_many_groups(awkward, no_docs):
    cut = packing.materialize(packing.pieces(awkward, window=64), "cut")
    rows = packing.place(cut, window=64, group_rows=3).collect()
    check_packed(rows, 64)
    assert len(rows) == cut.count()
    assert Counter(r.doc_id for r in rows)[7] == 2
    assert packing.pack(no_docs).collect() == []


def test_best_fit_decreasing_takes_the_tightest_window():
    draw = np.random.default_rng(1)
    for window in (8, 100, 257):
        lengths = draw.integers(1, window + 1, 300).tolist()
        got, offsets = packing.best_fit_decreasing(lengths, window)
        room, want = [], [None] * len(lengths)
        for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [(r, s) for s, r in enumerate(room) if r >= lengths[at]]
            if fits:
                want[at] = min(fits)[0] - lengths[at]
                room[min(fits)[1]] -= lengths[at]
            else:
                room.append(window - lengths[at])
                want[at] = window - lengths[at]
        left = [window - o - n for o, n in zip(offsets, lengths)]
        assert sorted(left) == sorted(want)
        assert len(set(got)) == len(room)
