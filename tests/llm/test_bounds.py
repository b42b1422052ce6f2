"""Bounds that hold and texts that are read whole, where one id or null has a third of all rows."""

from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import language, mixing, neardup, quality
from tests.llm.test_neardup import brute_force

SF = "/root/testdata/sf0.001"


# --- quality


def test_fitting_takes_bounded_rows_of_a_hot_id(spark):
    good = [(n, f"sound text number {n} " * 20) for n in range(40)]
    hot = [(7, f"version {n} of the text of one id " * 10) for n in range(300)]
    again = [(8, "one row many times over " * 10)] * 300
    docs = spark.createDataFrame([*good, *hot, *again], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id long, quality int")
    assert quality.labelled_features(docs, labels, rows=30).count() == 30
    assert quality.labelled_features(docs, labels, rows=100_000).count() == 40 + 300 + 1


def test_features_in_slices_fit_the_same_model(spark, documents, monkeypatch):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.labelled_features(documents, labels).toArrow()
    rows = [row for batch in found.to_batches() for row in quality._views(batch)]
    whole, fitted = quality.fit_rows(rows), quality.fit(documents, labels)
    monkeypatch.setattr(quality, "FIT_CHUNK", 3_000)
    sliced = quality.fit_rows(rows)
    for other in (sliced, fitted):
        assert abs(whole.weights - other.weights).max() < 1e-3 and abs(whole.constant - other.constant) < 1e-3
        assert abs(whole.slope - other.slope) < 1e-3 and abs(whole.shift - other.shift) < 1e-3


# --- language


def plain_prediction(dictionaries, text):
    """Smallest compressed size over the dictionaries, each block by a compressor of its own."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    raw = text.lower().encode()
    if len(raw) < language.SHORT_BYTES:
        raw = (raw + b"\n") * language.SHORT_TIMES
    effort = zstandard.ZstdCompressionParameters.from_level(
        language.LEVEL, min_match=language.MIN_MATCH, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    sizes = []
    for lang, content in sorted(dictionaries.items()):
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        blocks = [raw[at : at + language.BLOCK_BYTES] for at in range(0, len(raw), language.BLOCK_BYTES)]
        packer = zstandard.ZstdCompressor(compression_params=effort, dict_data=own)
        sizes.append((sum(len(packer.compress(block)) for block in blocks), lang))
    sizes.sort()
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def test_predictions_and_margins_equal_a_plain_loop(spark, documents):
    dictionaries = language.learn(documents)
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in language.identify(documents, dictionaries).collect():
        lang, margin = plain_prediction(dictionaries, texts[r.doc_id])
        assert (r.lang_pred, r.score) == (lang, pytest.approx(margin))
        assert r.rejected == (lang == "und" or margin < language.MIN_MARGIN)


def test_dictionaries_are_cut_from_whole_texts(spark, monkeypatch):
    """Shared openings teach nothing: slices lie anywhere, and all that is gathered is kept."""
    monkeypatch.setattr(language, "TEXT_CHARS", 50)
    rows = [(n, "x" * 1000 + f"{n:04d}" * 250, "aa") for n in range(0, 300)]
    learned = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    parts = learned["aa"].split(b"\n")
    assert len(parts) == min(language.DICTIONARY_TEXTS, spark.createDataFrame(rows, "doc_id long, text string, lang string").filter(~language.held_out()).count())
    assert {len(p) for p in parts} == {50}
    assert 0.25 < sum(p == b"x" * 50 for p in parts) / len(parts) < 0.75


# --- mixing


def test_rows_of_one_id_spread_over_the_ranges(spark):
    rows = [(None, f"text {n} of no id", "a") for n in range(2000)] + [(5, "same words", "a")] * 1000
    rows += [(n, "same words", "b") for n in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.plan(docs).collect()
    assert Counter((r.doc_id, r.source) for r in planned) == Counter((i, s) for i, _, s in rows)
    ranges = Counter(r.key[: mixing.RANGE_DIGITS] for r in planned if r.doc_id is None)
    assert max(ranges.values()) < 10
    for source in "ab":
        own = [r for r in planned if r.source == source]
        assert sum(r.taken for r in own) == own[0].budget
        assert all(r.taken <= 2 * r.size for r in own)
        places = sorted((r.before, r.size) for r in own)
        assert all(a + size == b for (a, size), (b, _) in zip(places, places[1:]))


def test_stretches_of_copies_change_nothing(spark, monkeypatch):
    rows = [(5, "same words", "a")] * 500 + [(n, "other text here", "a") for n in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = Counter(map(tuple, mixing.plan(docs).collect()))
    monkeypatch.setattr(mixing, "COPIES", 7)
    assert Counter(map(tuple, mixing.plan(docs).collect())) == want


# --- near duplicates


def test_one_document_of_each_component_stays(spark):
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base[:99], f"end{n}"]) for n in range(6)]
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (5, near[2]), (5, near[3])]
    alone = [(None, "nothing like it in five words"), (9, ""), (9, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "k", "r") for r in [*rows, *alone]], "doc_id long, text string, text_key string, rows string")
    kept = neardup.drop_duplicates(docs, 80)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, "near" if (r.text or "") in near else r.text) for r in kept.collect())
    assert got == Counter([(5, "near"), (None, "nothing like it in five words"), (9, ""), (None, None)])
    without = spark.createDataFrame([(*r, "k", "r") for r in rows[:3]], docs.schema)
    assert [r.doc_id for r in neardup.drop_duplicates(without, 80).collect()] == [None]


def test_small_sets_lose_no_link(spark):
    """Texts of 5 to 30 words, where bins of a signature are mostly borrowed."""
    rows, n = [], 0
    for length in range(5, 31):
        base = [f"s{length}w{i}" for i in range(length)]
        for cut in range(3):
            rows.append((n, " ".join(base[: length - cut])))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    roots, _ = brute_force(rows, 80)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 80).collect()}
    assert got == dict(zip([i for i, _ in rows], roots))


# --- stages


@pytest.mark.parametrize("name", ["awkward", "no_docs"])
def test_stages_take_awkward_and_empty_tables(spark, request, name):
    docs = request.getfixturevalue(name)
    for stage, run in corpus_pipeline.STAGES:
        out = run(spark, docs, SF)
        rows = out.collect()
        if stage != "pack":
            assert out.columns == docs.columns, stage
            texts = {r.text for r in docs.collect()}
            assert all(any((t or "").startswith(r.text or "") for t in texts) for r in rows), stage
        assert rows or name == "no_docs" or stage in ("language", "quality")
        if name == "no_docs":
            assert rows == []


def test_a_pipeline_over_empty_tables_is_empty(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
