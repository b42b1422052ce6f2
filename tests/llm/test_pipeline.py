"""The pipeline: what each stage keeps, against the operators and plain Python."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from tallymark.llm import language, mixing, neardup, packing, quality
from tests.llm.test_neardup import brute_force, edited, shingles
from tests.llm.test_tables import check_plan

SF = "/root/testdata/sf0.001"


def test_stages_decide_and_keep_the_columns(spark, documents):
    columns, docs, seen = documents.columns, documents, []
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{at}")
        seen.append((docs, out))
        if at < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns and out.schema == docs.schema, name
        docs = out

    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = seen[0]
    assert ids(after) == ids(language.identify(before).filter("not rejected"))

    before, after = seen[1]
    model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(quality.score(before, model).filter("kept"))

    before, after = seen[2]
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    roots, _ = brute_force(rows, corpus_pipeline.NEAR_PERCENT)
    for (doc_id, _), root in zip(rows, roots):
        groups[root].append(doc_id)
    assert ids(after) == sorted(map(min, groups.values()))

    before, after = seen[3]
    planned = mixing.plan(before).collect()
    check_plan(planned, before.collect())
    words = Counter()
    for r in mixing.sizes(after).collect():
        words[r.source] += r.size
    assert words == sum((Counter({r.source: r.taken}) for r in planned), Counter())

    before, after = seen[4]
    tokens = packing.pieces(before).groupBy().sum("length").first()[0]
    packed = after.collect()
    assert sum(r.length for r in packed) == tokens
    filled = Counter()
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= packing.WINDOW


def test_run_gives_every_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language",
        "quality",
        "near_duplicates",
        "mix",
        "pack",
    ]


def test_near_duplicates_go_from_a_similarity_of_80(spark):
    """Copies of 100 words with some replaced, so that similarities lie on both sides of 0.80."""
    draw, rows = random.Random(4), []
    for group in range(40):
        base = [f"g{group}w{i}" for i in range(100)]
        rows.append((2 * group, " ".join(base)))
        first = draw.randrange(5, 60)
        rows.append((2 * group + 1, edited(base, range(first, first + 2 + group % 14), "t")))
    sets = [shingles(text) for _, text in rows]
    near = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert any(0.80 <= s < 0.85 for s in near) and any(s < 0.80 for s in near)
    roots, _ = brute_force(rows, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))


def test_bands_keep_pairs_of_each_similarity_as_safe():
    assert neardup.bands_of(85) == neardup.BANDS
    for percent in (70, 80, 85, 95, 100):
        assert (1 - (percent / 100) ** neardup.ROWS) ** neardup.bands_of(percent) <= neardup.MISSED
