"""Near duplicates against all pairs on sets of words, and the ways round the star."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tallymark.llm import neardup
from tallymark.llm.components import components
from tallymark.llm.neardup import Signer, drop_duplicates, near_duplicates


def words_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text, width=5):
    words = words_of(text)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_force(rows, percent=85):
    """The least index of each row's component, over all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, left in enumerate(sets):
        for j in range(i):
            if left and sets[j]:
                shared = len(left & sets[j])
                if 100 * shared >= percent * (len(left) + len(sets[j]) - shared):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return [root(i) for i in range(len(rows))], sets


def expected(rows, percent=85):
    roots, sets = brute_force(rows, percent)
    least = {}
    for (doc_id, _), r in zip(rows, roots):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    out = Counter()
    for (doc_id, _), r, s in zip(rows, roots, sets):
        component = least.get(r) if s else doc_id
        out[(doc_id, len(s), component, doc_id == component)] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(near_duplicates(awkward)) == expected(rows)


def test_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(near_duplicates(documents)) == expected(rows)


def edited(base, spots, tag):
    words = list(base)
    for n, spot in enumerate(spots):
        words[spot] = f"{tag}x{n}"
    return " ".join(words)


def test_a_group_whose_members_meet_the_hub_at_all_distances(spark):
    """Copies with 1 to 8 words changed: linked, nearly linked and unlinked ones share buckets,
    and chains join some that are not alike."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for n in range(1, 160):
        rows.append((n, edited(base, draw.sample(range(200), draw.randint(1, 8)), f"t{n}")))
    for n in range(160, 240):  # edits of edits
        own = rows[draw.randint(1, n - 1)][1].split()
        rows.append((n, edited(own, draw.sample(range(200), draw.randint(1, 4)), f"t{n}")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(docs)) == expected(rows)


@pytest.mark.parametrize("hubs", [1, 2])
def test_few_hubs_a_round_lose_no_link(spark, monkeypatch, hubs):
    monkeypatch.setattr(neardup, "FIRST_HUBS", hubs)
    draw = random.Random(hubs)
    base = [f"v{i}" for i in range(60)]
    rows = [(n, edited(base, draw.sample(range(60), draw.randint(0, 2)), f"q{n % 9}")) for n in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(docs)) == expected(rows)


def test_a_shared_passage_links_nothing(spark):
    passage = " ".join(f"law{i}" for i in range(60))
    rows = [(n, passage + " " + " ".join(f"own{n}_{i}" for i in range(40))) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in got) and len(got) == 60


def test_empty(no_docs):
    assert near_duplicates(no_docs).collect() == []
    assert drop_duplicates(no_docs).collect() == []


def test_drop_duplicates_keeps_whole_rows(awkward):
    kept = drop_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 3, 4, 5, 6, 8, None, 9, 11, 12, 12])


def test_signature_agreement_follows_the_similarity():
    signer = Signer(256, 1)
    draw = np.random.default_rng(3)
    pool = draw.permutation(np.unique(draw.integers(0, 2**64, 400, dtype=np.uint64)))
    for shared, apart in ((10, 2), (50, 25), (200, 50)):
        left, right = np.sort(pool[: shared + apart]), np.sort(np.r_[pool[:shared], pool[-apart:]])
        same = (signer(left) == signer(right)).mean()
        assert abs(same - shared / (shared + 2 * apart)) < 0.2
    assert (signer(pool[:1]) == signer(pool[:1])).all()


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    draw = random.Random(1)
    draw.shuffle(chain)
    got = dict(components(spark.createDataFrame(chain, "node long, other long")).collect())
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


def test_stars_end_without_a_round_that_changes_nothing(spark, monkeypatch):
    """A star is known as one after the first round, and no step reads its input twice."""
    from tallymark.llm import components as module

    rounds = []
    real = module._small_star
    monkeypatch.setattr(module, "_small_star", lambda links: rounds.append(1) or real(links))
    links = spark.createDataFrame([(n, 0) for n in range(1, 50)], "node long, other long")
    assert {tuple(r) for r in module.components(links).collect()} == {(n, 0) for n in range(50)}
    assert len(rounds) == 1
    assert {tuple(r) for r in module.stars(links).collect()} == {(n, 0) for n in range(1, 50)}
    chain = spark.createDataFrame([(n, n + 1) for n in range(40)], "node long, other long")
    assert {tuple(r) for r in module.components(chain).collect()} == {(n, 0) for n in range(41)}
