"""Chats, archives, URLs, mixing, shards and neighbours against plain Python."""

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.llm import ann, chat, mixing, sharding, urls, warc
from tallymark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- chats

TURNS = "conv_id long, turn long, role string, text string, position string, loss string"


def turn(conv, number, role, text):
    return (conv, number, role, text, "x", "y")


CHATS = [
    turn(1, 1, "assistant", "b\\[ANS]\\\\"),
    turn(1, 0, "user", "<s>a</s> [INST]\\"),
    turn(2, 0, "user", None),
    turn(2, 0, "assistant", ""),
    turn(2, None, "tool [END]", "late"),
    turn(3, 0, None, "no role"),
    turn(None, 0, "user", "no id"),
    turn(4, 0, "user", "same"),
    turn(4, 0, "user", "same"),
    turn(5, 0, "system", "s" * 200_000 + "[/INST]"),
    turn(5, 1, "user", "é\U0001f600\n"),
    turn(5, 2, "assistant", "</s>"),
]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))


def test_chats_are_read_back(spark):
    frame = spark.createDataFrame(CHATS, TURNS)
    by_conv = defaultdict(list)
    for row in CHATS:
        by_conv[row[0]].append(row)
    segments = defaultdict(list)
    for r in chat.format_chats(frame).collect():
        segments[r.conv_id].append(r)
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(frame)).collect()}
    assert set(got) == set(by_conv) == set(segments)
    for conv, rows in by_conv.items():
        turns = [(r[2] or "", r[3] or "") for r in in_order(rows)]
        text = "".join(s.segment for s in sorted(segments[conv], key=lambda s: s.position))
        assert chat.parse(chat.INST, text) == turns
        trained = "".join(t for role, t in turns if role == "assistant")
        own = got[conv]
        assert own.n_turns == len(turns) and own.formatted_chars == len(text)
        assert own.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert own.loss_chars == len(trained)
        assert own.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
    assert [c for c, r in sorted(got.items(), key=str) if r.valid] == [1, 5]
    assert chat.digests(chat.format_chats(spark.createDataFrame([], TURNS))).collect() == []


def test_no_text_holds_a_control_string(spark):
    rows = chat.format_chats(spark.createDataFrame(CHATS, TURNS)).collect()
    texts = [r.segment for r in rows if r.position % 3 == 1]
    assert not any(mark in text for mark in chat.INST.controls for text in texts)
    assert chat.escaper(chat.INST)("</s>[INST] ok \\") == "<\\/s>[\\INST] ok \\\\"
    odd = chat.Template({"a": ("aba", "cc")}, ("xyx", "yy", "zz"), {}, ("a",), ("a",), start="^^")
    escape, undo = chat.escaper(odd), chat.unescaper(odd)
    for text in ("ababa", "xyxyx\\xyx", "ccc", "^^^", "\\", "aba\\ba"):
        assert not any(mark in escape(text) for mark in odd.controls) and undo(escape(text)) == text
    with pytest.raises(ValueError):
        chat.Template({"a": ("<", ">>")}, ("xyx", "yy", "zz"), {}, (), ())


def test_loss_flags_only_assistant_texts(spark):
    rows = chat.format_chats(spark.createDataFrame(CHATS, TURNS)).collect()
    assert all(r.loss == (r.role == "assistant" and r.position % 3 == 1) for r in rows)


# --- archives

PAGES = "page_id long, url string, html string, digest string, archive string"
HTML = [
    (3, "http://a/", "same"),
    (1, "http://b/\r\nX-Page-Id: 9", "same"),
    (1, "http://b2/", "same"),
    (None, "http://n/", "same"),
    (None, None, "only nulls"),
    (None, None, "only nulls"),
    (5, "http://c/%0A", None),
    (6, None, ""),
    (7, "", "<p>é\U0001f600\r\n\r\nWARC/1.1\r\n</p>" + "x" * 3_000_000),
]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*row, "d", "a") for row in HTML], PAGES)
    index = warc.write_archives(pages, f"file://{tmp_path}", archive_bytes=400)
    heads = {"same": 1, "": 5}
    want = Counter()
    for page_id, url, html in HTML:
        raw = (html or "").encode()
        head = heads.get(html or "")
        refers = head if head is not None and page_id != head else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[(page_id, url, "response" if refers is None else "revisit", refers, len(raw), digest)] += 1
    rows = warc.read_records(index, f"file://{tmp_path}").collect()
    assert Counter(tuple(r)[:6] for r in rows) == want
    assert all(hashlib.sha1(r.payload).digest() for r in rows if r.record_type == "response")
    some = index.filter("payload_bytes > 4")
    assert len(warc.read_records(some, f"file://{tmp_path}").collect()) == some.count() == 3
    for path in Path(tmp_path).glob("*.gz"):
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: re")
    assert warc.archive_round_trip(pages.limit(0)).collect() == []


def test_targets_stand_in_archives_as_they_are():
    for url in ("http://a/x%20y%0A?q=%25", "http://b/\r\nX-Page-Id: 9", "", "http://c/%0D\n%25"):
        record = warc.encode(4, url, b"p", None)
        lines = record.partition(b"\r\n\r\n")[0].decode().split("\r\n")
        if "\n" not in url:
            assert f"WARC-Target-URI: {url}" in lines and not any(line.startswith("X-Exact") for line in lines)
        assert warc.decode(record)[:2] == (4, url)


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(*row, "d", "a") for row in HTML], PAGES)
    refers = {(r.page_id, r.html): r.refers_to for r in warc.revisits(pages, 5).collect()}
    assert set(refers.values()) == {None}


def test_ranges_merge_in_order():
    ranges = [(0, 10), (10, 5), (40, 5), (1000, 900), (1900, 200)]
    assert warc.merge_ranges(ranges, 25, 1000) == [
        (0, 45, [0, 1, 2]),
        (1000, 1900, [3]),
        (1900, 2100, [4]),
    ]


# --- URLs

URLS = [
    "http://ORG/", "http://x.org", "https://x.org/?q", "http://example.org/es/1", "http://a.Example.org/en/12",
    "http://notexample.org/es/", "http://b.com/de/1?a=1&b=2", "http://c.com/fr/x#y", "no scheme", "", None,
    "http://", "://only/path?x", "http://h?q/de/", "http://net.net/a/b//c%20d", "http://u@h:80/p\nq",
]


def judged_by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        r
        for r in urls.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best


def test_url_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    pages = pages.withColumn("host", F.lit("other")).withColumn("label", F.lit("x"))
    for r in urls.judge(pages, trees=2, depth=2).collect():
        host, path, best = judged_by_hand(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best.name), URLS[r.page_id]
        assert r.verdict == (best.verdict if best else ("block" if r.blocked >= 0.5 else "allow"))
    if (parsed := urlparse(URLS[6])).netloc:
        assert judged_by_hand(URLS[6])[:2] == (parsed.netloc, parsed.path)


def test_url_trees_learn_what_rules_say(spark):
    rows = [(i, f"http://h{i}.com/de/{'9' * 12}?a=1&b=2") for i in range(60)]
    rows += [(100 + i, f"http://h{i}.com/fr/x") for i in range(60)]
    rows += [(300, f"http://h.com/xx/{'9' * 12}?a=1&b=2"), (301, "http://h.com/yy/x")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"))
    verdicts = {r.page_id: r.verdict for r in got.collect()}
    assert (verdicts[300], verdicts[301]) == ("block", "allow")


def test_trees_tell_held_out_addresses_apart(spark):
    """Rule-decided addresses that the trees have not seen, suffix by suffix, against the share of
    the more frequent verdict."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    rows = urls.lexical(urls.apply_rules(urls.split_url(pages)))
    known = rows.filter("rule is not null").withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    known = known.dropDuplicates(["url"])
    learn, held = (known.filter(F.pmod(F.xxhash64(F.lit(3), "url"), F.lit(2)) == k) for k in (0, 1))
    right, blocked = defaultdict(list), defaultdict(list)
    for r in urls.fit(learn, rows).chances(held).select("suffix", "label", "blocked").collect():
        right[r.suffix].append((r.blocked >= 0.5) == bool(r.label))
        blocked[r.suffix].append(r.label)
    for suffix, marks in right.items():
        base = np.mean(blocked[suffix])
        assert len(marks) > 50 and np.mean(marks) >= 0.9 > max(base, 1 - base) - 0.1, suffix
        assert np.mean(marks) - max(base, 1 - base) > (0.3 if suffix == "com" else -0.01), suffix


def test_lexical_features_equal_a_python_loop(spark):
    given = ["http://Sub.Example.COM/a/b-c/9%20x?q=1&r=2#top", "", None, "no scheme", "https://x.org", "ftp://a-b.net/É/%7E?k"]
    docs = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    for r in urls.lexical(urls.split_url(docs)).collect():
        url = given[r.page_id] or ""
        counts, length = Counter(url), max(len(url), 1)
        entropy = -sum(n / length * np.log2(n / length) for n in counts.values())
        digits, upper = (sum(c in chars for c in url) / length for chars in ("0123456789", urls.UPPER))
        assert (r.url_length, r.host_length, r.path_length) == (len(url), len(r.host), len(r.path))
        assert (r.digit_ratio, r.upper_ratio, r.entropy) == (digits, upper, pytest.approx(entropy))
        assert r.depth == len(re.findall("/[^/]", r.path)) and r.hyphens == r.host.count("-")
        assert r.labels == len([part for part in r.host.split(".") if part])
        assert r.parameters == len(re.findall("[?&][^=&#]*=", url))
        assert r.escapes == len(re.findall("%[0-9A-Fa-f]{2}", url))
        assert r.suffix == r.host.rpartition(".")[2]


def test_urls_without_labels(spark):
    schema = "page_id long, url string"
    assert urls.judge(spark.createDataFrame([], schema)).collect() == []
    alone = urls.judge(spark.createDataFrame([(1, "http://a.net/"), (2, None)], schema)).collect()
    assert [(r.verdict, r.blocked) for r in alone] == [("allow", None)] * 2


# --- mixing


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, rest, open_names = {}, share * sum(sizes.values()), list(names)
    while True:
        total = sum(weight[s] for s in open_names)
        over = [s for s in open_names if rest * weight[s] / total >= most * sizes[s]]
        if not over:
            return target | {s: rest * weight[s] / total for s in open_names}
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
            open_names.remove(s)


def check_plan(rows, docs):
    sizes = defaultdict(int)
    for r in docs:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    target, taken = filled(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - target[source]) <= 0.5 + 1e-6
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter(
        (r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs
    )


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_mixing_plan(request, name):
    docs = request.getfixturevalue(name)
    rows = mixing.plan(docs).collect()
    check_plan(rows, docs.collect())
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.plan(docs).collect()))


def test_mixing_takes_a_prefix_of_the_random_order(documents):
    by_source = defaultdict(list)
    for r in mixing.plan(documents).collect():
        by_source[r.source].append(r)
    for rows in by_source.values():
        rows.sort(key=lambda r: r.key)
        extra = [r.taken - r.epochs * r.size for r in rows if r.size]
        cut = next((i for i, e in enumerate(extra) if e < [r.size for r in rows if r.size][i]), len(extra))
        assert all(e == 0 for e in extra[cut + 1 :])


@pytest.mark.parametrize("name", ["awkward", "documents", "no_docs"])
def test_mixed_documents_hold_the_planned_words(request, name):
    docs = request.getfixturevalue(name)
    planned, words = defaultdict(int), defaultdict(int)
    for r in mixing.plan(docs).collect():
        planned[(r.doc_id, r.source)] += r.taken
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        words[(r.doc_id, r.source)] += len(WORD.findall(r.text or ""))
        assert any(t.startswith(r.text or "") for t in texts[r.doc_id])
        assert r.n_chars is None or r.n_chars == len(r.text)
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in planned.items() if v}


# --- shards


def check_shards(rows, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs
    )
    by_shard = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        by_shard[r.shard].append(r)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return [sum(r.size for r in by_shard[s]) for s in range(shards)]


def test_shards_of_documents(spark, documents, awkward, no_docs):
    many = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard(many).collect()
    loads = check_shards(rows, many.collect(), 40)
    largest = max(r.size for r in rows)
    assert max(loads) - min(loads) <= largest and max(loads) < 1.15 * np.mean(loads)
    check_shards(sharding.shard(awkward, 5).collect(), awkward.collect(), 5)
    assert sharding.shard(no_docs).collect() == []


def test_rows_equal_in_all_are_spread(spark):
    docs = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.lit("t")).alias("text"),
    )
    loads = check_shards(sharding.shard(docs, 8).collect(), docs.collect(), 8)
    assert max(loads) < 1.05 * np.mean(loads)


def test_a_new_shard_takes_slots_only_into_itself(spark, documents):
    rows = sharding.records(documents, 256)
    sums = sharding.slot_sums(rows)
    old = sharding.rebalance(sharding.first_map(spark, 4, 256), sums, 4)
    new = sharding.grow(old, sums, 5)
    before = {r.vslot: r.shard for r in old.collect()}
    after = {r.vslot: (r.shard, r.version) for r in new.collect()}
    assert set(before) == set(after) == set(range(256))
    assert all(s == before[v] or s == 4 for v, (s, _) in after.items())
    assert {version for _, version in after.values()} == {2}
    weights = dict(sums.collect())
    loads = Counter()
    for v, (s, _) in after.items():
        loads[s] += weights.get(v, 0)
    assert max(loads.values()) < 2 * np.mean(list(loads.values()))


def test_the_stored_map_is_edited_as_data_grow(spark, documents, tmp_path):
    """Three versions: each starts from the one before and moves no more than it has to."""
    folder, maps = str(tmp_path / "map"), []
    for share in (30, 60, 100):
        some = documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(100)) < share)
        rows = sharding.shard(some, shards=8, folder=folder).collect()
        assert len(rows) == some.count()
        loads = Counter()
        for r in rows:
            loads[r.shard] += r.size
        assert len(loads) == 8
        newest = sharding.latest(spark, folder)
        maps.append({r.vslot: r.shard for r in newest.collect()})
        assert newest.first().version == len(maps)
        assert all(maps[-1][r.vslot] == r.shard for r in rows)
    kept = [sum(a[slot] == b[slot] for slot in a) / len(a) for a, b in zip(maps, maps[1:])]
    assert all(0.9 < share < 1 for share in kept)
    assert sharding.latest(spark, str(tmp_path / "nowhere")) is None



# --- neighbours

VECTORS = "vec_id long, embedding array<float>, label int, block string, list string"


def vector_rows(points, first=0):
    return [(first + i, [float(x) for x in p], 0, "b", "l") for i, p in enumerate(points)]


def exact(rows, query_id, top):
    own = {(i, tuple(v)) for i, v, *_ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    query = next(np.float32(v).astype(float) for i, v in own if i == query_id)
    apart = sorted((np.sqrt(((np.float32(v).astype(float) - query) ** 2).sum()), i) for i, v in own if i != query_id)
    return apart[:top]


def test_recall_and_scores(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(30, 16)) * 3
    points = np.concatenate([centres[draw.integers(0, 30, 3000)] + draw.normal(size=(3000, 16)), np.ones((600, 16))])
    rows = vector_rows(points)
    got = defaultdict(list)
    found = ann.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0, probes=12)
    for r in found.collect():
        got[r.query_id].append(r)
    assert set(got) == set(range(0, 3600, 100))
    hits = 0
    for query, own in got.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        want = exact(rows, query, 10)
        hits += len({r.vec_id for r in own} & {i for _, i in want})
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        if query >= 3000:  # 600 equal vectors: ties go to the smaller ids
            assert [r.vec_id for r in own] == [i for _, i in want]
    assert hits >= 0.9 * 10 * len(got)


def test_recall_without_clusters_where_lists_are_many(spark):
    assert all(ann.probes_of(n) >= min(n, max(48, n // 4)) for n in (1, 8, 20, 100, 192, 200, 256, 1024))
    points = np.random.default_rng(11).normal(size=(60_000, 64)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1)[:, None]
    table = pa.table({"vec_id": np.arange(len(points)), "embedding": list(points)})
    found = ann.nearest(spark.createDataFrame(table), F.col("vec_id") % 2000 == 0)
    got = defaultdict(set)
    for r in found.collect():
        got[r.query_id].add(r.vec_id)
    assert len(got) == 30
    hits = 0
    for query, own in got.items():
        apart = ((points.astype(float) - points[query]) ** 2).sum(axis=1)
        apart[query] = np.inf
        hits += len(own & set(np.argpartition(apart, 10)[:10].tolist()))
    assert hits >= 0.97 * 10 * len(got)


def test_neighbours_of_awkward_vectors(spark):
    rows = vector_rows([[1, 0], [2, 0], [0, 3], [2, 0]])
    rows += [(100, None, 0, "", ""), (200, [], 0, "", ""), (300, [0.0, 0.0], 0, "", "")]
    rows += [(400, [float("nan"), 1.0], 0, "", ""), (500, [float("inf"), 1.0], 0, "", "")]
    rows += [(600, [None, 1.0], 0, "", ""), (None, [1.0, 1.0], 0, "", ""), (1, [2.0, 0.0], 0, "", "")]
    got = ann.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, 1, 1, 1.0),
        (0, 2, 3, 1.0),
        (0, 3, 2, round(float(np.sqrt(10)), 6)),
    ]
    assert ann.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).collect() == []
    assert ann.nearest(spark.createDataFrame(rows[4:6], VECTORS), F.col("vec_id") > 0).collect() == []


# --- registered queries


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, name):
    import check_queries

    duck = check_queries.connect(SF)
    line = check_queries.compare(spark, duck, name, QUERIES[name], SQL[name], SF)
    assert line.startswith("ok") and "EMPTY" not in line, line
