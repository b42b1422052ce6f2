"""Vector codes, conversation repair and token counts against plain Python."""

import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallymark.llm import codes, repair, tokens
from tallymark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- vector codes


def floors(x):
    return int(np.floor(np.float64(x) * 4096))


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """{position in rows: (code, error)} and the codebooks, in Python integers."""
    kept = [(at, i, [floors(x) for x in v]) for at, (i, v) in enumerate(rows)]
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda k: (k[1] is None, k[1] or 0, k[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def best(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, _, v in kept:
            for p in range(parts):
                members[p, best(v, p)[1]].append(cut(v, p))
        for (p, e), own in members.items():
            books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    out = {}
    for at, _, v in kept:
        found = [best(v, p) for p in range(parts)]
        out[at] = ("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return out, hashlib.sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, code string, row long, part int, bits string"


def check_codes(spark, rows):
    """rows: (vec_id, vector, label) that all take part."""
    frame = spark.createDataFrame([(*row, "c", 1, 2, "b") for row in rows], VECTORS)
    floats = [(i, np.array(v, np.float32)) for i, v, _ in rows]
    want, sha = plain_codes(floats)
    labels = Counter()
    for at, (_, _, label) in enumerate(rows):
        labels[label] += want[at][1]
    expected = Counter((rows[at][0], *pair, labels[rows[at][2]], sha) for at, pair in want.items())
    got = codes.compress(frame).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == expected


def test_codes_equal_plain_integers(spark):
    draw = random.Random(5)
    vector = lambda: [draw.gauss(0, 0.3) for _ in range(16)]
    rows = [(i, vector(), draw.choice([1, 2, None])) for i in range(600)]
    rows += [(700 + i % 3, rows[4][1], 2) for i in range(300)]  # one vector a third of all rows
    rows += [(None, vector(), None), (None, rows[7][1], 3), (5, vector(), 3), (5, rows[7][1], 3)]
    draw.shuffle(rows)
    check_codes(spark, rows)


def test_codes_of_ties_few_rows_and_large_components(spark):
    grid = [(i, [float(i % 3 - 1), float(i // 3 % 3 - 1)] * 8, i % 2) for i in range(40)]
    check_codes(spark, grid)
    check_codes(spark, grid[:5])
    check_codes(spark, [(i, [(-1) ** j * (3e5 + i * j / 2) for j in range(16)], None) for i in range(60)])


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7, -i / 3] * 4, 1) for i in range(20)]
    bad = [(30, None, 1), (31, [nan] * 8, 1), (-1, [inf, *[0.0] * 7], 1), (33, [None, *[0.0] * 7], 1)]
    bad += [(34, [], 1), (35, [1.0] * 16, 1), (36, [1.0] * 7, None)]
    frame = spark.createDataFrame([(*row, "c", 1, 2, "b") for row in good + bad], VECTORS)
    want, sha = plain_codes([(i, np.array(v, np.float32)) for i, v, _ in good])
    got = {r.vec_id: r for r in codes.compress(frame).collect()}
    assert {i: (r.code, r.error) for i, r in got.items()} == {good[at][0]: pair for at, pair in want.items()}
    assert {r.codebooks_sha256 for r in got.values()} == {sha}
    assert codes.compress(frame.limit(0)).collect() == []
    assert codes.compress(frame.filter("vec_id > 29 and vec_id < 34")).columns == codes.compress(frame).columns


def test_huge_components_are_held(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 8, 1, "c", 1, 2, "b") for i in range(20)]
    got = codes.compress(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 20 and {r.error for r in got} == {0}


def test_curve_visits_every_cell_and_moves_by_one():
    for bits, axes in ((3, 2), (2, 3), (1, 5), (4, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
        place = codes.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        path = cells[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    draw = np.random.default_rng(2)
    for _ in range(300):
        points = draw.integers(-30, 30, (12, 3)) // draw.integers(1, 12)
        entries = draw.integers(-30, 30, (9, 3)) // draw.integers(1, 12)
        stay = codes.shortlist(points.min(0), points.max(0), entries)
        full, _ = codes.nearest(points, entries)
        own, _ = codes.nearest(points, entries[stay])
        assert (stay[own] == full).all()


def test_tight_blocks_have_short_lists(spark):
    """Clustered vectors: most blocks are settled by their boxes and sums alone."""
    draw = random.Random(1)
    centers = [[draw.uniform(-1, 1) for _ in range(16)] for _ in range(16)]
    rows = [(i, [x + draw.gauss(0, 0.001) for x in centers[i % 16]], 0, "c", 1, 2, "b") for i in range(4000)]
    _, blocks, scope, books = codes.train(spark.createDataFrame(rows, VECTORS))
    lists = [
        len(codes.shortlist(np.array(r.low), np.array(r.high), books[r.part]))
        for r in blocks.select("part", "low", "high").collect()
    ]
    assert np.mean(lists) < 8
    assert blocks.groupBy().sum("count").first()[0] == 8 * 4000


# --- conversations


def cheapest(letters):
    """(cost, audit) by a shortest-path search over rows and positions."""
    heap, done = [(0, "", 0, repair.BEGIN)], set()
    while heap:
        cost, audit, at, place = heapq.heappop(heap)
        if (at, place) in done:
            continue
        done.add((at, place))
        if at == len(letters) and place in (0, 3):
            return cost, audit
        steps = [(role, to) for (start, role), to in repair.MOVES.items() if start == place]
        for role, to in steps:
            if role != "s":
                heapq.heappush(heap, (cost + 5, audit + "I", at, to))
        if at == len(letters):
            continue
        initial, fault = letters[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, place))
        if fault == "gone":
            continue
        more = 5 * (fault == "cut")
        for role, to in steps:
            if role == initial:
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, to))
            if role != "s":
                heapq.heappush(heap, (cost + more + 1, audit + "R", at + 1, to))


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        hit = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def plain_report(convs, rows):
    out = {}
    for conv in convs:
        own = [r for r in rows if r[0] == conv]
        digest = lambda text: hashlib.sha256(text.encode()).digest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r[3])))
        seen, letters, counts = set(), [], Counter()
        for _, _, role, text in own:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else ""
            fault = fault or ("truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
            counts[fault] += 1
            letters.append((role[:1], {"": "", "truncated": "cut"}.get(fault, "gone")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
        cost, audit = cheapest(letters)
        lines, waiting, todo = [], False, list(own)
        for edit in audit:
            _, _, role, text = todo.pop(0) if edit != "I" else (None, None, "", "")
            if edit == "D":
                continue
            if edit in "RI":
                role = "assistant" if waiting else "user"
            waiting = role[:1] == "u"
            lines.append(f"{role}:{text}")
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found = (counts["blank"], counts["duplicate"], counts["truncated"])
        out[conv] = (min(gaps, (1 << 63) - 1), *found, illegal, cost, audit, sha, len(lines))
    return out


TURNS = "conv_id long, turn long, role string, text string, kind string, words string, copies string, audit string"


def talk(spark, rows):
    return spark.createDataFrame([(*row, "k", "w", "c", "a") for row in rows], TURNS)


def reported(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def random_rows(draw, convs, turns):
    said = ["a.", "b!", "a. ", "cut", "", None, " \n", "long text?\t", "\x1c", "é", "a."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys"]
    return [
        (conv if conv else None, draw.choice([None, at, at, at, 2 * at]), draw.choice(roles), draw.choice(said))
        for conv in range(convs)
        for at in range(draw.randrange(turns))
    ]


def test_blocks_and_joins_find_the_cheapest_repair():
    draw, parser = random.Random(3), repair.Parser()
    signs = {repair.FINE: "", repair.CUT: "cut", repair.GONE: "gone"}
    for _ in range(400):
        letters = [(draw.choice("suauat"), draw.choice("===~x")) for _ in range(draw.randrange(30))]
        spans = []
        for at in range(0, len(letters), repair.BLOCK):
            parser.add(spans, tuple(letters[at : at + repair.BLOCK]))
        found = repair.least_repair(repair.join_all([cell for _, cell in spans]))
        assert found == cheapest([(initial, signs[fault]) for initial, fault in letters])


def test_damaged_conversations_equal_plain_python(spark):
    rows = random_rows(random.Random(8), 60, 14)
    rows += [(90, 7, "user", "same."), (90, 7, "user", "same."), (90, -(1 << 63), "user", "x."), (90, (1 << 63) - 1, "u", "y.")]
    frame = talk(spark, rows)
    convs = {r[0] for r in rows}
    assert reported(repair.report(repair.damage(frame))) == plain_report(convs, spoil(rows))
    as_they_are = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert reported(repair.report(repair.as_given(frame))) == plain_report(convs, as_they_are)


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "TASK_ROWS", 40)
    draw = random.Random(2)
    rows = [(1, at, draw.choice(["user", "assistant", "system"]), draw.choice(["x.", f"t{at}", f"t{at}!"])) for at in range(700)]
    rows += random_rows(draw, 5, 9)
    found = reported(repair.report(repair.damage(talk(spark, rows))))
    assert found == plain_report({r[0] for r in rows}, spoil(rows))


def test_repaired_turns_are_those_of_the_digest(spark):
    frame = talk(spark, random_rows(random.Random(4), 25, 9))
    rows = repair.damage(frame)
    lines = defaultdict(list)
    for r in sorted(repair.repair(rows).collect(), key=lambda r: r.position):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.position == len(lines[r.conv_id])
    for r in repair.report(rows).collect():
        text = "\n".join(lines[r.conv_id])
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nothing_left_and_nothing_given(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    frame = talk(spark, [(5, dropped, "user", "hello.")])
    nothing = hashlib.sha256(b"").hexdigest()
    assert reported(repair.report(repair.damage(frame))) == {5: (0, 0, 0, 0, 0, 0, "", nothing, 0)}
    assert repair.report(repair.damage(frame.limit(0))).collect() == []
    long = talk(spark, [(5, dropped + 1, "user", "word " * 200_000 + "."), (5, dropped + 2, "assistant", "ok.")])
    assert [r[5:7] for r in reported(repair.report(repair.as_given(long))).values()] == [(0, "KK")]


# --- tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_tokenizer())


@pytest.fixture(scope="module")
def counter():
    path = tokens.default_tokenizer()
    return tokens.Counter(path, tokens.whole_tokens(path))


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proved(library):
    whole = tokens.whole_tokens(tokens.default_tokenizer())
    assert len(whole) == len(set(whole)) > 30_000
    assert all(len(library.model.tokenize(piece)) == 1 for piece in whole[::50])


def test_counts_over_all_code_points(library, counter):
    draw = random.Random(1)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    draw.shuffle(points)
    glue = ["a", " ", "'s", "1", "!", "", "İ", "\n"]
    texts = ["".join(c + draw.choice(glue) for c in points[at : at + 40]) for at in range(0, len(points), 40)]
    assert [counter(text) for text in texts] == lengths(library, texts)


def test_counts_of_awkward_texts(library, counter):
    texts = ["", " ", "<|endoftext|>", "a<|startoftext|><|endoftext|> b", "<|ENDOFTEXT|>", "<|endoftext", "'S 'll", "Σς ſ ȩ́"]
    texts += [" " * 2_000_000, "a" * 300_000, "é!" * 100_000, "\t\n" * 400_000 + "x", "\x1c\x85​ "]
    assert [counter(text) for text in texts] == lengths(library, texts)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    path = tokens.default_tokenizer()
    few = tokens.Counter(path, tokens.whole_tokens(path))
    texts = [f"qzx{i}vwk zzq{i % 7}x hello world" for i in range(50)]
    assert [few(text) for text in texts] == lengths(library, texts)


def test_other_files_go_through_the_library():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = tokens.Counter(path, tokens.whole_tokens(path))
    texts = ["Hello  world\n\n it's 1234 ", "a <|endoftext|> b", "", "日本語 é", " " * 300]
    assert [other(text) for text in texts] == lengths(Tokenizer.from_file(path), texts)
    with pytest.raises(ValueError):
        tokens.Counter(public_tokenizers.path("piece_bpe_32k.model"), [])


def test_token_counts_of_rows(spark, awkward, no_docs, library):
    want = Counter()
    for r in awkward.collect():
        count = lengths(library, [r.text or ""])[0]
        want[(r.doc_id, len((r.text or "").encode()), count, count > tokens.LIMIT)] += 1
    assert Counter(map(tuple, tokens.count_tokens(awkward).collect())) == want
    assert tokens.count_tokens(no_docs).collect() == []


def test_token_query_covers_every_document(spark, documents, library):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    want = dict(zip(texts, lengths(library, list(texts.values()))))
    assert {r.doc_id: r.n_tokens for r in QUERIES["op13_token_counts"](spark, SF).collect()} == want
