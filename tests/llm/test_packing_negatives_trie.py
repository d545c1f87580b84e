"""Dominance packing, hard negatives and the prefix trie: brute force, round trips, edges."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import dominance_packing as P, hard_negatives as H, prefix_trie as T
from ledgerlens.llm.queries import tokenizer_path

WORD_BPE = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return P.WordEncoder(WORD_BPE)


# ------------------------------------------------------------ packing

TEXTS = [
    "", " \t\n", "don't 12 3!! it's 'LL'd", "a\x85b é\x1cÀÖ x’s 'S", "<|endoftext|>q !'s <|startoftext|> x", "x²µª ſ İ K ÿ þ ×÷",
    "Σας ΣΑΣ é ́", "中文 字 \U0001d49c​", "\x00\x01", "word " * 5000, "a" * 9000, " " * 2_000_000, "! ?" * 3000 + "\xa0" * 50,
]


def test_ids_equal_those_of_the_tokenizer(encoder):
    rng = random.Random(0)
    letters = "abcdefghij AB'strevmld0123!?.,-\n\tÀßéÿ"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(400)]
    for text in texts:
        assert encoder.ids(text) == encoder.whole.encode(text, add_special_tokens=False).ids, text[:50]


def test_every_token_is_what_its_spelling_merges_to(encoder):
    """The condition under which ranks alone give the same ids as the list of merges."""
    with open(WORD_BPE, encoding="utf-8") as f:
        merges = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(json.load(f)["model"]["merges"])}
    spelt = {i: b for b, i in encoder.ranks.items()}
    vocab = json.load(open(WORD_BPE, encoding="utf-8"))["model"]["vocab"]
    for token, i in vocab.items():
        if i not in spelt:
            continue
        ends = token.endswith("</w>")
        parts = list(token[:-4] if ends else token)
        if ends:
            parts[-1] += "</w>"
        while len(parts) > 1:
            ranked = [(merges.get((a, b), 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, k = min(ranked)
            assert rank < 1 << 30, token
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert parts == [token]


def fewest(items, width):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= width:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0] if items else 0


def test_reduction_keeps_the_optimum():
    rng, fixed_pieces = random.Random(1), 0
    for _ in range(800):
        width = rng.randint(5, 30)
        low = rng.choice([1, 1, width // 5 + 1, width // 4 + 1])
        items = [rng.randint(low, width) for _ in range(rng.randint(0, 10))]
        counts = {i: items.count(i) for i in items}
        fixed, rest = P.reduce(counts, width)
        left = [k for k, n in rest.items() for _ in range(n)]
        assert all(sum(k * n for k, n in pattern) <= width for pattern, _ in fixed)
        assert sum(n for _, n in fixed) + fewest(left, width) == fewest(items, width)
        fixed_pieces += len(items) - len(left)
    assert fixed_pieces > 2000


def one_by_one(counts, width):
    rooms = []
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else width) - length)
    return sorted(rooms)


def test_best_fit_in_bulk_equals_best_fit_one_by_one():
    rng = random.Random(2)
    for _ in range(300):
        width = rng.randint(3, 60)
        counts = {rng.randint(1, width): rng.randint(1, 40) for _ in range(rng.randint(0, 12))}
        patterns = P.best_fit(counts, width)
        assert sorted(width - sum(k * n for k, n in p) for p, m in patterns for _ in range(m)) == one_by_one(counts, width)


def test_plan_is_small_however_many_pieces():
    rng = np.random.default_rng(0)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 20_000).astype(int) + 1)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    large = P.Plan({k: n * 1_000_003 for k, n in counts.items()}, 2048)
    assert len(large.runs) < 20_000
    assert large.windows <= 1.001 * sum(k * n for k, n in counts.items()) * 1_000_003 / 2048


@pytest.mark.parametrize("width", [2048, 16])
def test_packing_round_trip(spark, encoder, width):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1), (3, TEXTS[3], "x", 1), (50, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, part int").repartition(3)
    pieces = P.pack(docs, WORD_BPE, width=width, keep_ids=True).collect()
    want = sorted((-1 if r[0] is None else r[0], [*encoder.ids(r[1] or ""), 0]) for r in rows)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: (p["piece"], p["sequence_id"])):
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and p["start"] == p["piece"] * width and 0 < p["length"] <= width
        by_doc.setdefault(-1 if p["doc_id"] is None else p["doc_id"], []).append(np.frombuffer(p["ids"], "<u4").tolist())
    assert sum(len(i) for _, i in want) == sum(p["length"] for p in pieces)
    for doc, ids in want:
        if doc != 3:  # that one occurs twice
            assert sum(by_doc[doc], []) == ids
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= width
    assert sorted(windows) == list(range(len(windows)))
    assert all(p["length"] == width for p in pieces if any(q["doc_id"] == p["doc_id"] and q["piece"] > p["piece"] for q in pieces))


def test_packing_of_nothing(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE).count() == 0


# ------------------------------------------------------------ hard negatives


def mined(rows, anchor, positives=5, negatives=3):
    unit = {}
    for vec_id, label, vec in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        row = (label, [int(np.floor(256.0 * x)) for x in vec])
        unit[vec_id] = min(unit.get(vec_id, row), row)
    width = max((len(v) for _, v in unit.values()), default=0)
    full = {i: (label, v + [0] * (width - len(v))) for i, (label, v) in unit.items()}
    out = set()
    for a, (label, vec) in full.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), i, other) for i, (other, v) in full.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            found = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out |= {(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(found, 1)}
    return out


def shaped(kind, rng, n):
    vectors = rng.normal(size=(n, 12))
    if kind == "clusters":
        vectors = rng.normal(size=(6, 12))[rng.integers(0, 6, n)] + 0.1 * vectors
    if kind == "lengths":
        vectors *= rng.lognormal(0, 2, (n, 1))
    if kind == "ties":
        vectors = rng.integers(-1, 2, (n, 12)).astype(float)
    if kind == "huge":
        vectors *= 1e6
    return vectors


@pytest.mark.parametrize("kind", ["random", "clusters", "lengths", "ties", "huge"])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(H, "BLOCK_BITS", 6)
    monkeypatch.setattr(H, "GROUP_BITS", 3)
    rng = np.random.default_rng(3)
    vectors = np.clip(shaped(kind, rng, 600), -500_000, 500_000)
    labels = np.where(rng.random(600) < 0.4, 0, rng.integers(0, 5, 600)).tolist()
    rows = [(i, labels[i], [float(x) for x in vectors[i]]) for i in range(600)]
    rows += [(None, 1, rows[0][2]), (700, None, rows[0][2]), (750, 1, None), (800, 1, [None, 1.0]), (850, 1, [float("nan")]), (900, 1, [float("inf")])]
    rows += [rows[50], (100, 9, rows[7][2]), (950, 2, []), (1000, 3, [0.5]), (-50, 1, rows[3][2])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    frame = frame.withColumns({"block": F.lit("x"), "length": F.lit(1), "team": F.lit(0)}).repartition(3)
    got = H.mine(frame, F.col("vec_id") % 50 == 0).collect()
    want = mined(rows, lambda i: i % 50 == 0)
    assert len(got) == len(want) > 50
    assert {tuple(r) for r in got} == want


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_ranges_of_focus_coordinates_lose_nothing_and_prune(spread):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(12, 16))[rng.integers(0, 12, 900)] + spread * rng.normal(size=(900, 16))
    # a bucket holds rows of similar length
    vectors = np.floor(256 * points / np.sqrt((points**2).sum(1))[:, None]).astype(np.int64)
    bucket = H.Bucket(np.arange(900), np.zeros(900, int), vectors)
    asked = vectors[:40]
    length = np.sqrt((asked.astype(float) ** 2).sum(1))
    scores = asked @ vectors.T
    need = np.sort(scores, 1)[:, -20].astype(float)
    found = bucket.candidates(asked / length[:, None], length, need)
    kept = 0
    for row, best, some in zip(scores, need, found):
        some = np.arange(900) if some is None else some
        assert set(np.flatnonzero(row >= best)) <= set(some.tolist())
        kept += len(some)
    assert kept < (0.4 if spread < 0.1 else 0.8) * 40 * 900
    assert len(bucket.candidates(asked[:1] / length[0], length[:1], np.array([1e12]))[0]) == 0


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert H.mine(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert H.mine(one, F.col("vec_id") % 50 == 0).count() == 0
    assert H.mine(one, F.col("vec_id") < 0).count() == 0


# ------------------------------------------------------------ prefix trie


def nodes_of(sequences):
    """All nodes from whole sequences {id: [(role, text)]}, prefix by prefix."""
    found = {}
    for conv in sorted(sequences):
        seq = [tuple(t) for t in sequences[conv]]
        for d in range(len(seq) + 1):
            found.setdefault(tuple(seq[:d]), []).append(conv)
    out = set()
    for prefix, convs in found.items():
        below = {p: c for p, c in found.items() if p[: len(prefix)] == prefix}
        parents = {p[:-1] for p in found if p}
        ends = sorted(c for c in convs if len(sequences[c]) == len(prefix))
        out.add(
            (
                convs[0], len(prefix), found[prefix[:-1]][0] if prefix else None, len(convs),
                sum(p[:-1] == prefix for p in found if p), sum(p not in parents for p in below),
                sum((len(c) - 1) * len(p[-1][1].encode()) for p, c in below.items() if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return out


def rebuilt(own):
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


@pytest.mark.parametrize("family", ["few texts", "one long", "copies"])
def test_trie_equals_brute_force(spark, family):
    rng = random.Random(5)
    texts = ["", "a", "bé", "long text " * 30] if family != "copies" else ["same"]
    own = {c: [(rng.choice(["user", ""]), rng.choice(texts)) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 20]))] for c in rng.sample(range(-20, 200), 90)}
    if family == "one long":
        own[7] = [("user", f"t{i % 3}") for i in range(300)]
        own[8] = own[7][:255] + [("user", "other")]
    rows = []
    for c, turns in own.items():
        for k, (role, text) in enumerate(turns):
            rows.append((c, None if k == 0 else k, role or None, text or None, "x"))
    rows.append((None, 1, "user", "no conversation", "x"))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string").repartition(5)
    turns = T.ordered_turns(frame)
    got = T.trie(*T.with_shared_openings(turns)).collect()
    want = nodes_of(rebuilt(own))
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_equal_turns_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    turns = T.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    by_conv = {}
    for r in sorted(turns.collect()):
        by_conv.setdefault(r["conv_id"], []).append((r["pos"], bytes(r["digest"])))
    assert by_conv[1] == by_conv[2] and [p for p, _ in by_conv[1]] == [0, 1, 2]


def test_ids_that_end_at_one_node_are_hashed_as_a_stream(spark, monkeypatch):
    monkeypatch.setattr(T, "RUN", 7)
    ids = list(range(1, 1000))
    rows = spark.createDataFrame([(1, 2, i) for i in ids] + [(5, 1, 5), (5, 2, 6)], "name long, depth long, conv_id long").repartition(6)
    found = {(r["name"], r["depth"]): r["ends"] for r in T._ends(rows).collect()}
    assert found[1, 2] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found[5, 1] == hashlib.sha256(b"5").hexdigest() and found[5, 2] == hashlib.sha256(b"6").hexdigest()


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.trie(*T.with_shared_openings(T.ordered_turns(none))).count() == 0
    # 3 and 4 lose their own turns to an opening that does not exist
    short = spark.createDataFrame([(c, 0, "u", "t") for c in (3, 4)], "conv_id long, turn long, role string, text string")
    want = nodes_of(rebuilt({3: [("u", "t")], 4: [("u", "t")]}))
    assert {tuple(r) for r in T.trie(*T.with_shared_openings(T.ordered_turns(short))).collect()} == want
