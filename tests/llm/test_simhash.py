import random

import numpy as np
import pytest
import xxhash

from lodestrata.llm import components, simhash


def plain_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, budget):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints():
    rng = random.Random(0)
    for n in (0, 1, 3, 4, 5, 90):
        text = " ".join(rng.choice(["Ab", "cÉ", "d", "\x0b", "e"]) for _ in range(n))
        assert simhash.fingerprint(text.encode(), 4) == plain_fingerprint(text, 4)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(long.encode(), 4) == plain_fingerprint(long, 4)


@pytest.mark.parametrize(("budget", "blocks", "unit"), [(4, None, 4096), (4, 6, 4096), (4, 7, 16), (4, 5, 16), (1, None, 4), (6, None, 4096)])
def test_links_against_brute_force(spark, budget, blocks, unit):
    rng = random.Random(budget)
    fps = {0}
    for _ in range(30):
        center = rng.getrandbits(64)
        for _ in range(12):
            x = center
            for b in rng.sample(range(64), rng.randrange(budget + 3)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    edges = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), budget, blocks, unit)
    root = {r.node: r.root for r in components.connected_components(edges).collect()}
    want = plain_components(fps, budget)
    got = [root.get(x, x) for x in signed]
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want, strict=True))) == len(set(want))


def test_groups(spark):
    rng = random.Random(3)
    text = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    near = text[:399] + ["other"]
    rows = [(5, " ".join(text), None, 1), (3, " ".join(near), "x", 2), (9, None, "x", 3), (8, "", None, 4), (7, " ".join(text), "x", 5), (7, " ".join(text), "x", 5), (None, " ".join(text).upper(), "x", 6), (4, "alone", "x", 7), (None, "nobody else", "x", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    out = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_groups(df).collect()), key=str)
    assert out == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (7, 3), (7, 3), (None, 3), (4, 4), (None, None)], key=str)
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 8, 4, None, None], key=str)
    assert simhash.one_of_each_group(df.limit(0)).count() == 0
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def shingles(text, width=5):
    w = text.lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs, copies = [], []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(80, 600))]
        docs.append((10 * i, " ".join(words)))
        for k in range(1, 5):
            changed = list(words)
            for at in rng.sample(range(len(words)), max(1, len(words) * (k if k < 4 else 8) // 200)):
                changed[at] = rng.choice(vocabulary)
            docs.append((10 * i + k, " ".join(changed)))
    sets = {i: shingles(t) for i, t in docs}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    kept = {r.doc_id for r in simhash.one_of_each_group(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {10 * i for i in range(60)} <= kept
    for i, _ in docs:
        best = max((alike(i, j) for j in kept if j != i and j // 10 == i // 10), default=0)
        if i not in kept:
            assert best >= 0.8
        elif i % 10:
            copies.append(alike(i, i - i % 10) >= 0.85)
    assert sum(copies) <= 3  # near copies that were missed


def greedy(sets, linked):
    """Ids in order; each stays unless it is like a candidate that stays."""
    stay = []
    for i in sorted(sets):
        if not any(linked(i, j) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in stay):
            stay.append(i)
    return set(stay)


@pytest.mark.parametrize("stars", [3, 0])
def test_copies_chained_to_an_unlike_document_go(spark, monkeypatch, stars):
    monkeypatch.setattr(simhash, "STAR_ROUNDS", stars, raising=False)
    # One text drifts: 1 and 2 are near each other and so on, but far from 0; each step has a near copy of its own.
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    docs, at = [], list(range(400))
    rng.shuffle(at)
    for k in range(24):
        for p in at[8 * k : 8 * k + 8]:
            words[p] = f"new{p}"
        docs.append((2 * k, " ".join(words)))
        docs.append((2 * k + 1, " ".join(words[:-1] + [f"end{k}"])))
    sets = {i: shingles(t) for i, t in docs}
    fps = {i: simhash.fingerprint_set(t.encode(), 5, 8) for i, t in docs}
    linked = lambda i, j: (np.bitwise_count(fps[i] ^ fps[j]) <= 6).any()
    kept = {r.doc_id for r in simhash.one_of_each_group(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    like = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert not any(linked(i, j) and like(i, j) for i in kept for j in kept if i < j)
    assert all(any(like(i, j) for j in kept) for i in set(sets) - kept)
    assert 1 < len(kept) <= len(greedy(sets, linked))


def test_many_unlike_candidates_take_few_rounds(spark):
    # Four words in five are one repeated word, so its shingle makes up each fingerprint bit for bit.
    own = lambda i: " ".join(f"x{i}n{k}" for k in range(20))
    docs = [(i, "bar " * 300 + own(i // 2) + (" end" if i % 2 else "") + " bar" * i) for i in range(80)]
    fps = {tuple(simhash.fingerprint_set(t.encode(), 5, 8)[1:]) for _, t in docs}
    assert len(fps) == 1
    nodes = spark.createDataFrame([(i, 7) for i, _ in docs], "id long, fp long")
    edges = {(r.u, r.v) for r in simhash.near_links(nodes, 6, node="id", firsts=4).collect()}
    assert edges == {(i, j) for i in range(80) for j in range(min(i, 4))} | {(i, i) for i in range(5, 80)}


def test_a_crowd_of_unlike_candidates_makes_no_rows_for_pairs(spark, monkeypatch):
    # All are candidates of each other; those in twos are near copies.
    own = lambda i: " ".join(f"x{i}n{k}" for k in range(40))
    docs = [(i, "bar " * 300 + own(i // 2) + (" end" if i % 2 else "") + " bar" * i) for i in range(160)]
    rows = []

    def counted(df, real=simhash.cut):
        out = real(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(simhash, "cut", counted)
    monkeypatch.setattr(components, "cut", counted)
    kept = simhash.one_of_each_group(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 160, 2))
    assert max(rows) <= 3 * len(docs)


@pytest.mark.parametrize(("group", "postings"), [(1000, 1 << 22), (7, 50)])
def test_first_of_alike_against_greedy(spark, monkeypatch, group, postings):
    monkeypatch.setattr(simhash, "POSTINGS", postings)
    rng = random.Random(7)
    sets = {0: set(), 1: {1 << 63}, 2: {(1 << 64) - 1, 0}}
    for i in range(3, 40):
        base = sets[rng.randrange(3, i)] if i > 3 else {rng.getrandbits(64) for _ in range(60)}
        sets[i] = {x for x in base if rng.random() > 0.05} | {rng.getrandbits(64) for _ in range(rng.randrange(5))}
    root = {i: i % 3 // 2 for i in sets}
    rows = [(root[i], i, np.array(sorted(x), np.uint64).tobytes()) for i, x in sets.items()]
    members = spark.createDataFrame(rows, simhash.SETS)
    want = set()
    for r in (0, 1):
        want |= greedy({i: x for i, x in sets.items() if root[i] == r}, lambda i, j: True)
    got = [r.id for r in simhash.first_of_alike(members, 0.8, group).collect()]
    assert sorted(got) == sorted(want) and len(want) < len(sets) - 5


def test_equal_fingerprints_of_unlike_texts_both_stay(spark):
    run = "bar " * 300
    unlike = [(i, run + " ".join(f"x{i}n{k}" for k in range(40))) for i in (1, 2, 3)]
    rows = [*unlike, (9, unlike[1][1] + " end"), (8, unlike[2][1].upper() + "\n")]
    assert len({simhash.fingerprint(t.encode(), 5) for _, t in rows}) == 1
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]


def test_repeated_ids_keep_one_row(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "z y x w v u")], "doc_id long, text string")
    assert [tuple(r) for r in simhash.one_of_each_group(df).collect()] == [(1, "a b c d e f")]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 1), (3, 2), (3, 2)]
    out = dict(components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
