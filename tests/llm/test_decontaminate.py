import random
import re

import pytest

from lodestrata.llm import decontaminate as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, size):
    w, hit, found = words(text), set(), set()
    for name, t in items:
        iw = words(t)
        for k in range(max(1, len(iw) - size + 1)) if iw else ():
            window = iw[k : k + size]
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    if name is not None:
                        found.add(str(name))
    return len(w), hit, sorted(found)


@pytest.mark.parametrize("most", [500_000, 3])
def test_against_brute_force(spark, most):
    rng = random.Random(7)
    vocabulary = ["A", "b", "C3", "é", "İx", "zz"]
    text = lambda n: rng.choice([" ", "-", "\n_"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice((0, 1, 2, 3, 4, 5, 9)))) for i in range(12)] + [(3, "a b c3 é"), (50, None)]
    docs = [(i, text(rng.randrange(40))) for i in range(40)] + [(98, None), (99, ""), (None, "a b c3 é"), (7, "a b"), (7, "a b")]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, spans string")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = X.overlaps(d, b, size=4, most=most).collect()
    got = sorted(((r.doc_id, r.n_words, {p for s in r.spans for p in range(s.start, s.end)}, r["items"]) for r in out), key=str)
    want = sorted(((i, *brute(t, items, 4)) for i, t in docs), key=str)
    assert got == want
    kept = X.without_contaminated(d, b, size=4, most=most)
    clean = [i for i, t in docs if not (h := brute(t, items, 4))[1] or 20 * len(h[1]) < h[0]]
    assert kept.schema == d.schema and sorted((r.doc_id for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_threshold(spark):
    item = " ".join(f"w{i}" for i in range(13))
    docs = [(1, item + " x" * 247), (2, item + " x" * 248), (3, "y " * 300_000 + item)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: (r.n, r.c) for r in X.overlaps(d, b).select("doc_id", X.n_hit().alias("n"), X.contaminated().alias("c")).collect()}
    assert out == {1: (13, True), 2: (13, False), 3: (13, False)}


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert X.overlaps(d, b).first().spans == [] and X.overlaps(d.limit(0), b).count() == 0
    assert X.without_contaminated(d, b).count() == 1
