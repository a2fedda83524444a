import math
import random

import pytest

from lodestrata.llm import topk


def brute(vectors, queries, k):
    out = []
    for q, v in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in vectors if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, vectors, queries, **options):
    make = lambda rows: spark.createDataFrame(rows, "id long, v array<double>")
    return sorted(tuple(r) for r in topk.top_k(make(queries), make(vectors).repartition(3), **options).collect())


@pytest.mark.parametrize(("dims", "lists", "spread"), [(8, 4, 3), (7, 3, 40), (1, 4, 2), (16, 1, 1)])
def test_against_brute_force(spark, dims, lists, spread):
    rng = random.Random(dims)
    vectors = [(i, [float(rng.randint(-spread, spread)) for _ in range(dims)]) for i in range(200)]
    queries = vectors[::9]
    assert run(spark, vectors, queries, k=5, lists=lists) == brute(vectors, queries, 5)
    assert run(spark, vectors, queries, k=5, lists=lists, wave=4) == brute(vectors, queries, 5)


def test_ties_negative_scores_and_few_candidates(spark):
    vectors = [(i, [-1.0, 0.0]) for i in range(6)] + [(9, [1.0, 0.0])]
    assert run(spark, vectors, [(9, [1.0, 0.0])], k=4) == [(9, r + 1, r, -1) for r in range(4)]
    assert run(spark, vectors[:2], [(0, [-1.0, 0.0])], k=4) == [(0, 1, 1, 1)]


def test_unusable_vectors_repeats_and_lengths(spark):
    vectors = [(1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (None, [9.0, 9.0]), (6, [3.0]), (6, [3.0]), (7, [])]
    assert run(spark, vectors, vectors, k=3)[:3] == [(1, 1, 6, 3), (1, 2, 6, 3), (1, 3, 7, 0)]
    assert run(spark, [], [], k=3) == [] and run(spark, vectors, [], k=3) == [] and run(spark, [], vectors, k=3) == []


def test_large_values(spark):
    vectors = [(i, [float(1 << 31) * i, 1.0]) for i in range(5)] + [(8, [1e19, 1e19])]
    assert [(r[2], r[3]) for r in run(spark, vectors, [(8, [1e19, 1e19])], k=1)] == [(0, 2**63 - 1024)]
    assert run(spark, vectors[:5], [(1, vectors[1][1])], k=1) == [(1, 1, 4, 2**63 - 1024)]


def test_scaling(spark):
    df = spark.createDataFrame([(1, [0.99, -0.01, math.nan, None], "x")], "vec_id long, embedding array<float>, id string")
    row = topk.scaled(df).first()
    assert row.v[:2] == [63.0, -1.0] and math.isnan(row.v[2]) and row.v[3] is None
