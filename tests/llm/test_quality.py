import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lodestrata.llm import quality


def tables(spark, n=400):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = [rng.choice("tree river stone cloud the of and".split()) for _ in range(rng.randrange(8, 80))]
        if not good:
            words = [w + rng.choice(("###", "!!", "$$$")) for w in words]
        docs.append((i, " ".join(words), "en", "s", 1.0))
        if i % 10:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_split(spark):
    docs, labels = tables(spark)
    out = quality.score(docs, quality.train(docs, labels)).withColumn("held", quality.held_out()).join(labels, "doc_id").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in out)


def test_held_out_labels_and_other_columns_make_no_difference(spark):
    docs, labels = tables(spark, 120)
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("z"))
    a, b = quality.train(docs, labels), quality.train(other.repartition(5), flipped)
    assert np.array_equal(a.linear, b.linear) and np.array_equal(a.factors, b.factors) and a.bias == b.bias


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    size = quality.BUCKETS + quality.N_STRUCTURE
    m = quality.Machine(0.3, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, quality.FACTORS)).astype(np.float32), np.zeros(quality.N_STRUCTURE, np.float32), np.ones(quality.N_STRUCTURE, np.float32))
    idx, x = quality.features(b"Some words, some ### more words\nand a line")
    got = m.raw(idx, x, np.array([0]))[0][0]
    v = m.factors[idx]
    pairs = sum(float(v[i] @ v[j]) * x[i] * x[j] for i in range(len(idx)) for j in range(i))
    assert abs(got - (m.bias + float(m.linear[idx] @ x) + pairs)) < 1e-2


def test_edge_cases(spark):
    docs, labels = tables(spark, 60)
    odd = spark.createDataFrame([(None, "tree", None, None, None), (900, None, "en", "s", 0.0), (901, "", "en", "s", 0.0), (902, "x " * 500_000, "en", "s", 0.0), (903, "tree", "en", "s", 0.0), (903, "tree", "en", "s", 0.0)], docs.schema)
    bad = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, 0), (3, 0, 1), (3, 1, 1), (99999, 1, 0)], labels.schema)
    model = quality.train(docs.unionByName(odd), labels.unionByName(bad))
    out = quality.score(docs.unionByName(odd), model)
    assert out.count() == 66 and out.where("score between 0 and 1").count() == 66
    kept = quality.score(docs.unionByName(odd), model, keep=True)
    assert kept.schema == docs.schema and kept.count() == out.where("predicted = 1").count()
    assert quality.score(docs.limit(0), model).count() == 0
    untrained = quality.train(docs, labels.limit(0))
    assert [r.score for r in quality.score(docs, untrained).select("score").distinct().collect()] == [0.5]


def test_non_ascii_share_counts_every_byte():
    share = lambda data: float(quality.features(data)[1][-2])
    assert [share(b"\xff" * n) for n in (1, 1023, 1024, 100_000)] == [10.0] * 4
    assert share(b"a" * 1001 + b"\xff" * 999 + b"a" * 98_000) == np.float32(10 * 999 / 100_000)
    assert share((b"a" + b"\xff" * 9) * 10_240) == 9.0 and share(b"") == 0.0


def test_sample_is_bounded(spark):
    docs, labels = tables(spark, 100)
    assert np.isfinite(quality.train(docs, labels, sample=10).factors).all()
