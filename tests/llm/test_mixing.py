import os
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import mixing

TARGETS = {"clean": 0.7, "low": 0.2, "toxic": 0.1}
WORDS = {"clean": "tree river stone cloud", "low": "### *** $$$ %%%", "toxic": "idiot clown worthless fool"}


def tables(spark, n=120, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        kind = rng.choices(list(WORDS), (6, 3, 1))[0]
        words = [rng.choice((WORDS[kind] + " the of and").split()) for _ in range(rng.randrange(5, 60))]
        docs.append((i, " ".join(words), f"s{i % 3}", kind))
        if i % 2:
            labels.append((i, kind))
    return spark.createDataFrame(docs, "doc_id long, text string, source string, q string"), spark.createDataFrame(labels, "doc_id long, domain string")


def test_targets_are_met_and_domains_found(spark):
    docs, labels = tables(spark)
    out = mixing.mix(docs, labels, TARGETS).join(docs.select("doc_id", F.col("q").alias("kind")), "doc_id").cache()
    sums = out.agg(*(F.sum(F.col("n_tokens") * F.col("rate") * F.col(f"p_{d}")) for d in TARGETS), F.sum("n_tokens")).first()
    for d, got in zip(TARGETS, sums, strict=False):
        assert got / sums[3] == pytest.approx(TARGETS[d], abs=2e-3)
    assert out.agg(F.min("rate")).first()[0] >= 0
    for d in TARGETS:
        assert out.where(f"kind = '{d}'").agg(F.avg(f"p_{d}")).first()[0] > 0.7


def test_gradient_steps_against_plain_python(spark):
    rows = [([64, 0, 0], 100), ([32, 32, 0], 50), ([0, 60, 4], 30), ([0, 0, 64], 5)]
    members = spark.createDataFrame([(q, n) for q, n in rows], "q array<int>, n_tokens long")
    targets = [90.0, 60.0, 35.0]
    history = mixing.fit_rates(members, targets, steps=25)
    total = sum(targets)
    weight = [1 / max(t, 1e-3 * total) for t in targets]
    p = [[x / 64 for x in q] for q, _ in rows]
    gram = [[sum(n * a[i] * a[j] for a, (_, n) in zip(p, rows, strict=True)) for j in range(3)] for i in range(3)]
    bound = max(sum(gram[i][j] * (weight[i] * weight[j]) ** 0.5 for j in range(3)) for i in range(3))
    rates = [1.0] * 4
    for step in history:
        error = [sum(n * r * a[k] for a, (_, n), r in zip(p, rows, rates, strict=True)) - targets[k] for k in range(3)]
        assert step == pytest.approx([w * e / bound for w, e in zip(weight, error, strict=True)])
        rates = [max(0.0, r - sum(a[k] * step[k] for k in range(3))) for a, r in zip(p, rates, strict=True)]
    got = {tuple(r.q): r.rate for r in members.select("q", mixing._rate(history, 3).alias("rate")).collect()}
    assert got == {tuple(q): pytest.approx(r) for (q, _), r in zip(rows, rates, strict=True)}


def test_totals_against_exact_posteriors(spark):
    # A domain's mass below one step of the grid in each document counts as well.
    rows = [([0.99, 0.006, 0.004], [64, 0, 0], 1000), ([0.988, 0.002, 0.01], [64, 0, 0], 3000), ([0.1, 0.891, 0.009], [7, 57, 0], 20)]
    members = spark.createDataFrame(rows, "p array<double>, q array<int>, n_tokens long")
    grid = {tuple(r.cell): (r.n_tokens, r.q) for r in mixing.cells(members, 3).collect()}
    assert set(grid) == {(64, 0, 0), (7, 57, 0)} and grid[64, 0, 0][0] == 4000
    for i in range(3):
        exact = sum(n * p[i] for p, _, n in rows)
        assert sum(n * q[i] / mixing.GRID for n, q in grid.values()) == pytest.approx(exact, rel=1e-12)
    docs, labels = tables(spark)
    priors, weights = mixing.fit_weights(docs, labels, list(TARGETS))
    exact = {r.doc_id: tuple(r.p) for r in mixing.posteriors(docs, priors, weights).collect()}
    assert all(sum(p) == pytest.approx(1, rel=1e-12) for p in exact.values())
    out = {r.doc_id: (r.p_clean, r.p_low, r.p_toxic) for r in mixing.mix(docs, labels, TARGETS).collect()}
    assert out.keys() == exact.keys() and all(out[i] == pytest.approx(exact[i]) for i in exact)


def test_posteriors_on_held_out_rows(spark):
    """Fitted on three quarters of the labelled rows: the loss on the rest, and how far mean posteriors are from the shares."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("needs the test tables")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    named = labels.select("doc_id", mixing.domain_of_labels(F.col("quality"), F.col("toxic")).alias("domain")).where("domain is not null")
    held = F.expr("crc32(cast(doc_id as string)) % 4 = 2")
    domains = list(mixing.TARGETS)
    rows = docs.join(named, "doc_id")
    priors, weights = mixing.fit_weights(docs, named.where(~held), domains)
    out = mixing.posteriors(rows.where(held), priors, weights).join(named, "doc_id")
    own = F.get("p", F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("int") - 1)
    got = out.agg(F.avg(-F.log(own)).alias("loss"), *(F.avg(F.get("p", F.lit(i))).alias(f"p{i}") for i in range(3)), *(F.avg((F.col("domain") == d).cast("int")).alias(f"s{i}") for i, d in enumerate(domains))).first()
    assert got.loss < 0.3  # a constant posterior has 0.72
    assert all(abs(got[f"p{i}"] - got[f"s{i}"]) < 0.03 for i in range(3))
    assert out.where("domain = 'toxic'").agg(F.avg(F.get("p", F.lit(2)))).first()[0] > 0.7


def test_tokens(spark):
    df = spark.createDataFrame([("The tree*** is, (THE) é-b |", 6), ("", 0), (" \t\n", 0), (None, 0), ("a", 1), (" a\r\nb ", 2)], "t string, n int")
    got = mixing._token_rows(df.withColumn("row", F.monotonically_increasing_id()), "t", "row", "n").groupBy("row", "n").agg(F.count("word").alias("k"), F.collect_list(F.struct("word", "tail")).alias("x")).collect()
    assert len(got) == 6 and all(r.k == r.n for r in got)
    assert [tuple(x) for r in got if r.n == 6 for x in r.x] == [("the", " "), ("tree", " ***"), ("is", " ,"), ("the", " )"), ("é-b", " "), ("", " |")]


def test_targets_not_met_are_reported(spark):
    members = spark.createDataFrame([([64, 0], 10)], "q array<int>, n_tokens long")
    with pytest.warns(UserWarning, match="not met after 3 steps"):
        assert len(mixing.fit_rates(members, [5.0, 5.0], steps=3)) == 3


def test_no_python_in_the_plan(spark):
    docs, labels = tables(spark, 20)
    out = mixing.mix(docs, labels, TARGETS)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_rows_keep_their_columns(spark):
    docs, labels = tables(spark, 40)
    odd = spark.createDataFrame([(None, "tree", None, "x"), (None, None, "s", "x"), (None, "idiot", "s", "y"), (7, "tree", "s", "x"), (7, "tree", "s", "z")], docs.schema)
    docs = docs.unionByName(odd).withColumn("rate", F.lit("old")).withColumn("h", F.lit(1))
    out = mixing.mix(docs, labels, TARGETS, keep=True)
    assert out.columns == ["doc_id", "text", "source", "q", "h", "n_tokens", "p_clean", "p_low", "p_toxic", "rate"]
    plain = {(r.doc_id, r.source, r.n_tokens, round(r.rate, 9)) for r in mixing.mix(docs, labels, TARGETS).collect()}
    got = out.collect()
    assert len(got) == 45 and {(r.doc_id, r.source, r.n_tokens, round(r.rate, 9)) for r in got} == plain
    assert sorted((r.doc_id, r.text, r.source, r.q) for r in got if r.doc_id is not None) == sorted(tuple(r)[:4] for r in docs.collect() if r.doc_id is not None)


def test_edge_cases(spark):
    docs, labels = tables(spark, 30)
    odd = spark.createDataFrame([(None, "tree", None, "x"), (500, None, "s", "x"), (501, " \n ", "s", "x"), (502, "tree", "s", "x"), (502, "tree", "s", "x"), (503, "tree " * 200_000, "s", "x")], docs.schema)
    bad = spark.createDataFrame([(None, "clean"), (1, None), (2, "unknown"), (9999, "clean")], labels.schema)
    out = mixing.mix(docs.unionByName(odd), labels.unionByName(bad), TARGETS)
    got = {(r.doc_id, r.n_tokens) for r in out.collect()}
    assert {(None, 1), (500, 0), (501, 0), (502, 1), (503, 200_000)} <= got and out.count() == 36
    assert mixing.mix(docs.limit(0), labels, TARGETS).count() == 0
    alike = mixing.mix(docs, labels.limit(0), TARGETS)
    assert alike.select("p_clean", "p_low").distinct().count() == 1
    assert {r.source for r in mixing.source_weights(out).collect()} == {None, "s", "s0", "s1", "s2"}
