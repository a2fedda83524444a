import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import decontaminate, quality, queries, secrets

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def test_stages_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    model = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    kept = {i: t for i, t in kept.items() if scores[i] >= 0.7}
    accepted = kept
    patterns: dict = {}
    for r in bench.collect():
        for w in decontaminate.windows(decontaminate.words_of(r.text.encode())):
            patterns.setdefault(w, set()).add(r.item_id)

    def hit(t):
        w = decontaminate.words_of(t.encode())
        at = {p for size in {len(x) for x in patterns} for i in range(len(w) - size + 1) if tuple(w[i : i + size]) in patterns for p in range(i, i + size)}
        return bool(at) and 20 * len(at) >= len(w)

    words = {i: t.lower().split() for i, t in accepted.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    stage_docs = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, stage_docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        stage_docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert stage_docs.columns == docs.columns
        if k == 0:
            assert {r.doc_id: r.text for r in stage_docs.collect()} == accepted
        if k == 1:
            ids = {r.doc_id for r in stage_docs.collect()}
            for i in set(accepted) - ids:  # only near copies of documents that stay go
                assert max(len(sets[i] & sets[j]) / max(1, len(sets[i] | sets[j])) for j in ids) >= 0.8
            for i in ids:  # and one of a group stays
                assert all(words[i] != words[j] for j in ids if j < i)
            kept = {i: accepted[i] for i in ids if not hit(accepted[i])}
        if k == 2:
            assert {r.doc_id: r.text for r in stage_docs.collect()} == kept
        if k == 3:
            for r in stage_docs.collect():
                spans = secrets.base_spans(kept[r.doc_id], kept[r.doc_id].encode())
                assert (r.text == kept[r.doc_id]) == (not spans) and r.n_chars == len(r.text) or not spans
                assert not secrets.base_spans(r.text, r.text.encode())
    assert {r.doc_id for r in stage_docs.collect()} == set(kept)
    assert stage_docs.where(F.col("rate") < 0).count() == 0


def test_odd_documents(spark, tmp_path):
    """Nulls, empty texts, repeated rows and extra columns with the operators' own names go through all stages; so does an empty table."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    schema = docs.schema
    first = docs.orderBy("doc_id").first()
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, None, "en", "s", 0), tuple(first), (9003, "word " * 50_000, "en", None, 250_000)], schema)
    both = docs.unionByName(odd).withColumn("rate", F.lit("r")).withColumn("spans", F.lit(1)).withColumn("score", F.lit("x")).withColumn("fp", F.lit(None).cast("int"))
    for rows in (both, both.limit(0)):
        stage_docs = rows
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = stage_docs
            out = f"{tmp_path}/{rows is both}-{k}"
            stage(spark, before, FOLDER).write.parquet(out)
            stage_docs = spark.read.parquet(out)
            assert stage_docs.count() <= before.count()
            assert {r.doc_id for r in stage_docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
            if k < 4:
                assert stage_docs.columns == before.columns
        assert set(stage_docs.columns) > {"doc_id", "text", "spans", "score", "fp", "rate", "n_tokens"}
        assert (stage_docs.count() > 0) == (rows is both)


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 0 and {"doc_id", "text", "rate"} <= set(out.columns)
    written = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert all(len(os.listdir(f"{written}/{d}")) == 1 for d in os.listdir(written) if d.startswith("pipeline-"))


def test_queries_return_the_contract(spark):
    want = {
        1: ["query_id", "rank", "vec_id", "score"],
        2: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        3: ["doc_id", "fingerprint", "component_id"],
        4: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        6: ["page_id", "host", "path", "rule", "verdict"],
        7: ["page_id", "url", "text", "n_chars"],
        8: ["doc_id", "held_out", "score", "predicted"],
        10: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    }
    names = {int(n[2:].split("_")[0]): n for n in queries.QUERIES}
    assert sorted(names) == list(range(1, 11))
    for n, columns in want.items():
        df = queries.QUERIES[names[n]](spark, FOLDER)
        assert df.columns[: len(columns)] == columns
        if n > 1:
            source = "pages" if n in (6, 7) else "documents"
            assert df.count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
