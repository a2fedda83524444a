"""A corpus pipeline of five stages; each one's result is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontaminate, mixing, quality, secrets, simhash
from lodestrata.llm.common import ensure_checkpoint_dir, table

#: Share of all tokens that each domain is to have in the mixture; the first stage has already dropped most of ``low``.
TARGETS = {"clean": 0.985, "low": 0.005, "toxic": 0.01}


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more, checked exactly."""
    return simhash.one_of_each_group(docs, width=5, budget=6, seeds=8, similarity=0.8)


def decontaminate_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is text of benchmark items."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their text replaced by a mark."""
    return secrets.redact(docs, secrets.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each with a rate at which the expected tokens of the domains meet their targets.
    """
    labels = table(spark, sf_dir, "labels")
    labelled = labels.select("doc_id", mixing.domain_of_labels(F.col("quality"), F.col("toxic")).alias("domain"))
    return mixing.mix(docs, labelled, TARGETS, keep=True)


STAGES = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmarks),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: Model fitting and hashing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the documents that are left, redacted, with their domains and rates.

    Intermediate tables go to the shared checkpoint folder; each is deleted
    once the next has been written, and the last is what is returned. Nulls,
    empty texts and repeated rows are treated as each stage's operator says; an
    empty table gives no rows.
    """
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            files.delete(path(f"{folder}/{k - 1}"), True)
    return docs
