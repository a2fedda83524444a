"""The queries ``opN_<name>``: each operator applied to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, licenses, mixing, pages, quality, reputation, secrets, simhash, suffixes, topk
from .common import table


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    found = topk.top_k(vectors.where(F.col("id") % 20 == 0), vectors, k=20)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), width=4, budget=4)
    return groups.select("doc_id", simhash.hex64("fp").alias("fingerprint"), "component_id")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    base = F.filter("spans", lambda s: s["kind"] != secrets.KINDS[3])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(k) for k in secrets.KINDS[:3]),
        F.sha2(secrets.as_string(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_string(F.col("spans")).alias("spans"),
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    labelled = labels.select("doc_id", mixing.domain_of_labels(F.col("quality"), F.col("toxic")).alias("domain"))
    return mixing.mix(table(spark, sf_dir, "documents"), labelled, mixing.TARGETS)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"), within="host").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    best = F.sort_array(F.transform("matches", lambda m: F.struct(-m["coverage"], m["license"])))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.get(best, F.lit(0))["license"].alias("license"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("spans"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_source_mixing": op5_source_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_decontamination": op10_decontamination,
}
