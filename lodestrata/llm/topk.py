"""Exact top-k search by inner product with the three-phase uniform threshold.

The score of a candidate is a sum over ``lists`` groups of dimensions, each a
score list of its own. Phase one gathers from every partition the best entries
of each list and turns them into totals; the k-th best total of all gathered is
a cutoff ``t`` that the true k-th best cannot be below. Phase two broadcasts
the cutoffs and collects the entries of at least ``t / lists``: a candidate
without any such entry totals less than ``t``. A candidate's known entries, and
``t / lists`` for each unknown one, bound its total; under ``t`` it is dropped.
Phase three resolves the missing entries of the rest and keeps the best k.

Queries are taken in waves of at most ``wave``; only a wave's vectors and
cutoffs are ever broadcast.

The lists aren't stored in order anywhere, so each phase multiplies all of a
wave's queries with all candidates: the cutoffs bound what is sent and sorted,
not the multiplications.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

LISTS = 4
#: Queries broadcast at once at most.
WAVE = 8192
#: Scores held at once in a task, about.
CELLS = 1 << 21
FAN = 64


def usable(vector: F.Column) -> F.Column:
    """Not null, and without null, NaN or infinite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of float64, short ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), dims))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[type, float]:
    """The fastest type in which all products and sums of integers this large are exact; else the share by which sums may be off."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (np.float32, 0.0) if most < 1 << 24 else (np.float64, 0.0 if most < 1 << 53 else 1e-9 * most)


def _long(scores: np.ndarray) -> np.ndarray:
    top = float(np.nextafter(2.0**63, 0))
    return np.clip(scores.astype(np.float64), -top, top).astype(np.int64)


def _blocks(queries: int, rows: int, lists: int):
    step = max(1, CELLS // max(1, rows * lists))
    for at in range(0, queries, step):
        yield slice(at, min(queries, at + step))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, in order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, lists: int = LISTS, wave: int = WAVE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its k highest inner products, ties to the smaller id.

    Both inputs have ``id`` long and ``v``, an array of doubles holding
    integers. Rows with a null id, or with a vector that is null or has a null
    or non-finite component, take no part; vectors shorter than the longest
    count as zero beyond their end. A candidate with the query's own id is no
    match for it; repeated candidates each take a rank, repeated queries
    (same id) are asked once, with the greatest vector. Fewer candidates
    give fewer rows, an empty table none. Scores are exact up to 2^53; larger
    ones are those of double arithmetic, within the range of long.
    """
    spark = queries.sparkSession
    fit = F.col("id").isNotNull() & usable(F.col("v"))
    candidates = candidates.where(fit).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    queries = cut(queries.where(fit).groupBy(F.col("id").cast("long").alias("id")).agg(F.max(F.col("v").cast("array<double>")).alias("v")))
    n = queries.count()
    dims = candidates.agg(F.max(F.size("v"))).first()[0] or 0
    dims = max(dims, queries.agg(F.max(F.size("v"))).first()[0] or 0)
    waves = max(1, ceil(n / (0.9 * wave)))
    parts = []
    for w in range(waves if n else 0):
        own = queries.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == w).orderBy("id").collect()
        for at in range(0, len(own), wave):
            some = own[at : at + wave]
            found, sent = _wave(spark, np.array([r.id for r in some]), [r.v for r in some], candidates, dims, k, lists)
            if n > wave:  # a wave's result is written and its broadcasts let go of before the next
                found = cut(found)
                for b in sent:
                    b.unpersist()
            parts.append(found)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, parts)


def _wave(spark, ids: np.ndarray, vectors: list, candidates: DataFrame, dims: int, k: int, lists: int) -> tuple[DataFrame, list]:
    matrix = np.zeros((len(ids), dims))
    for i, v in enumerate(vectors):
        matrix[i, : len(v)] = v
    sent = spark.sparkContext.broadcast((ids, matrix))
    groups = [slice(dims * g // lists, dims * (g + 1) // lists) for g in range(lists)]

    def partial(q, c, kind):
        return [(q[:, g].astype(kind)) @ (c[:, g].astype(kind).T) for g in groups]

    def partition(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                b = batch.slice(start, 4096)
                yield b.column(0).to_numpy(), _matrix(b.column(1), dims)

    def gather(batches):
        """Per query: the totals of the candidates that lead this partition's lists, the best k."""
        qid, q = sent.value
        best = np.full((len(qid), k), -np.inf)
        for cid, c in partition(batches):
            kind, slack = _exact(q, c)
            for rows in _blocks(len(qid), len(cid), lists):
                scores = partial(q[rows], c, kind)
                total = sum(scores).astype(np.float64) - slack
                own = qid[rows][:, None] == cid[None, :]
                lead = np.zeros(total.shape, bool)
                for s in scores:
                    s = np.where(own, -np.inf, s.astype(np.float64))
                    m = min(k, s.shape[1])
                    lead[np.arange(len(s))[:, None], np.argpartition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m :]] = True
                merged = np.concatenate([best[rows], np.where(lead & ~own, total, -np.inf)], axis=1)
                best[rows] = np.partition(merged, merged.shape[1] - k, axis=1)[:, merged.shape[1] - k :]
        yield pa.RecordBatch.from_arrays([pa.array(qid), pa.array([x[np.isfinite(x)] for x in best], pa.list_(pa.float64()))], ["query_id", "best"])

    local = candidates.mapInArrow(gather, "query_id long, best array<double>").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    head = F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, k)
    merged = local.groupBy("query_id", "part").agg(head.alias("best")).groupBy("query_id").agg(head.alias("best"))
    kth = merged.select("query_id", F.when(F.size("best") == k, F.element_at("best", -1)).alias("t")).where("t is not null")
    known = dict(kth.collect())
    cutoffs = spark.sparkContext.broadcast(np.array([known.get(i, -np.inf) for i in ids.tolist()]))

    def collect(batches):
        qid, q = sent.value
        t = cutoffs.value
        for cid, c in partition(batches):
            kind, slack = _exact(q, c)
            out_q, out_c, out_s = [], [], []
            for rows in _blocks(len(qid), len(cid), lists):
                scores = partial(q[rows], c, kind)
                cutoff = t[rows][:, None] - slack
                each = cutoff / lists
                known_any, bound = np.zeros(scores[0].shape, bool), np.zeros(scores[0].shape)
                for s in scores:
                    sure = s >= each
                    known_any |= sure
                    bound += np.where(sure, s.astype(np.float64), each)
                left = known_any & ~((bound < cutoff)) & (qid[rows][:, None] != cid[None, :])
                for i in np.flatnonzero(left.any(axis=1)):
                    at = np.flatnonzero(left[i])
                    total = sum(s[i, at].astype(np.float64) for s in scores)
                    at, total = at[total >= cutoff[i]], _long(total[total >= cutoff[i]])
                    top = _best(total, cid[at], k)
                    out_q.append(np.full(len(top), qid[rows][i]))
                    out_c.append(cid[at[top]])
                    out_s.append(total[top])
            if out_q:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_c, out_s)], ["query_id", "vec_id", "score"])

    found = candidates.mapInArrow(collect, T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")]))
    ordered = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score"), [sent, cutoffs]


def scaled(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", by: float = 64.0) -> DataFrame:
    """``(id, v)`` with every component x as floor(by * x); components that aren't finite stay as they are."""
    v = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.floor(x * F.lit(by)).cast("double")))
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
