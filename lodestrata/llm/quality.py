"""Quality classifier: a factorisation machine over hashed words, text structure and length.

Score of a document with features x: sigmoid of
``w0 + sum_j w_j x_j + 1/2 sum_f ((sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2)``,
the sum-of-squares identity that makes all pairwise interactions linear in the
number of features. Labels, language, source and ids are never features.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, rows_of, sliced

BUCKETS = 1 << 14
FACTORS = 8
#: Labelled rows that the model is fitted on at most, those with the least hash of their id.
SAMPLE = 8000
THRESHOLD = 0.7
SIGNS = b"#*$%&!|<>{}[]@=~^_"
NON_ASCII = bytes(range(128, 256))
N_STRUCTURE = 16

_buckets: dict[bytes, int] = {}


def _bucket(word: bytes) -> int:
    got = _buckets.get(word)
    if got is None:
        if len(_buckets) > 1 << 18:
            _buckets.clear()
        got = _buckets[word] = zlib.crc32(word) % BUCKETS
    return got


def _structure(data: bytes, counts: Counter, n_words: int) -> list[float]:
    """Ratios and log sizes, each of the order of one."""
    n = max(1, len(data))
    upper = n - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = n - len(data.translate(None, b"0123456789"))
    signs = n - len(data.translate(None, SIGNS))
    foreign = n - len(data.translate(None, NON_ASCII)) if data else 0
    stops = data.count(b".") + data.count(b"!") + data.count(b"?")
    lines = data.split(b"\n")
    distinct_lines = len(set(lines))
    words = max(1, n_words)
    odd = sum(c for w, c in counts.items() if not w[-1:].isalnum() and w[-1] < 128)
    marked = sum(c for w, c in counts.items() if w[-1] in SIGNS)
    common = max(counts.values(), default=0)
    return [
        10 * upper / n,
        10 * digits / n,
        10 * signs / n,
        4 * odd / words,
        4 * marked / words,
        2 * (1 - len(counts) / words),
        2 * (1 - distinct_lines / len(lines)),
        np.log1p(n) / 8,
        np.log1p(n_words) / 6,
        np.log1p(len(lines)) / 3,
        n / words / 8,
        10 * stops / words,
        10 * data.count(b"|") / words,
        4 * common / words,
        10 * foreign / n,
        1.0 if not n_words else 0.0,
    ]


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): words by bucket with damped counts of unit length, then structure."""
    words = data.lower().split()
    counts = Counter(words)
    by_bucket: dict[int, int] = {}
    for w, c in counts.items():
        b = _bucket(w)
        by_bucket[b] = by_bucket.get(b, 0) + c
    values = np.log1p(np.fromiter(by_bucket.values(), np.float32, len(by_bucket)))
    norm = float(np.sqrt((values * values).sum())) or 1.0
    indices = np.concatenate([np.fromiter(by_bucket, np.int32, len(by_bucket)), np.arange(BUCKETS, BUCKETS + N_STRUCTURE, dtype=np.int32)])
    return indices, np.concatenate([values / norm, np.array(_structure(data, counts, len(words)), np.float32)]).astype(np.float32)


@dataclass
class Machine:
    """The fitted parameters; ``mean`` and ``spread`` scale the structure features."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, indices: np.ndarray, values: np.ndarray) -> np.ndarray:
        out, dense = values.copy(), indices >= BUCKETS
        k = indices[dense] - BUCKETS
        out[dense] = np.clip((values[dense] - self.mean[k]) / self.spread[k], -4, 4) / 4
        return out

    def raw(self, indices: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums of ``v_jf x_j``, of documents laid end to end."""
        vx = self.factors[indices] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * ((sums * sums).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
        return self.bias + np.add.reduceat(self.linear[indices] * x, starts) + pairs, sums


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.05, decay: float = 1e-4, batch: int = 128, seed: int = 0) -> Machine:
    """AdaGrad on the log loss; the same rows in the same order give the same model.

    No rows, or rows of one class only, give a model that scores all
    documents alike at the smoothed rate of label 1.
    """
    size, rng = BUCKETS + N_STRUCTURE, np.random.default_rng(seed)
    ones = sum(y for *_, y in rows)
    bias = float(np.log((ones + 1) / (len(rows) - ones + 1)))
    m = Machine(bias, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32), np.zeros(N_STRUCTURE, np.float32), np.ones(N_STRUCTURE, np.float32))
    if not 0 < ones < len(rows):
        return m
    m.factors = rng.normal(0, 0.01, (size, FACTORS)).astype(np.float32)
    dense = np.stack([v[-N_STRUCTURE:] for _, v, _ in rows])
    m.mean, m.spread = dense.mean(0), dense.std(0) + 1e-3
    prepared = [(i, m.scaled(i, v), y) for i, v, y in rows]
    g_bias, g_linear, g_factors = 1e-6, np.full(size, 1e-6, np.float32), np.full((size, FACTORS), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(prepared))
        for at in range(0, len(order), batch):
            some = [prepared[k] for k in order[at : at + batch]]
            lengths = np.array([len(i) for i, *_ in some])
            starts = np.cumsum(lengths) - lengths
            idx, x = np.concatenate([i for i, *_ in some]), np.concatenate([v for _, v, _ in some])
            z, sums = m.raw(idx, x, starts)
            error = (_sigmoid(z) - np.array([y for *_, y in some])).astype(np.float32) / len(some)
            each = np.repeat(error, lengths) * x
            used, where = np.unique(idx, return_inverse=True)
            d_linear = np.bincount(where, each, len(used)).astype(np.float32) + decay * m.linear[used]
            d_each = each[:, None] * (np.repeat(sums, lengths, axis=0) - m.factors[idx] * x[:, None])
            d_factors = np.stack([np.bincount(where, d_each[:, f], len(used)) for f in range(FACTORS)], 1).astype(np.float32) + decay * m.factors[used]
            g_linear[used] += d_linear**2
            g_factors[used] += d_factors**2
            g_bias += float(error.sum()) ** 2
            m.linear[used] -= rate * d_linear / np.sqrt(g_linear[used])
            m.factors[used] -= rate * d_factors / np.sqrt(g_factors[used])
            m.bias -= rate * float(error.sum()) / g_bias**0.5
    return m


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that are kept from training: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Machine:
    """Fit on at most ``sample`` labelled rows that aren't held out.

    The sample is of the ids with the least hash, so it doesn't depend on the
    order of rows. Rows without id or with a label other than 0 and 1 don't
    count; of an id with several labels the least is taken, of an id with
    several documents each is a row up to the bound.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    chosen = usable.groupBy(id_col).agg(F.min(label_col).cast("int").alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(sample)
    picked = docs.sparkSession.createDataFrame(chosen.collect() or [], chosen.schema)

    def run(batches):
        for batch in sliced(batches):
            made = [features(t) for (t,) in rows_of([batch], "t")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([i.tobytes() for i, _ in made], pa.binary()), pa.array([v.tobytes() for _, v in made], pa.binary())], ["id", "y", "i", "v"])

    # The chosen ids are at most `sample` rows, which bounds the broadcast.
    labelled = docs.select(F.col(id_col), as_bytes(text_col).alias("t")).join(F.broadcast(picked), id_col)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("y", T.IntegerType()), T.StructField("i", T.BinaryType()), T.StructField("v", T.BinaryType())])
    rows = labelled.select(F.col(id_col).alias("id"), "y", "t").mapInArrow(run, schema).orderBy(F.xxhash64("id"), "id", "i", "v").limit(sample).collect()
    return fit([(np.frombuffer(r.i, np.int32), np.frombuffer(r.v, np.float32), r.y) for r in rows])


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, keep: bool = False) -> DataFrame:
    """``(id, score, predicted)`` of every row; with ``keep``, instead the rows of ``docs`` whose score reaches ``threshold``.

    Null text counts as empty, and an empty text is scored by its structure.
    Rows are handled one by one: repeated rows and other columns make no
    difference. An empty table gives no rows.
    """
    machine = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: list[bytes]) -> np.ndarray:
        m = machine.value
        made = [features(t) for t in texts]
        x = np.concatenate([m.scaled(i, v) for i, v in made])
        lengths = np.array([len(i) for i, _ in made])
        return _sigmoid(m.raw(np.concatenate([i for i, _ in made]), x, np.cumsum(lengths) - lengths)[0].astype(np.float64))

    def run(batches):
        for batch in sliced(batches, 256):
            s = scores([t for (t,) in rows_of([batch], "t")])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [id_col, "score", "predicted"])

    def kept(batches):
        for batch in sliced(batches, 256):
            texts = [(t or "").encode() for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield batch.filter(pa.array(scores(texts) >= threshold))

    if keep:
        return docs.mapInArrow(kept, docs.schema)
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(F.col(id_col), as_bytes(text_col).alias("t")).mapInArrow(run, schema)
