"""Secret scans: fixed patterns, and a likelihood ratio of two character Markov models.

One model is of random strings, one of ordinary identifiers. Both are
first-order Markov chains over letters, digits and a few signs, counted over
the whole corpus: the values that the fixed patterns find are the samples
labelled random, the remaining tokens those labelled ordinary. A further token
is a secret if the random model explains it better by a set margin, whatever it
is made of: the ratio alone decides.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, rows_of, sliced

# The base patterns, and the least lengths of their matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "markov")

#: The models' symbols; 0 stands for a boundary.
SYMBOLS = string.ascii_letters + string.digits + "+/_=-"
SIZE = len(SYMBOLS) + 1
CODES = np.zeros(256, np.uint8)
CODES[[ord(c) for c in SYMBOLS]] = np.arange(1, SIZE)
#: Runs of symbols that are judged: the least length, as for the base patterns' values.
LEAST_TOKEN = 8
#: Nats by which the random model has to win: the prior odds, as random strings are that much rarer than identifiers.
MARGIN = 12.0
#: Bytes judged at once, about.
PIECE = 1 << 20


def base_spans(text: str, data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind's index, end) of the base matches, leftmost and non-overlapping for each kind."""
    found = []
    low = data.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _values(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The secret part of each base match."""
    return [ASSIGN.match(text, a)[2] if kind == 0 else text[a:b] for a, kind, b in spans]


def _pairs(data: bytes) -> np.ndarray:
    """Counts of adjacent symbols, flattened; boundaries included."""
    codes = CODES[np.frombuffer(b" " + data + b" ", np.uint8)].astype(np.int32)
    return np.bincount(codes[:-1] * SIZE + codes[1:], minlength=SIZE * SIZE)


def count_pairs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(label, pair, n)``: how often each pair of symbols occurs in samples of either label.

    At most ``2 * SIZE ** 2`` rows whatever the corpus.
    """

    def run(batches):
        totals = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in sliced(batches):
            for (data,) in rows_of([batch], "t"):
                text = data.decode()
                spans = base_spans(text, data)
                if spans:
                    for value in _values(text, spans):
                        totals[1] += _pairs(value.encode())
                    at, rest = 0, []
                    for a, _, b in spans:
                        rest.append(text[at:a])
                        at = max(at, b)
                    data = " ".join([*rest, text[at:]]).encode()
                for start in range(0, len(data), 1 << 22):
                    totals[0] += _pairs(data[start : start + (1 << 22)])
        label, pair = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(totals[label, pair], pa.int64())], ["label", "pair", "n"])

    counted = docs.select(as_bytes(text_col).alias("t")).mapInArrow(run, "label int, pair int, n long")
    return counted.groupBy("label", "pair").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text_col: str = "text", smoothing: float = 0.5) -> np.ndarray:
    """The matrix of log-likelihood ratios of one symbol after another, random over ordinary."""
    counts = np.full((2, SIZE * SIZE), smoothing)
    for label, pair, n in count_pairs(docs, text_col).collect():
        counts[label, pair] += n
    counts = counts.reshape(2, SIZE, SIZE)
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    return logs[1] - logs[0]


def ratio(ratios: np.ndarray, token: str) -> float:
    codes = CODES[np.frombuffer(token.encode(), np.uint8)]
    return float(ratios[np.concatenate([[0], codes]), np.concatenate([codes, [0]])].sum())


def _runs(data: bytes, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, ratio) of all runs of symbols, in bytes; whole arrays at a time."""
    codes = CODES[np.frombuffer(b" " + data + b" ", np.uint8)]
    inside = codes != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    steps = ratios.ravel()[codes[:-1].astype(np.int32) * SIZE + codes[1:]]
    sums = np.concatenate([[0.0], np.cumsum(steps)])
    return starts, ends, sums[ends + 1] - sums[starts]


def markov_spans(data: bytes, ratios: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) in code points of the tokens that the random model explains better, by the margin."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and CODES[data[end]]:  # no token is cut
            end += 1
        starts, ends, scores = _runs(data[at:end], ratios)
        hit = (ends - starts >= LEAST_TOKEN) & (scores >= MARGIN)
        found += [(at + a, at + b) for a, b in zip(starts[hit].tolist(), ends[hit].tolist(), strict=True)]
        at = end
    if not found or data.isascii():
        return found
    before = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    place = lambda i: int(before[i - 1]) if i else 0
    return [(place(a), place(b)) for a, b in found]


def all_spans(text: str, data: bytes, ratios: np.ndarray) -> list[tuple[int, int, int]]:
    """Base matches, and tokens apart from them that look random, in order."""
    spans = base_spans(text, data)
    more = [(a, 3, b) for a, b in markov_spans(data, ratios) if not any(x < b and a < y for x, _, y in spans)]
    return sorted(spans + more) if more else spans


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` of every row: kind, start and end (code points, end exclusive).

    Null and empty texts have no spans; rows are handled one by one, so that
    repeated rows, null ids and other columns make no difference.
    """
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = T.StructType([docs.schema[id_col], T.StructField("spans", SPANS)])

    def run(batches):
        for batch in sliced(batches):
            out = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in all_spans(t.decode(), t, model.value)] for (t,) in rows_of([batch], "t")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, ARROW_SPANS)], schema.names)

    return docs.select(F.col(id_col), as_bytes(text_col).alias("t")).mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by a mark, and the length column, where there is one, brought up to date.

    Rows without secrets, null and empty texts among them, stay as they are,
    with their length whatever it says; rows are handled one by one, so that
    repeated rows, null ids and other columns make no difference; an empty
    table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    at = docs.columns.index(text_col)
    lengths = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches):
        for whole in batches:
            for batch in sliced([whole]):
                columns, texts = list(batch.columns), batch.column(at).to_pylist()
                new, changed = [], {}
                for i, t in enumerate(texts):
                    spans = all_spans(t, t.encode(), model.value) if t else []
                    if spans:
                        t = changed[i] = redacted(t, spans)
                    new.append(t)
                columns[at] = pa.array(new, columns[at].type)
                if changed and lengths is not None:
                    old = columns[lengths].to_pylist()
                    columns[lengths] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(old)], columns[lengths].type)
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def as_string(spans: F.Column) -> F.Column:
    """``kind:start:end`` of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


