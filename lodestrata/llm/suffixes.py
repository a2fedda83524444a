"""Exact removal of repeated substrings by external induced suffix sorting.

A window is any string of ``length`` bytes of a text. All windows that also
start earlier in the corpus are to be found. Sorting every suffix would do
that; here only the sampled suffixes are sorted outright, and the order of
the others is induced from them, as in external induced sorting:

1. Every window has an anchor, the place of the least hash among its k-grams
   (the leftmost of equals). Equal windows have their anchors at the same
   distance from the start, so equal windows meet in the shard of their
   anchor's k-gram. Anchors whose k-gram occurs once are dropped.
2. A shard's tuples - right context, left context, position - are sorted
   externally by Spark, whose sorter spills sorted runs to disk and merges
   them through a priority queue. That orders the suffixes that begin at the
   anchors; neighbours' common prefixes are measured once.
3. The suffixes that begin one byte further left are ordered by that byte and
   then by the order that is already there, again and again until no window of
   a shard begins as far left. Common prefixes go along: one more than the
   least between the two places that neighbours held before.
4. Neighbours whose common prefix reaches ``length`` are equal windows; all but
   the earliest are removed.

Repetition that is plain is taken out first: whole copies of texts, and anchors
whose context has been seen in the same text. A shard is split before it becomes
large: where more than ``crowd`` texts share one k-gram, each of their windows is
dealt out by its own content. Such k-grams are looked for before anything is
dealt out by k-gram, so that the anchors of a crowd never meet in one task. Nothing is dropped, and comparisons are of bytes
(of SHA-256 for whole texts), so other hashes decide only where work is done.
"""

from __future__ import annotations

import gc
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, cut

LENGTH = 100
GRAM = 24
#: Texts with one k-gram whose tuples are sorted together at most.
CROWD = 50_000
#: A task reports the k-grams that so many of its texts share; ``SEGMENT`` k-grams are held at once for that.
LOCAL = 8
SEGMENT = 1 << 22
#: k-grams of crowds that are broadcast at most (8 MB); more are joined by a shuffle.
NAMED = 1 << 20
#: Bytes hashed at once; longer texts are taken in overlapping pieces.
PIECE = 1 << 20
#: Tuples induced at once, about.
BATCH = 50_000
PLACE = np.uint64((1 << 24) - 1)
LEAST_ID = -(1 << 63)

_random = np.random.default_rng(20240229)
BYTE_CODES = _random.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams, by doubling their length."""
    one, one_len, out, out_len = BYTE_CODES[data], 1, None, 0
    while True:
        if k & one_len:
            out = one if out is None else out[: len(data) - out_len - one_len + 1] * _power(one_len) + one[out_len : out_len + len(data) - out_len - one_len + 1]
            out_len += one_len
        if out_len == k:
            break
        one = one[:-one_len] * _power(one_len) + one[one_len:]
        one_len *= 2
    out = out ^ (out >> np.uint64(32))
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text's index, offset, bytes) in lists of about PIECE bytes."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[at : at + PIECE + length - 1]
            if len(part) >= length:
                held.append((i, at, part))
                size += len(part)
                if size >= PIECE:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def find_anchors(texts: list[bytes], length: int = LENGTH, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text's index, hash, packed anchor) of all anchors.

    An anchor packs its place with the least and greatest distance to the
    starts of the windows that it stands for.
    """
    out = []
    for pieces in _pieces(texts, length):
        sizes = np.array([len(p) for *_, p in pieces])
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(p for *_, p in pieces), np.uint8)
        hashes = _gram_hashes(data, k)
        least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width, span = length - k + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        inside = np.zeros(len(data) + 1, np.int8)
        inside[begins] += 1
        inside[begins + sizes - length + 1] -= 1
        starts = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
        anchor = (least[starts] & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        last = np.append(first[1:] - 1, len(starts) - 1)
        place = anchor[first]
        piece = np.searchsorted(begins, starts[first], "right") - 1
        shift = np.array([at for _, at, _ in pieces])[piece] - begins[piece]
        packed = (place + shift) << 16 | (place - starts[last]) << 8 | (place - starts[first])
        out.append((np.array([i for i, *_ in pieces])[piece], hashes[place].view(np.int64), packed))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 16, packed >> 8 & 255, packed & 255


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def gathered(which: np.ndarray, h: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """One row for the anchors of a text that share a k-gram: the first, and the steps to the others (small if periodic)."""
    order = np.lexsort((packed, h, which))
    which, h, packed = which[order], h[order], packed[order]
    begins = _runs(which, h)
    sizes = np.diff(np.append(begins, len(h)))
    more: list[bytes | None] = [None] * len(begins)
    for k in np.flatnonzero(sizes > 1).tolist():
        more[k] = zlib.compress(np.diff(packed[begins[k] : begins[k] + sizes[k]]).tobytes(), 1)
    return which[begins], h[begins], packed[begins], more


def expanded(packed: int, more: bytes | None) -> list[int]:
    if more is None:
        return [packed]
    return [packed, *(packed + np.cumsum(np.frombuffer(zlib.decompress(more), np.int64))).tolist()]


def repeated_only(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Rows (h, doc, copy, packed, more) that share their ``h`` or stand for several anchors, with a mark on those of a crowd.

    Rows come sorted by ``h``, with a sixth column that tells those whose
    k-gram is known to have a crowd, of which there may be more elsewhere.
    """
    held: list[np.ndarray] | None = None
    crowded = None
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def give(columns, end):
        nonlocal crowded
        h = columns[0][:end]
        begins = _runs(h)
        sizes = np.diff(np.append(begins, end))
        size = np.repeat(sizes, sizes)
        mark = (size > crowd) | columns[5][:end]
        if crowded is not None:
            mark |= h == crowded
        keep = (size > 1) | mark | np.array([m is not None for m in columns[4][:end]], bool)
        if mark.any():
            crowded = h[np.flatnonzero(mark)[-1]]
        return pa.RecordBatch.from_arrays([pa.array(c[:end][keep], t) for c, t in zip(columns, types, strict=False)] + [pa.array(mark[keep])], ["h", "doc", "copy", "packed", "more", "crowded"])

    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        last = int(_runs(held[0])[-1]) if len(held[0]) else 0
        if len(held[0]) - last > crowd:  # an open group that is a crowd already
            last = len(held[0])
        if last:
            yield give(held, last)
            held = [c[last:] for c in held]
    if held is not None and len(held[0]):
        yield give(held, len(held[0]))


# One shard, or several side by side.


def _matrix(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros((len(texts), width), np.uint8)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out, sizes


class RangeMinimum:
    """Least value between two places of an array, by doubling."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            v, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(v[:-half], v[half:]))
        widest = max(map(len, self.levels), default=0)
        self.table = np.zeros((len(self.levels), widest), values.dtype)
        for k, v in enumerate(self.levels):
            self.table[k, : len(v)] = v

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Over places ``low`` to ``high``, both included."""
        k = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        return np.minimum(self.table[k, low], self.table[k, high - (1 << k) + 1])


def induce(shard: np.ndarray, right: list[bytes], left: list[bytes], near: np.ndarray, far: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each tuple and distance from its anchor, whether the window there has an earlier equal.

    Tuples come sorted by shard and right context; ``left`` is read from the
    anchor outwards; ``near`` and ``far`` bound the distances at which the
    tuple's windows start; ``order`` is the order of the tuples' positions.
    """
    n = len(shard)
    r, r_size = _matrix(right, length)
    differs = np.concatenate([r[1:] != r[:-1], np.ones((n - 1, 1), bool)], axis=1).argmax(axis=1)
    common = np.zeros(n, np.int64)
    common[1:] = np.minimum(differs, np.minimum(r_size[1:], r_size[:-1]))
    common[1:][shard[1:] != shard[:-1]] = 0
    prefix = RangeMinimum(common.astype(np.uint16))
    deepest = int(far.max(initial=0))
    l_bytes, _ = _matrix(left, max(1, deepest))
    removed = np.zeros((n, deepest + 1), bool)
    begins = _runs(shard)
    cls = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
    at = np.arange(n)  # tuples in the order of the suffixes at this distance
    for d in range(deepest + 1):
        # Suffixes alone in their class stay alone further left.
        sizes = np.bincount(cls)
        alive = sizes[cls] > 1
        at, cls = at[alive], cls[alive]
        if not len(at):
            break
        here = (near[at] <= d) & (far[at] >= d)
        some, of = at[here], cls[here]
        if len(some) > 1:
            same = np.zeros(len(some), bool)
            pair = np.flatnonzero(of[1:] == of[:-1])
            same[pair + 1] = prefix.least(some[pair] + 1, some[pair + 1]) >= length - d
            run = np.flatnonzero(~same)
            earliest = np.minimum.reduceat(order[some], run)
            removed[some, d] = order[some] != np.repeat(earliest, np.diff(np.append(run, len(some))))
        further = far[at] > d
        at, cls = at[further], cls[further]
        if not len(at):
            break
        key = cls * 256 + l_bytes[at, d]
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        new = np.ones(len(key), np.int64)
        new[0] = 0
        new[1:] = key[1:] != key[:-1]
        cls = np.cumsum(new)
    return removed


OUT = ["doc", "copy", "first", "last"]


def _intervals(doc, copy, place, removed) -> list[np.ndarray]:
    """Runs of starts of removed windows, from the matrix of distances."""
    edge = np.diff(np.pad(removed, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    return [doc[row], copy[row], place[row] - end + 1, place[row] - begin]


def sorted_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of starts of repeated windows; tuples (shard, right, left, doc, copy, packed) come sorted.

    A row without contexts is a run that is known already: its left end in
    ``shard``, its right end in ``packed``.
    """
    held: list = []
    size = 0
    last = None  # the tuple that stands for those equal to it
    names = ["shard", "right", "left", "doc", "copy", "packed"]

    def joined():
        h = [np.concatenate([b[k] for b in held]) for k in (0, 3, 4, 5)]
        return h[0], [x for b in held for x in b[1]], [x for b in held for x in b[2]], h[1], h[2], h[3]

    def solve(shard, right, left, doc, copy, packed):
        place, near, far = unpack(packed)
        order = np.empty(len(shard), np.int64)
        order[np.lexsort((place, copy, doc))] = np.arange(len(shard))
        found = induce(shard, right, left, near, far, order, length)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in _intervals(doc, copy, place, found)], OUT)

    for batch in batches:
        known = batch.column(1).is_null()
        if known.true_count:
            some = batch.filter(known)
            yield pa.RecordBatch.from_arrays([some.column(k) for k in (3, 4, 0, 5)], OUT)
            batch = batch.filter(pc.invert(known))
        if not batch.num_rows:
            continue
        shard, doc, copy, packed = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("shard", "doc", "copy", "packed"))
        right, left = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        place, near, far = unpack(packed)
        # Equal tuples are sorted once: the first is the earliest, and all windows of the others are repeated.
        again = np.zeros(batch.num_rows, bool)
        before = last
        for i in range(batch.num_rows):
            now = (shard[i], packed[i] & 0xFFFF, right[i], left[i])
            again[i] = now == before
            before = now
        last = before
        if again.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[again]) for c in (doc, copy, place - far, place - near)], OUT)
        kept = np.flatnonzero(~again)
        held.append((shard[kept], [right[i] for i in kept], [left[i] for i in kept], doc[kept], copy[kept], packed[kept]))
        size += len(kept)
        if size >= BATCH:
            whole = joined()
            begins = _runs(whole[0])
            end = int(begins[-1])
            if end:
                yield solve(*(c[:end] for c in whole))
            held = [tuple(c[end:] for c in whole)]
            size = len(whole[0]) - end
    if size:
        yield solve(*joined())


# Whole corpora.


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, copy, t)``: the id (null first), the row's number among those with its id, and the bytes."""
    lean = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("doc"), as_bytes(text_col).alias("t"))
    if not lean.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        return lean.select("doc", F.lit(0).alias("copy"), "t")
    return lean.select("doc", (F.row_number().over(Window.partitionBy("doc").orderBy("t")) - 1).alias("copy"), "t")


def copies_of_texts(texts: DataFrame) -> DataFrame:
    """``(doc, copy, n_bytes)`` of the texts that are the same as an earlier one."""
    lean = texts.select("doc", "copy", F.length("t").cast("long").alias("n_bytes"), F.unhex(F.sha2("t", 256)).alias("of"))
    first = lean.groupBy("of").agg(F.min(F.struct("doc", "copy")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return lean.join(cut(first.select("of", "first")), "of").where(F.struct("doc", "copy") != F.col("first")).select("doc", "copy", "n_bytes")


def _joined_runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _contexts(doc: int, copy: int, data: bytes, anchors: list, length: int) -> Iterator[tuple]:
    """The tuples of a text, each context once, and the runs of windows whose context the text has had before."""
    known = []
    for a in anchors:
        seen = set()
        for packed in expanded(a["packed"], a["more"]):
            place, near, far = packed >> 16, packed >> 8 & 255, packed & 255
            right, left = data[place : place + length - near], data[place - far : place][::-1]
            if a["more"] is not None:
                if (packed & 0xFFFF, right, left) in seen:
                    known.append((place - far, place - near))
                    continue
                seen.add((packed & 0xFFFF, right, left))
            yield a["h"], right, left, doc, copy, packed
    for first, last in _joined_runs(known):
        yield first, None, None, doc, copy, last


def _batched(rows: Iterator[tuple], types: list[tuple[str, pa.DataType]], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    names = [n for n, _ in types]
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held, strict=True), types, strict=True)], names)


def _crowd_grams(texts: DataFrame, length: int, gram: int, crowd: int) -> DataFrame:
    """``(h)``: k-grams that more than ``crowd`` texts share.

    Counted where the texts are. A k-gram that a task meets in fewer than
    ``LOCAL`` texts isn't reported by it, so one that is not found here has at
    most ``crowd`` texts and ``LOCAL - 1`` more for each task's segment.
    """
    few, segment = min(LOCAL, crowd), SEGMENT

    def often(held):
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h[n >= few]), pa.array(n[n >= few])], ["h", "n"])

    def counts(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                which, h, _ = find_anchors(batch.column(0).slice(at, 256).to_pylist(), length, gram)
                order = np.lexsort((h, which))
                which, h = which[order], h[order]
                held.append(h[_runs(which, h)])
                size += len(held[-1])
                if size >= segment:
                    yield often(held)
                    held, size = [], 0
        if held:
            yield often(held)

    some = texts.select("t").mapInArrow(counts, "h long, n long")
    return cut(some.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > crowd).select("h"))


def _repeated_anchors(texts: DataFrame, length: int, gram: int, crowd: int) -> DataFrame:
    """``(doc, copy, calm, busy)``: for each text its anchors whose k-gram occurs again."""

    def anchors(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                which, h, packed, more = gathered(*find_anchors(b.column(2).to_pylist(), length, gram))
                doc, copy = (b.column(k).to_numpy(zero_copy_only=False)[which] for k in (0, 1))
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in (h, doc, copy, packed)), pa.array(more, pa.binary())], ["h", "doc", "copy", "packed", "more"])

    found = texts.mapInArrow(anchors, "h long, doc long, copy int, packed long, more binary")
    crowds = _crowd_grams(texts, length, gram, crowd)
    if named := crowds.count():
        crowds = crowds.select("h", F.lit(True).alias("named"))
        found = found.join(F.broadcast(crowds) if named <= NAMED else crowds, "h", "left")
        found = found.select("h", "doc", "copy", "packed", "more", F.coalesce("named", F.lit(False)).alias("named"))
        dealt = found.repartition("h", F.when(F.col("named"), F.xxhash64("doc", "copy")).otherwise(0))
    else:
        dealt = found.withColumn("named", F.lit(False)).repartition("h")
    shared = dealt.sortWithinPartitions("h").mapInArrow(lambda b: repeated_only(b, crowd), "h long, doc long, copy int, packed long, more binary, crowded boolean")
    calm = F.collect_list(F.when(~F.col("crowded"), F.struct("h", "packed", "more")))
    busy = F.collect_list(F.when(F.col("crowded"), F.struct("h", "packed", "more")))
    return cut(shared.groupBy("doc", "copy").agg(calm.alias("calm"), busy.alias("busy")))


def _release(df: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffle files of what has been written: they go once no object refers to them."""
    for _ in range(2):  # the second round finds what the first has let go of in the JVM
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def repeated_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``(doc, copy, first, last)``: runs of starts of windows that also start earlier, in ``texts(doc, copy, t)``."""
    copies = cut(copies_of_texts(texts))
    of_doc = _repeated_anchors(texts, length, gram, crowd).join(copies, ["doc", "copy"], "left_anti")
    _release(texts)

    def contexts(batches):
        types = [("shard", pa.int64()), ("right", pa.binary()), ("left", pa.binary()), ("doc", pa.int64()), ("copy", pa.int32()), ("packed", pa.int64())]
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = zip(*(batch.slice(at, 128).column(k).to_pylist() for k in range(4)), strict=True)
                yield from _batched((x for r in rows for x in _contexts(*r, length)), types)

    tuples = texts.join(of_doc.select("doc", "copy", "calm"), ["doc", "copy"]).mapInArrow(contexts, "shard long, right binary, left binary, doc long, copy int, packed long")
    dealt = tuples.repartition("shard").sortWithinPartitions("shard", "right", "left", "doc", "copy", "packed")
    runs = dealt.mapInArrow(lambda b: sorted_shards(b, length), "doc long, copy int, first long, last long")
    runs = runs.unionByName(copies.where(F.col("n_bytes") >= length).select("doc", "copy", F.lit(0).cast("long").alias("first"), (F.col("n_bytes") - length).alias("last")))
    if of_doc.where(F.size("busy") > 0).limit(1).count():
        runs = runs.unionByName(_crowded_windows(texts, of_doc, length))
    return runs


def _crowded_windows(texts: DataFrame, of_doc: DataFrame, length: int) -> DataFrame:
    """The same for anchors in crowds: windows are grouped by their whole content, partly before the shuffle."""

    def rows(doc, copy, data, anchors):
        seen, known = set(), []
        starts = sorted({s for a in anchors for p in expanded(a["packed"], a["more"]) for s in range((p >> 16) - (p & 255), (p >> 16) - (p >> 8 & 255) + 1)})
        for s in starts:
            w = data[s : s + length]
            if w in seen:
                known.append((s, s))
            else:
                seen.add(w)
                yield w, doc, copy, s, s
        for first, last in _joined_runs(known):
            yield None, doc, copy, first, last

    def windows(batches):
        types = [("w", pa.binary()), ("doc", pa.int64()), ("copy", pa.int32()), ("first", pa.int64()), ("last", pa.int64())]
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                some = zip(*(batch.slice(at, 128).column(k).to_pylist() for k in range(4)), strict=True)
                yield from _batched((x for r in some for x in rows(*r)), types)

    each = cut(texts.join(of_doc.where(F.size("busy") > 0).select("doc", "copy", "busy"), ["doc", "copy"]).mapInArrow(windows, "w binary, doc long, copy int, first long, last long"))
    open_ones = each.where("w is not null")
    earliest = cut(open_ones.groupBy("w").agg(F.min(F.struct("doc", "copy", "first")).alias("e"), F.count("*").alias("n")).where("n > 1").select("w", "e"))
    later = open_ones.join(earliest, "w").where(F.struct("doc", "copy", "first") != F.col("e"))
    return later.select("doc", "copy", "first", "last").unionByName(each.where("w is null").select("doc", "copy", "first", "last"))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, spans, kept)`` of every row: the removed runs of bytes, and the remaining bytes.

    A byte goes if a string of ``length`` bytes around it starts earlier too,
    in a row with a smaller id or earlier in the same row. Null and short
    texts lose nothing; null ids come before all others; rows with the same id
    are ordered by their text, so of repeated rows all but one are repeats.
    Long texts are treated whole. Other columns play no part; an empty table
    gives no rows.
    """
    if not 1 < gram < length <= 250:
        raise ValueError("needs 1 < gram < length <= 250")
    texts = _numbered(docs, id_col, text_col)
    runs = repeated_windows(texts, length, gram, crowd)
    of_doc = runs.groupBy("doc", "copy").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept", T.BinaryType())])
    id_type = pa.int64()

    def apply(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                ids, sizes, spans, kept = [], [], [], []
                for doc, data, found in zip(*(b.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                    removed: list[list[int]] = []
                    for run in found or ():
                        start, end = run["first"], run["last"] + length
                        if removed and start <= removed[-1][1]:
                            removed[-1][1] = max(removed[-1][1], end)
                        else:
                            removed.append([start, end])
                    left, to = [], 0
                    for start, end in removed:
                        left.append(data[to:start])
                        to = end
                    left.append(data[to:])
                    ids.append(None if doc == LEAST_ID else doc)
                    sizes.append(len(data))
                    spans.append([{"start": s, "end": e} for s, e in removed])
                    kept.append(b"".join(left))
                types = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(sizes, pa.int64()), pa.array(spans, types), pa.array(kept, pa.binary())], schema.names)

    plain = T.StructType([T.StructField(id_col, T.LongType()), *schema.fields[1:]])
    done = texts.join(of_doc, ["doc", "copy"], "left").select("doc", "copy", "t", "runs").mapInArrow(apply, plain)
    return done.select(F.col(id_col).cast(schema[id_col].dataType).alias(id_col), "n_bytes", "spans", "kept")
