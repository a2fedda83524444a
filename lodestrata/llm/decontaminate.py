"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the word windows of all benchmark items. For each window
length, a table of shifts is kept by blocks of two words: where the block
under the window's end occurs in no pattern, the search skips nearly a whole
window; where it ends some pattern, a bucket by that suffix and by the first
block selects the patterns to test, and comparing all words confirms one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, cut, sliced

WINDOW = 13
#: Windows that one pass holds at most, about 1 KB each in a Python worker; a larger benchmark is searched for in several passes.
PASS_WINDOWS = 100_000

#: Bytes that are not part of a word become spaces; A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


class WuManber:
    """Search for patterns that are tuples of words, each with the names it stands for."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        by_length: dict[int, list] = defaultdict(list)
        for words in patterns:
            by_length[len(words)].append(words)
        self.names, self.tables = patterns, []
        for length, group in sorted(by_length.items()):
            block = min(2, length)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
            for words in group:
                for end in range(block, length + 1):
                    part = words[end - block : end]
                    shift[part] = min(shift.get(part, length), length - end)
                buckets[words[-block:]][words[:block]].append(words)
            self.tables.append((length, block, length - block + 1, shift, {k: dict(v) for k, v in buckets.items()}))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(start, end, names) of each occurrence, those of one length in order."""
        n = len(words)
        for length, block, default, shift, buckets in self.tables:
            at, get = length, shift.get
            while at <= n:
                part = tuple(words[at - block : at])
                step = get(part, default)
                if not step:
                    start = at - length
                    for pattern in buckets[part].get(tuple(words[start : start + block]), ()):
                        if pattern == tuple(words[start:at]):
                            yield start, at, self.names[pattern]
                    step = 1
                at += step


def windows(words: list[bytes], size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    """The windows of an item: all runs of ``size`` words; a shorter item that has words is one."""
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield tuple(words[i : i + size])


def _passes(items: DataFrame, size: int, most: int) -> Iterator[dict[tuple, set[str]]]:
    """Pattern tables of bounded size; items arrive a partition at a time."""
    found: dict[tuple, set[str]] = defaultdict(set)
    for name, data in items.toLocalIterator():
        for w in windows(words_of(bytes(data)), size):
            found[w].add(name)
            if len(found) >= most:
                yield dict(found)
                found = defaultdict(set)
    if found:
        yield dict(found)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _annotated(docs: DataFrame, items: DataFrame, names: tuple[str, str, str], size: int, text_col: str, item_col: str, item_text: str, most: int) -> DataFrame:
    """``docs`` and, under ``names``, the number of words, the spans and the items of each row.

    One table of patterns is built, sent and held at a time: passes are cut
    from each other, and a table is let go of before the next is built.
    """
    sc = docs.sparkSession.sparkContext
    named = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string"), as_bytes(item_text))
    added = list(zip(names, (T.LongType(), SPANS, T.ArrayType(T.StringType())), strict=True))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in added)])
    at, own = docs.columns.index(text_col), len(docs.columns)

    def step(table):
        def run(batches):
            for batch in sliced(batches):
                counts, spans, found_in = [], [], []
                rows = zip(*(batch.column(k).to_pylist() for k in (at, own + 1, own + 2)), strict=True)
                for text, before, known in rows:
                    words = words_of(text.encode() if isinstance(text, str) else text or b"")
                    runs, found = [(x["start"], x["end"]) for x in before or ()], set(known or ())
                    for a, b, who in table.value.search(words):
                        found |= who
                        if runs and runs[-1][0] <= a <= runs[-1][1]:
                            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
                        else:
                            runs.append((a, b))
                    counts.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in _union(runs)])
                    found_in.append(sorted(found))
                types = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                new = [pa.array(counts, pa.int64()), pa.array(spans, types), pa.array(found_in, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:own], *new], schema.names)

        return run

    out = docs.select("*", *(F.lit(None).cast(t).alias(n) for n, t in added))
    passes = _passes(named, size, most)
    patterns = next(passes, {})
    while True:
        table = sc.broadcast(WuManber(patterns))
        out = out.mapInArrow(step(table), schema)
        patterns = next(passes, None)
        if patterns is None:
            return out
        out = cut(out)
        table.unpersist()


def overlaps(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = PASS_WINDOWS) -> DataFrame:
    """``(id, n_words, spans, items)`` of every row of ``docs``.

    ``spans`` are the maximal runs of words, end exclusive, inside occurrences
    of item windows; ``items`` the sorted names of items that have one. Null
    and empty texts have no words. Items without words or without a name are
    passed over, items with the same name count as one, and without items no
    word is hit. Rows are handled one by one: repeated rows, null ids and other
    columns make no difference.
    """
    lean = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    found = _annotated(lean, items, ("n_words", "spans", "items"), size, "text", item_col, item_text, most)
    return found.select(F.col("id").alias(id_col), "n_words", "spans", "items")


def without_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = PASS_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, unchanged."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    names = tuple(prefix + n for n in ("n_words", "spans", "items"))
    found = _annotated(docs, items, names, size, text_col, item_col, item_text, most)
    return found.where(~contaminated(names[0], names[1])).select(*docs.columns)


def n_hit(spans: str = "spans") -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(n_words: str = "n_words", spans: str = "spans") -> F.Column:
    """At least a twentieth of the words, and one at least, are hit."""
    return (n_hit(spans) > 0) & (20 * n_hit(spans) >= F.col(n_words))
