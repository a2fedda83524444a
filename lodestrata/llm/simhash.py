"""SimHash near-duplicates by a binary-trie self-join.

Every document gets a 64-bit fingerprint of its word shingles. Fingerprints
within ``budget`` differing bits are linked. The join walks a binary trie of
the fingerprints against itself, pair of nodes by pair of nodes, adding up the
levels where the two nodes took different branches; a pair over the budget is
dropped with everything below it.

To spread the walk over a cluster, the 64 bits are cut into ``blocks`` blocks.
Two fingerprints within the budget agree on at least ``blocks - budget`` of
them, so for each choice of that many blocks a trie is built whose top levels
are those blocks: only equal top paths can be reached with no error spent, and
each subtrie below is one group of work. More fingerprints get more blocks, so
that groups stay small. A group that is still too large (a crowd of near
copies) is dealt by hash into chunks, and each pair of chunks is its own unit.
Each unit returns a spanning forest of its links, never the links themselves,
so a crowd of n near copies costs n rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, cut, rows_of, sliced
from .components import connected_components

SEED = 42
#: Fingerprints in a unit of work; larger groups are split into pairs of chunks.
UNIT = 4096
#: Compared at once at the trie's leaves.
LEAF_PAIRS = 1 << 20
#: Documents of a group that one task of the exact check compares with each other; Spark cuts off the others before its shuffle up to 1000.
GROUP = 1000
#: Entries of an inverted list of shingles that are held at once.
POSTINGS = 1 << 22
SETS = "root long, id long, set binary"


def shingle_hashes(data: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, repeats included, a bounded number at a time."""
    words = data.lower().split()
    if not words:
        return
    digest, join = xxhash.xxh64_digest, b" ".join
    shingles: Iterator = iter([words]) if len(words) <= width else zip(*(words[i:] for i in range(width)), strict=False)
    while raw := b"".join([digest(join(s), SEED) for s in islice(shingles, 1 << 16)]):
        yield np.frombuffer(raw, ">u8")


def _digested(data: bytes, width: int, seeds: int, distinct: bool) -> tuple[np.ndarray, bytes]:
    """Fingerprints of a text, and with ``distinct`` a 128-bit hash of the set of its shingles' hashes."""
    counts, n, sets = np.zeros((seeds, 64), np.int64), 0, []
    for hashes in shingle_hashes(data, width):
        n += len(hashes)
        if distinct:
            sets.append(np.unique(hashes.astype(np.uint64)))
        for k in range(seeds):
            h = hashes
            if k:
                h = (hashes.astype(np.uint64) ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
                h = ((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)).astype(">u8")
            counts[k] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    whole = sets[0] if len(sets) == 1 else np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]))
    digest = xxhash.xxh3_128_digest(whole.tobytes()) if distinct else b""
    return np.packbits(2 * counts > n, axis=1).view(">u8").reshape(-1).astype(np.uint64), digest


def fingerprint_set(data: bytes, width: int = 4, seeds: int = 1) -> np.ndarray:
    """Unsigned fingerprints of a text: majority of each bit over its shingles' hashes, as they are and mixed anew for each further seed."""
    return _digested(data, width, seeds, False)[0]


def fingerprint(data: bytes, width: int = 4) -> int:
    return int(fingerprint_set(data, width)[0])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text", seeds: int = 1, digest: bool = False) -> DataFrame:
    """``(id, fp)`` of every row, ``fp`` as a signed long; with more seeds also ``fp1``, ``fp2`` ... Null text counts as empty.

    With ``digest`` a hash of the set of shingles comes last.
    """
    names = ["fp", *(f"fp{k}" for k in range(1, seeds))]
    schema = T.StructType([docs.schema[id_col], *(T.StructField(n, T.LongType()) for n in names)])
    if digest:
        schema = schema.add("digest", T.BinaryType())

    def run(batches):
        for batch in sliced(batches):
            made = [_digested(t, width, seeds, digest) for (t,) in rows_of([batch], "t")]
            fps = np.stack([x for x, _ in made]).view(np.int64)
            more = [pa.array([d for _, d in made], pa.binary())] if digest else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(fps[:, k].copy()) for k in range(seeds)), *more], schema.names)

    return docs.select(F.col(id_col), as_bytes(text_col).alias("t")).mapInArrow(run, schema)


# The walk in one unit of work.


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of linked rows; labels point at roots before and after."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def _leaves(keys: np.ndarray, budget: int, labels: np.ndarray, pairs: np.ndarray) -> None:
    """Compare the fingerprints below each pair of nodes (lo, hi, lo, hi)."""
    sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
    large = sizes > 256
    for a, b, c, d in pairs[large].tolist():
        i, j = np.nonzero(np.bitwise_count(keys[a:b, None] ^ keys[None, c:d]) <= budget)
        i, j = i + a, j + c
        _merge(labels, i[i < j], j[i < j])
    pairs, sizes = pairs[~large], sizes[~large]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(pairs):
        base = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, base + LEAF_PAIRS, "right")))
        some, n = pairs[at:to], sizes[at:to]
        which = np.repeat(np.arange(len(some)), n)
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = (some[:, 3] - some[:, 2])[which]
        i, j = some[which, 0] + offset // width, some[which, 2] + offset % width
        linked = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
        _merge(labels, i[linked], j[linked])
        at = to


def trie_forest(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, budget: int, leaf: int = 4096) -> np.ndarray:
    """For sorted ``keys``, the index of each one's component root.

    ``starts`` and ``ends`` bound subtries whose keys agree on the first
    ``depth`` bits; only keys of one subtrie are joined.
    """
    labels = np.arange(len(keys))
    pairs = np.stack([starts, ends, starts, ends], 1).astype(np.int64)
    spent = np.zeros(len(pairs), np.int64)
    while len(pairs):
        small = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= leaf
        if depth == 64:
            small[:] = True
        _leaves(keys, budget, labels, pairs[small])
        pairs, spent = pairs[~small], spent[~small]
        if not len(pairs):
            break
        nodes, inverse = np.unique(np.concatenate([pairs[:, :2], pairs[:, 2:]]), axis=0, return_inverse=True)
        inverse = inverse.reshape(-1)
        bit = np.uint64(1) << np.uint64(63 - depth)
        ones = np.concatenate([[0], np.cumsum((keys & bit) != 0)])
        middle = (nodes[:, 1] - (ones[nodes[:, 1]] - ones[nodes[:, 0]]))[inverse]
        left, right = middle[: len(pairs)], middle[len(pairs) :]
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        lo_a, hi_a, lo_b, hi_b = pairs.T
        children = [
            (np.stack([lo_a, left, lo_b, right], 1), spent, slice(None)),
            (np.stack([left, hi_a, right, hi_b], 1), spent, slice(None)),
            (np.stack([lo_a, left, right, hi_b], 1), spent + 1, slice(None)),
            (np.stack([left, hi_a, lo_b, right], 1), spent + 1, ~same),  # of a node with itself, the mirror image
        ]
        pairs = np.concatenate([c[k] for c, _, k in children])
        spent = np.concatenate([s[k] for _, s, k in children])
        alive = (spent <= budget) & (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])
        pairs, spent, depth = pairs[alive], spent[alive], depth + 1
    return labels


def _bounds(blocks: int) -> list[tuple[int, int]]:
    """(first bit from the left, bits) of each block."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _permuted(x: np.ndarray, order: list[tuple[int, int]], back: bool = False) -> np.ndarray:
    """Lay the blocks of each fingerprint side by side in another order, or undo that."""
    out, at = np.zeros_like(x), 0
    for first, bits in order:
        mask = np.uint64((1 << bits) - 1)
        here, there = np.uint64(64 - first - bits), np.uint64(64 - at - bits)
        if back:
            here, there = there, here
        out |= ((x >> here) & mask) << there
        at += bits
    return out


def _units(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[tuple[np.ndarray, ...]]:
    """(combo, unit, fp, node) in runs of whole units; rows come sorted by combo and unit."""
    held: list[tuple[np.ndarray, ...]] = []

    def joined():
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    for batch in batches:
        held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)))
        if sum(len(h[0]) for h in held) >= rows:
            columns = joined()
            combo, unit = columns[:2]
            change = np.flatnonzero((combo[1:] != combo[:-1]) | (unit[1:] != unit[:-1]))
            if len(change):
                end = change[-1] + 1
                yield tuple(c[:end] for c in columns)
                held = [tuple(c[end:] for c in columns)]
            else:
                held = [columns]
    if held:
        yield joined()


def _to_firsts(labels: np.ndarray, own: np.ndarray, firsts: int) -> Iterator[pa.RecordBatch]:
    """Edges from the nodes of each component to its ``firsts`` least ones, and loops at nodes that have more before them."""
    order = np.lexsort((own, labels))
    own, labels = own[order], labels[order]
    start = np.maximum.accumulate(np.where(np.concatenate([[True], labels[1:] != labels[:-1]]), np.arange(len(own)), 0))
    rank = np.arange(len(own)) - start
    for k in range(min(firsts, int(rank.max()))):
        later = rank > k
        yield pa.RecordBatch.from_arrays([pa.array(own[later]), pa.array(own[start[later] + k])], ["u", "v"])
    more = own[rank > firsts]
    if len(more):
        yield pa.RecordBatch.from_arrays([pa.array(more), pa.array(more)], ["u", "v"])


def near_links(fps: DataFrame, budget: int = 4, blocks: int | None = None, unit: int = UNIT, columns: tuple[str, ...] = ("fp",), node: str = "fp", firsts: int = 0) -> DataFrame:
    """Edges ``(u, v)`` among the longs in ``node`` that span all links of ``budget`` bits or fewer.

    Rows are linked if they are that near in one of ``columns``. Exact at
    every size: ``blocks`` and ``unit`` only set how the work is dealt out. No
    rows give no edges.

    With ``firsts``, each node has instead an edge to every lesser one among
    the ``firsts`` least of its component in a unit, and a loop ``(u, u)`` if
    lesser ones remain beyond those.
    """
    n = fps.count()
    if blocks is None:
        blocks = budget + 1
        while blocks < budget + 4 and n >> (64 * (blocks - budget) // blocks) > unit:
            blocks += 1
    bounds = _bounds(blocks)
    combos = list(combinations(range(blocks), blocks - budget))
    orders = [[bounds[b] for b in c] + [bounds[b] for b in range(blocks) if b not in c] for c in combos]
    tops = [sum(bounds[b][1] for b in c) for c in combos]

    def key(which: int, c: tuple[int, ...]):
        column = columns[which]
        parts = [F.shiftrightunsigned(column, 64 - a - w).bitwiseAND(F.lit((1 << w) - 1)) for a, w in (bounds[b] for b in c)]
        top = parts[0] if len(parts) == 1 else F.shiftleft(parts[0], 32).bitwiseOR(parts[1]) if len(parts) == 2 else F.xxhash64(*parts)
        return F.struct(F.lit(which * len(combos) + combos.index(c)).alias("combo"), top.alias("top"), F.col(column).alias("fp"))

    keys = F.array(*[key(k, c) for k in range(len(columns)) for c in combos])
    keyed = fps.select(F.col(node).alias("node"), F.explode(keys).alias("k")).select("node", "k.fp", "k.combo", "k.top")
    crowds = keyed.groupBy("combo", "top").agg(F.count("*").alias("size")).where(F.col("size") > unit)
    chunks = F.ceil(F.col("size") / F.lit(unit)).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    if crowds.limit(1).count():
        split = keyed.join(crowds.select("combo", "top", chunks.alias("chunks")), ["combo", "top"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        split = split.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        keyed = split.select("node", "fp", "combo", F.xxhash64("combo", "top", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"))
    else:
        keyed = keyed.select("node", "fp", "combo", F.xxhash64("combo", "top").alias("unit"))

    def run(batches):
        for combo, unit_id, fp, nodes in _units(batches):
            for c in np.unique(combo):
                here = combo == c
                place, top = orders[c % len(combos)], np.uint64(64 - tops[c % len(combos)])
                x = _permuted(fp[here].view(np.uint64), place)
                u, own = unit_id[here], nodes[here]
                order = np.lexsort((own, x, u))
                x, u, own = x[order], u[order], own[order]
                cuts = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (x[1:] >> top != x[:-1] >> top)]))
                labels = trie_forest(x, cuts, np.append(cuts[1:], len(x)), 64 - int(top), budget)
                if firsts:
                    yield from _to_firsts(labels, own, firsts)
                    continue
                # Each points at the least node of its component, so that units that find the same component give the same edges.
                least = np.full(len(x), np.iinfo(np.int64).max)
                np.minimum.at(least, labels, own)
                root = least[labels]
                moved = np.flatnonzero(root != own)
                if len(moved):
                    yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(root[moved])], ["u", "v"])

    dealt = keyed.select("combo", "unit", "fp", "node").repartition("combo", "unit").sortWithinPartitions("combo", "unit")
    return dealt.mapInArrow(run, "u long, v long")


def simhash_groups(docs: DataFrame, width: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component_id)`` of every row of ``docs``.

    Fingerprints of ``width``-word shingles are linked at ``budget`` or fewer
    differing bits; ``component_id`` is the smallest id reachable over links,
    the row's own included. Null and empty texts have fingerprint zero and are
    linked like others; a null id takes part without naming a component, and a
    component of null ids alone has a null id. Repeated rows come back repeated;
    other columns play no part; an empty table gives no rows.
    """
    fps = cut(fingerprints(docs, width, id_col, text_col))
    least = cut(fps.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    member = connected_components(near_links(least.select("fp"), budget))
    rooted = least.join(member, least["fp"] == member["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    # Cut, so that the join back on a crowd's root is dealt out anew and can be split.
    named = cut(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    of_fp = rooted.join(named, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(id_col, "fp", "component_id")


def _shingle_sets(docs: DataFrame, groups: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``(root, id, set)`` for the rows of ``groups(root, id)``: the sorted distinct hashes of a text's shingles, as bytes."""

    def run(batches):
        for batch in sliced(batches):
            sets = [np.unique(np.concatenate([h.astype(np.uint64) for h in shingle_hashes(t, width)] or [np.zeros(0, np.uint64)])).tobytes() for (t,) in rows_of([batch], "t")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["root", "id", "set"])

    wanted = docs.select(F.col(id_col).cast("long").alias("id"), as_bytes(text_col).alias("t")).join(groups, "id")
    return wanted.select("root", "id", "t").mapInArrow(run, SETS)


def _alike(some: list[bytes], others: list[bytes], similarity: float) -> np.ndarray:
    """Which of ``some`` sets have a Jaccard similarity of at least ``similarity`` with which of ``others``."""
    x, y = ([np.frombuffer(s, np.uint64) for s in sets] for sets in (some, others))
    n, m = (np.array([len(s) for s in sets], np.int64) for sets in (x, y))
    both = np.zeros((len(x), len(y)), np.int64)
    slices = 1 + int(m.sum()) // POSTINGS
    edges = [k * ((1 << 64) // slices) for k in range(1, slices)]
    for low, high in zip([0, *edges], [*edges, None], strict=True):
        part = lambda s: s[np.searchsorted(s, np.uint64(low)) : None if high is None else np.searchsorted(s, np.uint64(high))]  # noqa: B023, E731
        held = [part(s) for s in y]
        of = np.repeat(np.arange(len(y)), [len(s) for s in held])
        postings = np.concatenate(held or [np.zeros(0, np.uint64)])
        order = np.argsort(postings, kind="stable")
        postings, of = postings[order], of[order]
        for i, s in enumerate(map(part, x)):
            begin = np.searchsorted(postings, s)
            sizes = np.searchsorted(postings, s, "right") - begin
            at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            both[i] += np.bincount(of[at], minlength=len(y))
    return both >= similarity * (n[:, None] + m[None, :] - both)


def _settled(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """``(root, id, set, stays)`` of whole groups sorted by id: a row stays unless it is like one before it that stays."""

    def rows():
        for root, group in groupby(rows_of(sliced(batches), "root", "id", "set"), lambda r: r[0]):
            ids, sets = zip(*((i, s) for _, i, s in group), strict=True)
            alike, stays = _alike(sets, sets, similarity), np.zeros(len(ids), bool)
            for k in range(len(ids)):
                stays[k] = not (alike[k, :k] & stays[:k]).any()
            yield from zip([root] * len(ids), ids, sets, stays.tolist(), strict=True)

    made = rows()
    while some := list(islice(made, 512)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), [pa.int64(), pa.int64(), pa.binary(), pa.bool_()], strict=True)], ["root", "id", "set", "stays"])


def _unlike(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """``(root, id, set)`` of the rows that are like none of the firsts at the head of their chunk."""
    for (root, _), chunk in groupby(rows_of(sliced(batches), "root", "chunk", "first", "id", "set"), lambda r: r[:2]):
        firsts: list[bytes] = []
        for first, rows in groupby(chunk, lambda r: r[2]):
            if first:
                firsts = [r[4] for r in rows]
                continue
            while some := list(islice(rows, 256)):
                stays = ~_alike([r[4] for r in some], firsts, similarity).any(axis=1)
                left = [r for r, ok in zip(some, stays.tolist(), strict=True) if ok]
                yield pa.RecordBatch.from_arrays([pa.array([root] * len(left), pa.int64()), pa.array([r[3] for r in left], pa.int64()), pa.array([r[4] for r in left], pa.binary())], ["root", "id", "set"])


def first_of_alike(members: DataFrame, similarity: float, group: int | None = None) -> DataFrame:
    """``(id)`` of the ``members(root, id, set)`` that stay: those unlike every one of their root with a smaller id that stays.

    The first ``group`` of each root settle among themselves in one task; what
    is left of a larger root is dealt out in chunks as large, each compared
    with those firsts that stay, and what is unlike them goes on to the next
    round. So a round sends each set at most twice, and no pairs; ``group`` only sets
    how the work is dealt out.
    """
    group = group or GROUP
    stay = []
    while True:
        nth = F.row_number().over(Window.partitionBy("root").orderBy("id"))
        firsts = members.withColumn("nth", nth).where(F.col("nth") <= group).select("root", "id", "set").sortWithinPartitions("root", "id")
        done = cut(firsts.mapInArrow(lambda b: _settled(b, similarity), f"{SETS}, stays boolean"))
        stay.append(done.where("stays").select("id"))
        full = done.groupBy("root").agg(F.max("id").alias("last"), F.count("*").alias("n")).where(F.col("n") >= group).select("root", "last")
        chunks = members.join(F.broadcast(full), "root").where(F.col("id") > F.col("last")).groupBy("root").agg(F.first("last").alias("last"), F.ceil(F.count("*") / F.lit(group)).cast("int").alias("chunks"))
        large = cut(chunks)
        if not large.limit(1).count():
            return reduce(DataFrame.union, stay)
        # One row for each ``group`` members at most, so these are few.
        of_chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
        rest = members.join(F.broadcast(large), "root").where(F.col("id") > F.col("last")).select("root", of_chunk.alias("chunk"), F.lit(False).alias("first"), "id", "set")
        every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        heads = done.where("stays").join(F.broadcast(large), "root").select("root", every.alias("chunk"), F.lit(True).alias("first"), "id", "set")
        dealt = rest.unionByName(heads).repartition("root", "chunk").sortWithinPartitions("root", "chunk", F.desc("first"), "id")
        members = cut(dealt.mapInArrow(lambda b: _unlike(b, similarity), SETS))


def one_of_each_group(docs: DataFrame, width: int = 5, budget: int = 6, seeds: int = 8, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies of others that stay.

    Candidates are linked by the trie self-join in any of ``seeds``
    fingerprints: one alone misses most pairs near the limit of similarity.
    Within each group of documents that links connect, all are compared by
    their sets of shingles, exactly, whether linked directly or not: in the
    order of ids, a document stays unless its shingles overlap by
    ``similarity`` with those of one that stays. Documents with the
    same set of shingles are copies: the smallest id stays. Equal fingerprints
    alone only make candidates, for a shingle that is more than half of a text
    decides all of its fingerprints.

    Of several rows with an id that stays, the one with the smallest text
    stays. Rows without an id stay; ids are taken as longs. An empty table
    gives no rows.
    """
    names = ["fp", *(f"fp{k}" for k in range(1, seeds))]
    named = docs.where(F.col(id_col).isNotNull())
    hashed = lambda rows: cut(fingerprints(rows, width, id_col, text_col, seeds, digest=True).withColumn("id", F.col(id_col).cast("long")))
    fps = hashed(named)
    if fps.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").limit(1).count():
        # Only one row of an id can stay, so only that one is compared.
        nth = "_" * (1 + max(map(len, docs.columns)))
        first = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first())
        named = named.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth)
        fps = hashed(named)
    nodes = cut(fps.groupBy("digest").agg(F.min(F.struct("id", *names)).alias("m")).select("m.*"))
    groups = cut(connected_components(near_links(nodes, budget, columns=tuple(names), node="id")).select("root", F.col("node").alias("id")))
    chosen = nodes.select("id")
    if groups.limit(1).count():
        members = cut(_shingle_sets(named, groups, width, id_col, text_col))
        chosen = cut(chosen.join(groups, "id", "left_anti").union(first_of_alike(members, similarity)))
    kept = named.join(chosen.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col)), id_col, "left_semi")
    return kept.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def hex64(column: str) -> F.Column:
    """A long's 64 bits as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
