"""SimHash near-dedup with a hierarchical index over Gray-ordered fingerprints.

1. Every whole text gets a 64-bit fingerprint over its word shingles.
2. Distinct fingerprints go to ``TABLES``: with 64 bits cut into
   ``max_distance + 2`` blocks, two fingerprints within the distance agree on
   two blocks, so they share the key of one of the block pairs.  This only
   routes work to tasks; it drops no pair.
3. Inside a key the fingerprints are sorted by Gray rank, so neighbours share
   long bit patterns.  Runs of them are factored bottom-up into nodes holding
   the bits all members agree on.  A search goes top-down: each node adds the
   differences in the bits it newly fixes, and a whole group is pruned once
   they exceed the distance, accepted once its free bits cannot exceed it, and
   skipped if it is already in the searcher's component.
4. Each task returns a star per local component instead of all pairs;
   alternating large-star/small-star steps join them into global components.

Scale: texts are read once and only (doc_id, fingerprint) is kept; copies
collapse to one fingerprint before the index; a key with more than
``BLOCK_ROWS`` fingerprints is cut into salted blocks, each pair of blocks
being one bounded unit of work.

Defined results: null, empty and word-less texts have fingerprint zero and
are linked like any other; repeated rows share a fingerprint, hence a
component; ``component_id`` is the smallest non-null doc_id reachable, null if
there is none; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import LOWER, SPACED_WORD, map_texts, word_spans
from captally.operators.materialize import cut

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
HASH_SEED = 42
#: Shingles hashed and tallied at a time: bounds memory on very long texts.
SHINGLE_BLOCK = 1 << 16
#: Fingerprints of one key handled as one unit of work; more are cut into blocks.
BLOCK_ROWS = 40_000
FANOUT = 8
#: (searcher, node) pairs looked at together.
FRONTIER = 1 << 18


def shingle_spans(data, offsets, size):
    """(buffer of single-spaced lower-case words, starts, ends, row of each shingle)."""
    starts, ends, firsts = word_spans(data, offsets, SPACED_WORD)
    inside = SPACED_WORD[data]
    keep = inside.copy()
    after = ends[ends < len(data)]
    keep[after] |= ~inside[after]
    buffer = np.where(inside, LOWER[data], np.uint8(0x20))[keep].tobytes()
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    begin = place[starts]
    end = begin + (ends - starts)
    words = np.diff(firsts)
    n_shingles = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    row = np.repeat(np.arange(len(words)), n_shingles)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    head = firsts[:-1][row] + nth
    tail = np.minimum(head + size, firsts[1:][row]) - 1
    return buffer, begin[head], end[tail], row


def _fingerprinter(size: int = SHINGLE_WORDS):
    from xxhash import xxh64_intdigest

    def fingerprints(data, offsets):
        n = len(offsets) - 1
        buffer, begin, end, row = shingle_spans(data, offsets, size)
        ones, total = np.zeros((n, 64), np.int64), np.bincount(row, minlength=n)
        for lo in range(0, len(row), SHINGLE_BLOCK):
            part = slice(lo, lo + SHINGLE_BLOCK)
            spans = zip(begin[part].tolist(), end[part].tolist(), strict=True)
            h = np.fromiter((xxh64_intdigest(buffer[a:b], HASH_SEED) for a, b in spans), np.uint64, len(row[part]))
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            heads = np.flatnonzero(np.diff(row[part], prepend=-1))
            ones[row[part][heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
        return [np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.int64).ravel()]

    return fingerprints


def with_fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    return map_texts(docs, text, keep, [T.StructField("fp", T.LongType(), False)], _fingerprinter)


def key_masks(max_distance: int = MAX_DISTANCE) -> list[int]:
    """64-bit masks of every pair of the ``max_distance + 2`` blocks."""
    n = max_distance + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(c: Column) -> Column:
    """Rank of a 64-bit code in the reflected Gray sequence (order of unsigned values)."""
    for shift in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, shift))
    return c.bitwiseXOR(F.lit(-(1 << 63)))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class GrayIndex:
    """Hierarchical index over groups of codes; each group is sorted by Gray rank."""

    def __init__(self, codes: np.ndarray, group_starts: np.ndarray, fanout: int = FANOUT) -> None:
        n = len(codes)
        self.codes = codes
        sizes = np.diff(np.append(group_starts, n))
        self.group = np.repeat(np.arange(len(sizes)), sizes)
        # Per level, from leaves up: common ones, common bits, first leaf and first child of each node.
        both, any_, first = codes.copy(), codes.copy(), np.arange(n)
        heads = group_starts
        self.levels = [(codes, np.full(n, ~np.uint64(0)), first, None)]
        while len(both) > len(sizes):
            local = np.arange(len(both)) - np.repeat(heads, sizes)
            child = np.flatnonzero(local % fanout == 0)
            both, any_, first = np.bitwise_and.reduceat(both, child), np.bitwise_or.reduceat(any_, child), first[child]
            sizes = -(-sizes // fanout)
            heads = np.cumsum(sizes) - sizes
            self.levels.append((both, both | ~any_, first, child))
        self.label = np.arange(n)

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while (label != label[label]).any():
                label[:] = label[label]

    def components(self, max_distance: int) -> np.ndarray:
        """Per code the smallest index of its component of codes within ``max_distance``."""
        n, top = len(self.codes), len(self.levels) - 1
        ends = [np.append(first[1:], n) for _, _, first, _ in self.levels]
        for (_, common, first, child), end in list(zip(self.levels, ends, strict=True))[1:]:
            tight = np.flatnonzero((_popcount(~common) <= max_distance) & (end - first > 1))
            if len(tight):  # every member is within the distance of every other
                size = (end - first)[tight]
                member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[tight], size)
                self._join(member, np.repeat(first[tight], size))
        lo, step = 0, 64
        while lo < n:
            self._search(np.arange(lo, min(lo + step, n)), top, ends, max_distance)
            lo, step = lo + step, min(step * 2, 1 << 14)
        return self.label

    def _search(self, q: np.ndarray, top: int, ends: list, max_distance: int) -> None:
        self._visit(top, q, self.group[q], np.zeros(len(q), np.int64), np.zeros(len(q), np.uint64), ends, max_distance)

    def _visit(self, level: int, q, node, acc, seen, ends: list, max_distance: int) -> None:
        """Searchers ``q`` at nodes of ``level``; ``acc``: differences in the bits ``seen`` so far."""
        for lo in range(0, len(q), FRONTIER):
            part = slice(lo, lo + FRONTIER)
            self._visit_part(level, q[part], node[part], acc[part], seen[part], ends, max_distance)

    def _visit_part(self, level: int, q, node, acc, seen, ends: list, max_distance: int) -> None:
        ones, common, first, child = self.levels[level]
        low, high = np.minimum.reduceat(self.label, first), np.maximum.reduceat(self.label, first)
        mine = self.label[q]
        go = (ends[level][node] > q + 1) & ~((low[node] == mine) & (high[node] == mine))
        q, acc, seen, node = q[go], acc[go], seen[go], node[go]
        acc = acc + _popcount((self.codes[q] ^ ones[node]) & common[node] & ~seen)
        seen = common[node]
        whole = acc + _popcount(~seen) <= max_distance
        if whole.any():  # then all members are near each other as well, and one component
            self._join(q[whole], first[node[whole]])
        go = (acc <= max_distance) & ~whole
        q, acc, seen, node = q[go], acc[go], seen[go], node[go]
        if level == 0 or not len(q):
            return
        size = np.diff(np.append(child, len(self.levels[level - 1][2])))[node]
        at = np.repeat(child[node], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        q, acc, seen = np.repeat(q, size), np.repeat(acc, size), np.repeat(seen, size)
        self._visit(level - 1, q, at, acc, seen, ends, max_distance)


def _local_stars(max_distance: int):
    """Arrow batches of sorted (unit, fp) rows to (fp, nearest representative) edges."""

    def work(unit: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        sizes = np.diff(np.append(starts, len(unit)))
        several = np.repeat(sizes > 1, sizes)
        codes, sizes = codes[several], sizes[sizes > 1]
        if not len(codes):
            label = np.zeros(0, np.int64)
        else:
            label = GrayIndex(codes, np.cumsum(sizes) - sizes).components(max_distance)
        linked = np.flatnonzero(label != np.arange(len(codes)))
        return pa.RecordBatch.from_arrays(
            [pa.array(codes[linked].view(np.int64)), pa.array(codes[label[linked]].view(np.int64))], names=["u", "v"]
        )

    def run(batches):
        units, codes, held = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            units.append(np.asarray(b.column(0)))
            codes.append(np.asarray(b.column(1)).view(np.uint64))
            held += b.num_rows
            if held >= 2 * BLOCK_ROWS:
                unit, code = np.concatenate(units), np.concatenate(codes)
                last = int(np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))[-1])
                if last:
                    yield work(unit[:last], code[:last])
                units, codes, held = [unit[last:]], [code[last:]], len(unit) - last
        if held:
            yield work(np.concatenate(units), np.concatenate(codes))

    return run


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(u, v): stars whose components are those of "within ``max_distance`` bits".

    ``fps`` has one row per distinct fingerprint (column ``fp``) and should be
    a written table.
    """
    masks = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("m")) for t, m in enumerate(key_masks(max_distance))))
    routed = fps.select("fp", F.explode(masks).alias("x")).select("fp", "x.t", F.col("fp").bitwiseAND(F.col("x.m")).alias("key"))
    hot = routed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
    hot = hot.select("t", "key", F.ceil(F.col("n") / block_rows).cast("int").alias("s"))
    parts = F.coalesce(F.col("s"), F.lit(1))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    units = (
        routed.join(hot, ["t", "key"], "left")
        .select("fp", "t", "key", own.alias("own"), other.alias("other"))
        .select(F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "fp")
    )
    placed = units.repartition("unit").sortWithinPartitions("unit", gray_rank(F.col("fp")))
    return placed.mapInArrow(_local_stars(max_distance), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component of every node with an edge.

    Alternating large-star and small-star steps; each is a group minimum and a
    join, and stops when a round changes nothing.
    """

    def star(e: DataFrame, both: bool) -> DataFrame:
        """Ties neighbours to the smallest one: all larger ones (large star) or all smaller ones (small star)."""
        hi, lo = F.greatest("u", "v"), F.least("u", "v")
        pairs = e.select(hi.alias("a"), lo.alias("b"))
        if both:
            pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = pairs.join(least, "a")
        if both:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("b").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("a").alias("u"), F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        return tuple(row)

    edges = cut(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "simhash-edges")
    before = mark(edges)
    while before[0]:
        edges = cut(star(star(edges, True), False), "simhash-edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_components(marked: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``marked`` (doc_id, fp; a written table)."""
    fps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(links(fps, max_distance))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    rooted = cut(rooted, "simhash-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    marked = cut(with_fingerprints(docs.select("doc_id", "text"), ["doc_id"]), "simhash-docs")
    ids = fingerprint_components(marked, max_distance)
    return marked.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` per component: the one with the smallest doc_id (ties: smallest text).

    Columns stay as they are.
    """
    packed = docs.select(F.struct("*").alias("whole"), "doc_id", "text")
    marked = cut(with_fingerprints(packed, ["whole", "doc_id"]), "simhash-docs")
    ids = fingerprint_components(marked.select("doc_id", "fp"), max_distance)
    first = marked.join(ids, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows with the smallest id of a component: one, but for repeated or null ids; combined map-side.
    order = F.struct("whole.text", F.sha2(F.to_json("whole"), 256).alias("rest"))
    return first.groupBy("root").agg(F.min_by("whole", order).alias("whole")).select("whole.*")
