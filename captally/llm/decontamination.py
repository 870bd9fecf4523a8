"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become hashed tokens (lower-case runs of letters
and digits).  Three fixed masks of weight six, ``111111``, ``111000111`` and
``111000000111``, ignore the positions marked 0: cut any 12 tokens into four
threes, and two substitutions leave two threes whole, so one mask still hits.
Test and training hashes are joined, and every hit is verified: along its
diagonal some window of ``min_matches`` + 2 tokens must have ``min_matches``
equal ones, or four fifths of a shorter item.  What is reported is the best
segment (+1 a match, -4 a substitution) if it reaches as many matches, else
the longest run of such windows.

Every overlap that has 12 aligned tokens with at most two substitutions is
found.  Items too short for the masks, of ``least_tokens`` (four) to five
tokens, are found where they stand whole: their only seed is the hash of all
their tokens, looked up at every document window of that length.

Texts are read once: a Bloom filter of the benchmark's hashes (16 bits a hash,
2**24 bits at least and 2**26 at most) lets only likely hits out of the scan,
with ``CONTEXT`` tokens around them.  The exact join behind it decides, so a
full filter costs time and no result.  Equal items are one class up to the
last join, and ``drop_contaminated`` never names the single items.

Defined results: null and empty texts and items never match; items with fewer
than ``least_tokens`` tokens never match (single words and pairs stand in
clean texts too; the parameter may be 1); repeated rows of documents or items
are reported once per (doc_id, text) and (item_id, text); of equally good
overlaps the first counts; empty tables give an empty result.  Other columns
of both tables, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import ALNUM_WORD, LOWER, TextHasher, map_texts, odd_weights, row_of, window_hashes, word_spans
from captally.operators.materialize import cut

MASKS = ("111111", "111000111", "111000000111")
MIN_MATCHES = 10
MISMATCH_COST = 4
SUBSTITUTIONS = 2
CONTEXT = 48
BLOOM_BITS = (24, 26)
PROBES = (0, 19, 38)
LEAST_TOKENS = 4
#: Tokens that every mask needs; shorter items are looked up whole.
MASK_WEIGHT = 6


def _mask_weights() -> list[list[int]]:
    flat = iter(odd_weights(sum(m.count("1") for m in MASKS), seed=11))
    return [[next(flat) if c == "1" else 0 for c in m] for m in MASKS]


def _whole_weights(n_tokens: int) -> list[int]:
    return odd_weights(n_tokens, seed=100 + n_tokens)


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))


def _tokeniser():
    hasher = TextHasher()

    def tokens(data, offsets):
        low = LOWER[data]
        starts, ends, firsts = word_spans(low, offsets, ALNUM_WORD)
        return hasher.load(low).spans(starts, ends), firsts

    return tokens


def _item_tokens():
    tokens = _tokeniser()

    def items(data, offsets):
        toks, firsts = tokens(data, offsets)
        return [_lists(toks.view(np.int64), np.diff(firsts), pa.int64())]

    return items


def _seeds(toks: np.ndarray, row: np.ndarray, weights: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of a mask's windows that stay inside one row."""
    h = window_hashes(toks, weights)
    at = np.flatnonzero(row[: len(h)] == row[len(weights) - 1 :]) if len(h) else np.zeros(0, np.int64)
    return at, h[at]


def _item_seeds(least_tokens: int):
    def make():
        tokens, masks = _tokeniser(), _mask_weights()

        def seeds(data, offsets):
            toks, firsts = tokens(data, offsets)
            row = row_of(firsts, len(toks))
            found = [_seeds(toks, row, w) for w in masks]
            size = np.diff(firsts)
            for n in range(least_tokens, MASK_WEIGHT):
                at, h = _seeds(toks, row, _whole_weights(n))
                whole = size[row[at]] == n
                found.append((at[whole], h[whole]))
            at = np.concatenate([a for a, _ in found])
            h = np.concatenate([x for _, x in found])
            return row[at], [h.view(np.int64), (at - firsts[row[at]]).astype(np.int32), size[row[at]].astype(np.int32)]

        return seeds

    return make


SEGMENT_FIELDS = [
    T.StructField("seg", T.LongType(), False),
    T.StructField("toks", T.ArrayType(T.LongType()), False),
    T.StructField("hits", T.ArrayType(T.LongType()), False),
    T.StructField("places", T.ArrayType(T.LongType()), False),
]


def _segments(bloom_words: np.ndarray, short: list[int]):
    """Runs of tokens around likely hits: (first token, tokens, hashes, their places in the run).

    ``short`` are the lengths of the items that are looked up whole.
    """

    def make():
        tokens, masks = _tokeniser(), _mask_weights() + [_whole_weights(n) for n in short]
        bloom = np.unpackbits(bloom_words.view(np.uint8), bitorder="little").view(bool)
        low = np.uint64(len(bloom) - 1)

        def segments(data, offsets):
            toks, firsts = tokens(data, offsets)
            row = row_of(firsts, len(toks))
            places, hashes = [], []
            for w in masks:
                at, h = _seeds(toks, row, w)
                for shift in PROBES:
                    hit = bloom[(h >> np.uint64(shift)) & low]
                    at, h = at[hit], h[hit]
                places.append(at)
                hashes.append(h)
            at, h = np.concatenate(places), np.concatenate(hashes)
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            new = np.ones(len(at), bool)
            new[1:] = (row[at[1:]] != row[at[:-1]]) | (np.diff(at) > 2 * CONTEXT)
            head = np.flatnonzero(new)
            tail = np.append(head, len(at))[1:] - 1
            rows = row[at[head]]
            lo = np.maximum(at[head] - CONTEXT, firsts[:-1][rows])
            hi = np.minimum(at[tail] + len(MASKS[-1]) + CONTEXT, firsts[1:][rows])
            size = hi - lo
            inside = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            n_hits = tail - head + 1
            return rows, [
                (lo - firsts[:-1][rows]).astype(np.int64),
                _lists(toks[inside].view(np.int64), size, pa.int64()),
                _lists(h.view(np.int64), n_hits, pa.int64()),
                _lists(at - np.repeat(lo, n_hits), n_hits, pa.int64()),
            ]

        return segments

    return make


def bloom_filter(seeds: DataFrame, n: int) -> np.ndarray:
    """Bits over the ``n`` hashes ``h``, as 64-bit words; at most 2**20 of them reach the driver."""
    size = min(max(n * 16 - 1, 1).bit_length(), BLOOM_BITS[1])
    size = max(size, BLOOM_BITS[0])
    probe = F.explode(F.array(*(F.shiftrightunsigned("h", s).bitwiseAND(F.lit((1 << size) - 1)) for s in PROBES)))
    bits = seeds.select(probe.alias("p")).select(
        F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit")
    )
    words = np.zeros(1 << (size - 6), np.int64)
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words[found["word"].to_numpy()] = found["bit"].to_numpy()
    return words


def best_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, cost: int = MISMATCH_COST) -> tuple[int, int, int]:
    """(matches, length, start in ``doc``) of the best-scoring segment on a diagonal."""
    lo, hi = max(0, diagonal), min(len(doc), diagonal + len(item))
    same = doc[lo:hi] == item[lo - diagonal : hi - diagonal]
    total = np.concatenate(([0], np.cumsum(np.where(same, 1, -cost))))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[: end + 1] == low[end])[-1])
    return int(same[start:end].sum()), end - start, lo + start


def verified_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, min_matches: int = MIN_MATCHES) -> tuple[int, int, int] | None:
    """(matches, length, start in ``doc``) of the overlap on a diagonal, if there is one."""
    need = min(min_matches, -(-4 * len(item) // 5))
    found = best_overlap(doc, item, diagonal)
    if found[0] >= need:
        return found
    lo, hi = max(0, diagonal), min(len(doc), diagonal + len(item))
    same = doc[lo:hi] == item[lo - diagonal : hi - diagonal]
    width = max(1, min(min_matches + SUBSTITUTIONS, hi - lo))
    equal = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(equal[width:] - equal[:-width] >= need)
    if not len(good):
        return None
    runs = np.split(good, np.flatnonzero(np.diff(good) > width) + 1)
    at = max((r[0] + np.flatnonzero(same[r[0] : r[-1] + width]) for r in runs), key=len)
    return len(at), int(at[-1] - at[0]) + 1, lo + int(at[0])


def _verify(min_matches: int):
    def run(batches):
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            docs, items, diagonals = cols["toks"], cols["item_toks"], cols["diagonal"].to_pylist()
            rows, matches, length, start = [], [], [], []
            for i, d in enumerate(diagonals):
                item = items[i].values.to_numpy()
                found = verified_overlap(docs[i].values.to_numpy(), item, d, min_matches)
                if found:
                    rows.append(i)
                    matches.append(found[0])
                    length.append(found[1])
                    start.append(found[2])
            keep = [cols[c].take(pa.array(rows, pa.int64())) for c in ("doc_id", "tid", "iid", "seg")]
            made = [pa.array(x, pa.int64()) for x in (matches, length, start)]
            names = ["doc_id", "tid", "iid", "seg", "n_matches", "n_overlap", "start"]
            yield pa.RecordBatch.from_arrays([*keep, *made], names=names)

    return run


def _same(a: str, b: str, *cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def _class_overlaps(docs: DataFrame, texts: DataFrame, min_matches: int, least_tokens: int) -> DataFrame:
    """(doc_id, tid, iid, n_matches, n_overlap, first_word): best overlap per document and item text (iid, text)."""
    fields = [T.StructField("h", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("size", T.IntegerType())]
    seeds = cut(map_texts(texts, "text", ["iid"], fields, _item_seeds(least_tokens)), "bench-seeds")
    item_toks = map_texts(texts, "text", ["iid"], [T.StructField("item_toks", T.ArrayType(T.LongType()))], _item_tokens)
    short = sorted(r[0] for r in seeds.where(F.col("size") < MASK_WEIGHT).select("size").distinct().collect())  # at most five

    rows = docs.select("doc_id", "text").withColumn("tid", F.xxhash64("text"))
    segs = map_texts(rows, "text", ["doc_id", "tid"], SEGMENT_FIELDS, _segments(bloom_filter(seeds, seeds.count()), short))
    segs = cut(segs, "bench-segments")

    hits = segs.select("doc_id", "tid", "seg", F.explode(F.arrays_zip("hits", "places")).alias("x"))
    hits = hits.select("doc_id", "tid", "seg", F.col("x.hits").alias("h"), F.col("x.places").alias("place"))
    aligned = hits.join(seeds, "h").select("doc_id", "tid", "seg", "iid", (F.col("place") - F.col("pos")).alias("diagonal"))
    aligned = cut(aligned.distinct(), "bench-aligned")
    runs = segs.select("doc_id", "tid", "seg", "toks").dropDuplicates(["doc_id", "tid", "seg"])
    pairs = (
        aligned.alias("a")
        .join(runs.alias("s"), _same("a", "s", "doc_id", "tid", "seg"))
        .join(item_toks.alias("i"), F.col("a.iid") == F.col("i.iid"))
        .select("a.doc_id", "a.tid", "a.seg", "a.iid", "a.diagonal", "s.toks", "i.item_toks")
    )
    id_types = {f.name: f.dataType.simpleString() for f in aligned.schema.fields}
    schema = ", ".join(f"{c} {id_types[c]}" for c in ("doc_id", "tid", "iid", "seg")) + ", n_matches long, n_overlap long, start long"
    verified = pairs.mapInArrow(_verify(min_matches), schema)
    best = F.max(F.struct("n_matches", (-F.col("n_overlap")).alias("shorter"), (-F.col("seg") - F.col("start")).alias("earlier"))).alias("b")
    return (
        verified.groupBy("doc_id", "tid", "iid")
        .agg(best)
        .select("doc_id", "tid", "iid", "b.n_matches", (-F.col("b.shorter")).alias("n_overlap"), (-F.col("b.earlier")).alias("first_word"))
    )


def _item_texts(items: DataFrame) -> DataFrame:
    return cut(items.select(F.xxhash64("text").alias("iid"), "text").dropDuplicates(["iid"]), "bench-texts")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_matches: int = MIN_MATCHES, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """(doc_id, tid, item_id, n_matches, n_overlap, first_word): best overlap per document and item.

    ``tid`` is the XXH64 of the text, for telling apart rows with one doc_id;
    ``first_word`` is the overlap's first token in the document.
    """
    items = cut(benchmark.select("item_id", "text").distinct(), "bench-items")
    found = _class_overlaps(docs, _item_texts(items), min_matches, least_tokens)
    members = items.select("item_id", F.xxhash64("text").alias("iid"))
    return found.join(members, "iid").select("doc_id", "tid", "item_id", "n_matches", "n_overlap", "first_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_matches: int = MIN_MATCHES, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """The rows of ``docs`` without a benchmark overlap, with their columns as they were."""
    found = _class_overlaps(docs, _item_texts(benchmark), min_matches, least_tokens)
    found = cut(found.select("doc_id", "tid").distinct(), "bench-found")
    packed = docs.select(F.struct("*").alias("whole"), "doc_id", F.xxhash64("text").alias("tid"))
    return packed.alias("d").join(found.alias("f"), _same("d", "f", "doc_id", "tid"), "left_anti").select("whole.*")
