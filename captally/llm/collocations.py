"""Phrase collocations: Rabin-Karp fingerprints counted by shuffle, phrases read back from the text.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and
those at spaces and tabs into words; a phrase is 2 to ``max_words`` consecutive
words of a piece, counted per language.

* Inside a task the words of a chunk are laid out with one space between them
  and two prefix polynomials over these bytes (modulo 2**64 and modulo the
  prime 2**31 - 1) give the fingerprint of every run of words.  Runs of equal
  fingerprint are combined, by chunk and task, before anything is shuffled,
  with a pointer to their smallest text: 16 bits of its hash.
* Three counting passes (words; pairs of frequent words; longer runs of
  frequent pairs) keep the fingerprints with ``min_count`` occurrences.  What
  a pass may skip comes from a Bloom filter of the pass before, of at most
  ``MAX_FILTER_BITS`` bits: it never loses a frequent phrase, and when it is
  full it only lets more through.
* A last pass turns frequent phrases into text, each only in the texts that its
  pointer names, and the fingerprint is computed anew from that text.  Where two
  texts share one fingerprint, all occurrences are counted again by their
  bytes.  A collision that no pointer shows needs 95 equal bits: the odds that
  one of 10**9 frequent phrases meets one of 10**13 others are 10**-6.

Scores use whole numbers only: decimals of 38 digits hold ``1000*a*n`` and
``l*r`` while a language has fewer than 10**17 words.

Defined results: a null text is empty, a null ``lang`` is ``und``; repeated
rows count as often as they occur; ties in score go to the larger count, then
to the smaller phrase by bytes; a table without rows, or without a frequent
phrase, gives no rows.  Other columns of the input are ignored, whatever their
names.  A text of any length is one chunk of its own (memory: about 60 bytes a
byte of the longest text).  No key is gathered: counts are combined map-side, and
the ranking takes each bucket's best ``top`` rows before a language's.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import LOWER, PrimeHasher, SpanHasher, mix64, text_chunks, word_spans
from captally.operators.materialize import cut

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: A shorter candidate goes if a longer one around it has at least this share (percent) of its count.
COVERED_PERCENT = 100
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 16, 1 << 27
BITS_PER_KEY = 16
PROBES = 3
#: Distinct fingerprints or phrases that a task holds before it passes their counts on.
BUFFER = 1 << 19
#: Bytes of text that a task lays out at a time, and rows that it hands to Spark at a time.
CHUNK_BYTES = 1 << 19
ROWS_OUT = 1 << 16

#: Bytes that end a piece, and those that end a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = PIECE_ENDS + b"\x20\x09"

IN_WORD = np.ones(256, dtype=bool)
IN_WORD[list(WORD_ENDS)] = False
ENDS_PIECE = np.zeros(256, dtype=bool)
ENDS_PIECE[list(PIECE_ENDS)] = True

POINTER_BITS = 16
#: Spreads pointers over the fingerprints they are joined with; small enough that a product fits 63 bits.
PLACE_FACTOR = 0x1E3779B97F4B


def language_seed(lang: str | None) -> int:
    return int.from_bytes(hashlib.blake2b(("und" if lang is None else lang).encode(), digest_size=8).digest(), "little")


class Hashers:
    """The two hashers of a task; their tables of powers grow with the longest chunk."""

    def __init__(self) -> None:
        self.wide, self.prime = SpanHasher(), PrimeHasher()


class Runs:
    """The runs of words of one chunk of texts, and their fingerprints."""

    def __init__(self, hashers: Hashers, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, pointers: np.ndarray) -> None:
        data = LOWER[data]
        starts, ends, firsts = word_spans(data, offsets, IN_WORD)
        size = ends - starts
        # One space after each word: runs of words are spans of these bytes.
        self.lo = np.cumsum(size + 1) - size - 1
        self.hi = self.lo + size
        self.bytes = np.full(int((size + 1).sum()), 0x20, np.uint8)
        inside = np.repeat(self.lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        self.bytes[inside] = data[IN_WORD[data]]
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
        piece = np.cumsum(ENDS_PIECE[data])
        piece = piece[starts] if len(starts) else starts
        # Same text and no piece end in between: the next word goes on with the phrase.
        self.goes_on = (self.row[1:] == self.row[:-1]) & (piece[1:] == piece[:-1])
        self.wide, self.prime = hashers.wide.load(self.bytes), hashers.prime.load(self.bytes)
        self.seed = seeds[self.row]
        self.pointer = pointers[self.row]

    def fingerprints(self, first: np.ndarray, words: int) -> np.ndarray:
        spans = self.wide.spans(self.lo[first], self.hi[first + words - 1])
        return mix64(spans + self.seed[first])

    def counted(self, first: np.ndarray, words: int) -> "Counts":
        """The fingerprints of these runs with their checks, ones and pointers."""
        checks = self.prime.spans(self.lo[first], self.hi[first + words - 1]).astype(np.int64)
        return combined(self.fingerprints(first, words), checks, np.ones(len(first), np.int64), self.pointer[first])

    def all_runs(self, words: int) -> np.ndarray:
        """First words of every run of ``words`` words."""
        n = len(self.lo) - words + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for j in range(words - 1):
            ok &= self.goes_on[j : j + n]
        return np.flatnonzero(ok)


class Counts(NamedTuple):
    """Fingerprints (fp, check) with their occurrences and smallest pointer."""

    fp: np.ndarray
    check: np.ndarray
    c: np.ndarray
    ptr: np.ndarray


def combined(fp: np.ndarray, check: np.ndarray, c: np.ndarray, ptr: np.ndarray) -> Counts:
    """Equal neighbours in the order of ``fp`` made one; the shuffle joins what is left apart."""
    order = np.argsort(fp)
    fp, check, c, ptr = fp[order], check[order], c[order], ptr[order]
    new = np.ones(len(fp), bool)
    new[1:] = (fp[1:] != fp[:-1]) | (check[1:] != check[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return Counts(fp, check, c, ptr)
    return Counts(fp[at], check[at], np.add.reduceat(c, at), np.minimum.reduceat(ptr, at))


class Filter:
    """A Bloom filter held as 64-bit words."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        bits = np.uint64(len(self.words) * 64 - 1)
        for probe in range(PROBES):
            at = (keys >> np.uint64(17 * probe)) & bits
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_of(keys: DataFrame, n: int, key: str = "fp") -> Filter:
    """The filter of a column; at most MAX_FILTER_BITS / 64 rows come to the driver, whatever ``n``."""
    bits = MIN_FILTER_BITS
    while bits < min(n * BITS_PER_KEY, MAX_FILTER_BITS):
        bits *= 2
    probes = [F.shiftrightunsigned(key, 17 * p).bitwiseAND(F.lit(bits - 1)) for p in range(PROBES)]
    at = keys.select(F.explode(F.array(*probes)).alias("at"))
    word = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("bits"))
    got = word.toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return Filter(words)


def _chunks(batches):
    hashers = Hashers()
    for b in batches:
        langs, texts, pointers = b.column(0), b.column(1), b.column(2).to_numpy(zero_copy_only=False)
        seeds = np.array([language_seed(x) for x in langs.to_pylist()], np.uint64)
        for lo, hi, data, offsets in text_chunks(texts, CHUNK_BYTES):
            yield langs.slice(lo, hi - lo), Runs(hashers, data, offsets, seeds[lo:hi], pointers[lo:hi])


def _texts(docs: DataFrame) -> DataFrame:
    pointer = F.xxhash64("text").bitwiseAND(F.lit((1 << POINTER_BITS) - 1))
    return docs.select("lang", "text", pointer.alias("ptr"))


def count_fingerprints(texts: DataFrame, choose) -> DataFrame:
    """(fp, check, c, ptr) of every run that ``choose(runs)`` yields as ``Counts``, over all ``texts``."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in Counts._fields])

    def run(batches):
        held, size = [], 0
        joined = lambda: combined(*(np.concatenate(x) for x in zip(*held)))

        def out(got):
            for at in range(0, len(got.fp), ROWS_OUT):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + ROWS_OUT].view(np.int64)) for x in got], names=Counts._fields)

        for _, runs in _chunks(batches):
            for found in choose(runs):
                held.append(found)
                size += len(found.fp)
            if size > 4 * BUFFER:
                held = [joined()]
                size = len(held[0].fp)
                if size > 2 * BUFFER:
                    yield from out(held[0])
                    held, size = [], 0
        if held:
            yield from out(joined())

    return texts.mapInArrow(run, schema).groupBy("fp", "check").agg(F.sum("c").alias("c"), F.min("ptr").alias("ptr"))


def _frequent(texts: DataFrame, choose, min_count: int, name: str) -> tuple[DataFrame, int]:
    found = cut(count_fingerprints(texts, choose).where(F.col("c") >= min_count), f"collocations-{name}")
    return found, found.count()


def _longer_runs(runs: Runs, pairs: Filter, max_words: int) -> list[Counts]:
    """The runs of three and more words whose neighbours are all frequent pairs."""
    first = runs.all_runs(2)
    pair = np.zeros(max(len(runs.lo), 1), bool)
    pair[first[pairs.has(runs.fingerprints(first, 2))]] = True
    out = []
    for words in range(3, max_words + 1):
        first = runs.all_runs(words)
        for j in range(words - 1):
            first = first[pair[first + j]]
        out.append(runs.counted(first, words))
    return out


def place_key(fp: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """One key for a fingerprint in the texts of a pointer."""
    return fp ^ (ptr.astype(np.uint64) * np.uint64(PLACE_FACTOR))


PHRASES = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("words", T.IntegerType()),
        T.StructField("phrase", T.StringType()),
        T.StructField("fp", T.LongType()),
        T.StructField("check", T.LongType()),
        T.StructField("c", T.LongType()),
    ]
)


def phrase_rows(texts: DataFrame, chosen, max_words: int) -> DataFrame:
    """(lang, words, phrase, fp, check, c) of the runs that ``chosen(runs, first words, fingerprints)`` marks, by their text.

    ``c`` counts the marked occurrences in a task.  A row with ``words`` 0 and a
    null phrase counts all words of a language.
    """

    def run(batches):
        held: dict = {}

        def out():
            cols = list(zip(*held)) or [()] * 5
            text = pa.array(cols[2], pa.binary()).cast(pa.string())
            arrays = [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), text, *(pa.array(x, pa.int64()) for x in (*cols[3:], held.values()))]
            return pa.RecordBatch.from_arrays(arrays, names=PHRASES.names)

        for langs, runs in _chunks(batches):
            names = ["und" if x is None else x for x in langs.to_pylist()]
            for row, n in zip(*np.unique(runs.row, return_counts=True)):
                key = (names[row], 0, None, 0, 0)
                held[key] = held.get(key, 0) + int(n)
            raw = runs.bytes.tobytes()
            for words in range(1, max_words + 1):
                first = runs.all_runs(words)
                fps = runs.fingerprints(first, words)
                ok = chosen(runs, first, fps)
                first, fps = first[ok], fps[ok].view(np.int64)
                lo, hi = runs.lo[first], runs.hi[first + words - 1]
                for row, a, b, *print_ in zip(runs.row[first].tolist(), lo.tolist(), hi.tolist(), fps.tolist(), runs.prime.spans(lo, hi).tolist()):
                    key = (names[row], words, raw[a:b], *print_)
                    held[key] = held.get(key, 0) + 1
            if len(held) > BUFFER:
                yield out()
                held.clear()
        if held:
            yield out()

    return texts.mapInArrow(run, PHRASES)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, words, phrase, f) of every word and phrase with ``min_count`` occurrences, and the languages' word counts."""
    sc = docs.sparkSession.sparkContext
    texts = _texts(docs)
    words, n_words = _frequent(texts, lambda runs: [runs.counted(runs.all_runs(1), 1)], min_count, "words")
    word_filter = sc.broadcast(filter_of(words, n_words))

    def pairs_of(runs: Runs):
        known = word_filter.value.has(runs.fingerprints(runs.all_runs(1), 1))
        first = runs.all_runs(2)
        return [runs.counted(first[known[first] & known[first + 1]], 2)]

    pairs, n_pairs = _frequent(texts, pairs_of, min_count, "pairs")
    pair_filter = sc.broadcast(filter_of(pairs, n_pairs))
    longer, n_longer = _frequent(texts, lambda runs: _longer_runs(runs, pair_filter.value, max_words), min_count, "runs")
    every = words.unionByName(pairs).unionByName(longer)
    place = F.col("fp").bitwiseXOR(F.expr(f"ptr * {PLACE_FACTOR}L"))
    places = sc.broadcast(filter_of(every.select(place.alias("at_text")), n_words + n_pairs + n_longer, "at_text"))
    named = cut(phrase_rows(texts, lambda runs, first, fps: places.value.has(place_key(fps, runs.pointer[first])), max_words), "collocations-named")
    totals = named.where("words = 0").groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f"))
    found = named.where("words > 0").groupBy("fp", "check", "lang", "words", "phrase").agg(F.lit(1).alias("one"))
    found = cut(found.join(every.select("fp", "check", F.col("c").alias("f")), ["fp", "check"]).drop("one"), "collocations-phrases")
    doubtful = cut(found.groupBy("fp", "check").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "collocations-doubtful")
    n_doubtful = doubtful.count()
    columns = ["lang", "words", "phrase", "f"]
    if not n_doubtful:
        return found.select(columns).unionByName(totals)
    again = sc.broadcast(filter_of(doubtful, n_doubtful))
    exact = phrase_rows(texts, lambda runs, first, fps: again.value.has(fps), max_words).where("words > 0")
    exact = cut(exact.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f")), "collocations-exact")
    sure = found.join(doubtful, ["fp", "check"], "left_anti").join(exact, ["lang", "phrase"], "left_anti").select(columns)
    return sure.unionByName(exact.where(F.col("f") >= min_count)).unionByName(totals)


def _whole(c: str) -> F.Column:
    return F.col(c).cast("decimal(19,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score): each phrase at its lowest-scoring cut, ties to the earliest."""
    candidates = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"head": F.expr("substring_index(phrase, ' ', k)"), "tail": F.expr("substring_index(phrase, ' ', k - words)")}
    )
    parts = phrases.where("words >= 1")
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    known = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    a, n, both = (F.lit(1000) * F.col("a")).cast("decimal(19,0)"), _whole("n"), _whole("l") * _whole("r")
    known = known.withColumn("product", a * n).withColumn("both", both)
    known = known.withColumn("score", F.expr("product div both"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    got = known.groupBy("lang", "phrase", "words", "a", "n").agg(best)
    return got.select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")


def covered(phrases: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, phrase): candidates inside a longer candidate that has ``percent`` of their count."""
    longer = phrases.where("words >= 3").select("lang", F.split("phrase", " ").alias("w"), "words", "f")
    size = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    inner = longer.select("*", size).select("*", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "f")
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    both = phrases.where("words >= 2").join(most, ["lang", "phrase"])
    return both.where(F.lit(100) * F.col("around") >= F.lit(percent) * F.col("f")).select("lang", "phrase")


def top_ranked(rows: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` rows with their ``rank``; a language is first thinned in many buckets."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(buckets))
    thin = rows.withColumn("bucket", bucket).withColumn("place", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    best = thin.where(F.col("place") <= top).drop("bucket", "place")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, percent: int = COVERED_PERCENT
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases that no longer one covers."""
    phrases = frequent_phrases(docs, min_count, max_words)
    kept = scored(phrases).join(covered(phrases, percent), ["lang", "phrase"], "left_anti")
    ranked = top_ranked(kept, top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
