"""LM scoring by subword lattices, with a word unigram score beside it.

The model is a unigram distribution over the pieces of an existing
vocabulary.  A word's probability is the sum over *all* its segmentations into
pieces, by the forward recursion in log space; a text's is the product over
its words and one end event.  Pieces start from the vocabulary's own scores
(minus a rank, taken as a Zipf weight) and are re-estimated from the training
documents by expectation-maximisation: forward-backward counts of every
distinct training word, weighted by how often it occurs.  Characters that are
no piece are spelled with the byte pieces, so every text has a probability.

Scale: segmentations never cross words, so lattices are built once per
distinct word, not per occurrence.  Word counts are a distributed table of
all words.  For scoring, the ``FREQUENT`` most common words (of at most
``FREQUENT_BYTES`` bytes, so the table is bounded) are resolved during the
scan; every other word of a document is joined with the word table, which is
exact for any vocabulary size.  Piece probabilities are bounded by the
vocabulary file.

Defined results: a null text is an empty one: one end token, no words; a null
doc_id is not held out and not learned from; with nothing to learn from, N and
V are 0 and pieces keep their starting weights; repeated rows are scored
alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import LOWER, SPACED_WORD, SpanHasher, TextHasher, map_texts, row_of, word_spans
from captally.operators.materialize import cut

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HOLD_OUT = (7, 2)
EM_ROUNDS = 2
ZIPF_SHIFT = 10.0
FREQUENT = 1 << 17
FREQUENT_BYTES = 32
#: Distinct words of one training task.
TASK_WORDS = 1 << 17
#: Word characters of one lattice batch.
BATCH_CHARS = 1 << 18
WORD_MARK = "▁".encode()


class Pieces:
    """An existing vocabulary: texts of normal pieces, and log weights of normal, byte and end pieces."""

    def __init__(self, texts: list[bytes], scores: list[float]) -> None:
        self.texts = texts
        n = len(texts)
        zipf = 1.0 / (-np.array(scores) + ZIPF_SHIFT)
        weights = np.concatenate((zipf, np.full(256, zipf.min()), [zipf.max()]))
        self.prior = weights / weights.sum()
        self.log_p = np.log(self.prior)
        self.n = n

    @classmethod
    def load(cls, path: str) -> "Pieces":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        # Pieces of several word marks carry a sentinel instead of a rank; they match no word.
        ids = [i for i in ids if model.get_score(i) > -1e6]
        return cls([model.id_to_piece(i).encode() for i in ids], [model.get_score(i) for i in ids])

    def reestimated(self, counts: np.ndarray) -> "Pieces":
        """Expected counts smoothed by the starting weights."""
        new = object.__new__(Pieces)
        new.texts, new.prior, new.n = self.texts, self.prior, self.n
        p = counts + len(self.prior) * self.prior
        new.log_p = np.log(p / p.sum())
        return new

    @property
    def log_end(self) -> float:
        return float(self.log_p[-1])


class Lattice:
    """Segmentation lattices of batches of words."""

    def __init__(self, pieces: Pieces) -> None:
        self.log_p, self.n = pieces.log_p, pieces.n
        self.hasher = SpanHasher()
        data = np.frombuffer(b"".join(pieces.texts), np.uint8)
        ends = np.cumsum([len(t) for t in pieces.texts])
        starts = ends - [len(t) for t in pieces.texts]
        h = self.hasher.load(data).spans(starts, ends)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[h & np.uint64((1 << 22) - 1)] = True
        self.longest = max(int(((np.frombuffer(t, np.uint8) & 0xC0) != 0x80).sum()) for t in pieces.texts)

    def _pieces_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Piece number of every span, -1 if it is none."""
        h = self.hasher.spans(starts.ravel(), ends.ravel())
        out = np.full(len(h), -1, np.int64)
        likely = np.flatnonzero(self.maybe[h & np.uint64((1 << 22) - 1)])
        at = np.minimum(np.searchsorted(self.hashes, h[likely]), len(self.hashes) - 1)
        same = self.hashes[at] == h[likely]
        out[likely[same]] = self.order[at[same]]
        return out.reshape(starts.shape)

    def _groups(self, words: pa.Array):
        """(word numbers, bounds [word, char + 1] in the loaded bytes) for words of one length in characters."""
        buffers = words.buffers()
        offs = np.frombuffer(buffers[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        raw = np.frombuffer(buffers[2], np.uint8)[offs[0] : offs[-1]] if len(words) and buffers[2] is not None else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        n, mark = len(words), len(WORD_MARK)
        new = offs + mark * np.arange(n + 1)
        data = np.empty(len(raw) + mark * n, np.uint8)
        is_mark = np.zeros(len(data), bool)
        for i, byte in enumerate(WORD_MARK):
            data[new[:-1] + i] = byte
            is_mark[new[:-1] + i] = True
        data[~is_mark] = raw
        self.hasher.load(data)
        self.byte_log = np.concatenate(([0.0], np.cumsum(self.log_p[self.n + data.astype(np.int64)])))
        self.data = data
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        # A word that begins with a stray continuation byte still begins at its own mark.
        first = np.searchsorted(chars, new)
        length = np.diff(first)
        for size in np.unique(length):
            rows = np.flatnonzero(length == size)
            step = max(1, BATCH_CHARS // int(size))
            for lo in range(0, len(rows), step):
                part = rows[lo : lo + step]
                bounds = np.empty((len(part), size + 1), np.int64)
                bounds[:, :-1] = chars[first[part][:, None] + np.arange(size)]
                bounds[:, -1] = new[part + 1]
                yield part, bounds

    def _arcs(self, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per length in characters: (piece numbers, log probabilities) by start; -1 is spelled in bytes or absent."""
        arcs = []
        size = bounds.shape[1] - 1
        for n in range(1, min(self.longest, size) + 1):
            starts, ends = bounds[:, : size - n + 1], bounds[:, n:]
            ids = self._pieces_of(starts, ends)
            absent = self.byte_log[ends] - self.byte_log[starts] if n == 1 else -np.inf
            arcs.append((ids, np.where(ids >= 0, self.log_p[ids], absent)))
        return arcs

    def forward(self, bounds: np.ndarray, arcs: list) -> np.ndarray:
        """Log marginal of every prefix [word, char + 1]."""
        alpha = np.full(bounds.shape, -np.inf)
        alpha[:, 0] = 0
        for j in range(1, bounds.shape[1]):
            terms = [alpha[:, j - n] + arcs[n - 1][1][:, j - n] for n in range(1, min(len(arcs), j) + 1)]
            alpha[:, j] = np.logaddexp.reduce(terms, axis=0)
        return alpha

    def backward(self, bounds: np.ndarray, arcs: list) -> np.ndarray:
        beta = np.full(bounds.shape, -np.inf)
        size = bounds.shape[1] - 1
        beta[:, size] = 0
        for i in range(size - 1, -1, -1):
            terms = [beta[:, i + n] + arcs[n - 1][1][:, i] for n in range(1, min(len(arcs), size - i) + 1)]
            beta[:, i] = np.logaddexp.reduce(terms, axis=0)
        return beta

    def log_probabilities(self, words: pa.Array) -> np.ndarray:
        out = np.zeros(len(words))
        for rows, bounds in self._groups(words):
            out[rows] = self.forward(bounds, self._arcs(bounds))[:, -1]
        return out

    def expected_counts(self, words: pa.Array, times: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations of the words, each ``times`` seen."""
        total = np.zeros(len(self.log_p))
        for rows, bounds in self._groups(words):
            arcs = self._arcs(bounds)
            alpha, beta = self.forward(bounds, arcs), self.backward(bounds, arcs)
            size = bounds.shape[1] - 1
            for n, (ids, log_p) in enumerate(arcs, 1):
                share = np.exp(alpha[:, : size - n + 1] + log_p + beta[:, n:] - alpha[:, -1:]) * times[rows][:, None]
                piece = ids >= 0
                np.add.at(total, ids[piece], share[piece])
                if n == 1 and not piece.all():
                    r, c = np.nonzero(~piece)
                    lo, hi = bounds[r, c], bounds[r, c + 1]
                    for k in range(4):
                        within = lo + k < hi
                        np.add.at(total, self.n + self.data[(lo + k)[within]].astype(np.int64), share[r, c][within])
        return total


def _held_out():
    n, r = HOLD_OUT
    return F.crc32(F.col("doc_id").cast("string")) % n == r


def _spans_as_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    at = np.repeat(starts, size) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def _distinct_words():
    """Distinct words of each chunk with their counts; a row per (chunk, word)."""
    hasher = TextHasher()

    def words(data, offsets):
        low = LOWER[data]
        starts, ends, firsts = word_spans(low, offsets, SPACED_WORD)
        h = hasher.load(low).spans(starts, ends)
        _, first, n = np.unique(h, return_index=True, return_counts=True)
        rows = np.zeros(len(first), np.int64)
        return rows, [_spans_as_strings(low, starts[first], ends[first]), n.astype(np.int64)]

    return words


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): every distinct word of all documents and its occurrences in training documents."""
    fields = [T.StructField("word", T.StringType(), False), T.StructField("n", T.LongType(), False)]
    learn = F.coalesce(~_held_out(), F.lit(False))
    parts = []
    for training in (True, False):
        rows = docs.where(learn == training).select("text", F.lit(training).alias("training"))
        parts.append(map_texts(rows, "text", ["training"], fields, _distinct_words))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("word").agg(F.sum(F.when(F.col("training"), F.col("n")).otherwise(0)).alias("c"))


def train_pieces(counts: DataFrame, n_types: int, ends: int, pieces: Pieces, rounds: int = EM_ROUNDS) -> Pieces:
    """Expectation-maximisation over the distinct training words; at most one count per piece reaches the driver."""
    # A task sends a count per piece whatever its size, so tasks should have many words each.
    words = counts.where("c > 0").select("word", "c").coalesce(n_types // TASK_WORDS + 1)
    for _ in range(rounds):

        def expect(batches, now=pieces):
            lattice, total = Lattice(now), None
            for b in batches:
                got = lattice.expected_counts(b.column(0), b.column(1).to_numpy(zero_copy_only=False).astype(float))
                total = got if total is None else total + got
            if total is not None:
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "n"])

        found = words.mapInArrow(expect, "piece int, n double")
        expected = np.zeros(len(pieces.prior))
        for r in found.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            expected[r["piece"]] = r["n"]
        expected[-1] = ends
        pieces = pieces.reestimated(expected)
    return pieces


def with_lattice(counts: DataFrame, pieces: Pieces) -> DataFrame:
    """Adds ``log_p``: natural log of each word's marginal probability."""

    def score(batches):
        lattice = Lattice(pieces)
        for b in batches:
            lp = lattice.log_probabilities(b.column(0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lp)], names=["word", "c", "log_p"])

    return counts.select("word", "c").mapInArrow(score, "word string, c long, log_p double")


MARK_FIELDS = [
    T.StructField("word", T.StringType(), True),
    T.StructField("n", T.LongType(), False),
    T.StructField("n_tokens", T.LongType(), True),
    T.StructField("n_known", T.LongType(), True),
    T.StructField("log_counts", T.DoubleType(), True),
    T.StructField("log_p", T.DoubleType(), True),
]


def _scorer(frequent: list[tuple[str, int, float]]):
    """Per text a row without word (its sums over frequent words), then a row per other distinct word."""
    texts = [w.encode() for w, _, _ in frequent]
    known_c = np.array([c for _, c, _ in frequent], np.int64)
    known_p = np.array([p for _, _, p in frequent], float)

    def make():
        hasher = TextHasher()
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        h = hasher.load(np.frombuffer(b"".join(texts), np.uint8)).spans(ends - [len(t) for t in texts], ends) if texts else np.zeros(0, np.uint64)
        order = np.argsort(h)
        hashes, c, p = h[order], known_c[order], known_p[order]
        log_c = np.log10(c + 1.0)
        maybe = np.zeros(1 << 24, bool)
        low_bits = np.uint64((1 << 24) - 1)
        maybe[hashes & low_bits] = True

        def score(data, offsets):
            n = len(offsets) - 1
            low = LOWER[data]
            starts, ends, firsts = word_spans(low, offsets, SPACED_WORD)
            row = row_of(firsts, len(starts))
            words = hasher.load(low).spans(starts, ends)
            at = np.full(len(words), -1, np.int64)
            likely = np.flatnonzero(maybe[words & low_bits])
            if len(hashes):
                found = np.minimum(np.searchsorted(hashes, words[likely]), len(hashes) - 1)
                same = hashes[found] == words[likely]
                at[likely[same]] = found[same]
            common = at >= 0
            r, k = row[common], at[common]
            sums = [np.bincount(r, weights=x[k], minlength=n) for x in ((c > 0).astype(float), log_c, p)]
            rare = np.flatnonzero(~common)
            key = words[rare] ^ (row[rare].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            first = rare[first]
            strings = pa.concat_arrays([pa.nulls(n, pa.string()), _spans_as_strings(low, starts[first], ends[first])])
            nothing = np.zeros(len(first), bool)
            blank = np.concatenate((np.ones(n, bool), nothing))

            def marks(x, kind):
                return pa.array(np.concatenate((x, np.zeros(len(first), x.dtype))), kind, mask=~blank)

            return np.concatenate((np.arange(n), row[first])), [
                strings,
                np.concatenate((np.ones(n, np.int64), times.astype(np.int64))),
                marks(np.diff(firsts) + 1, pa.int64()),
                marks(sums[0].astype(np.int64), pa.int64()),
                marks(sums[1], pa.float64()),
                marks(sums[2], pa.float64()),
            ]

        return score

    return make


def frequent_words(table: DataFrame, most: int) -> list[tuple[str, int, float]]:
    """The words above the least count that at most ``most`` words reach (in sixteenths of an octave).

    Found from a histogram of a few hundred rows, so nothing but these words
    is sent to the driver, however many partitions the table has.
    """
    short = table.where((F.col("c") > 0) & (F.octet_length("word") <= FREQUENT_BYTES))
    short = short.withColumn("level", F.floor(F.log2("c") * 16).cast("int"))
    least, total = None, 0
    for level, n in sorted(short.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        total += n
        if total > most:
            break
        least = level
    if least is None:
        return []
    return sorted(tuple(r) for r in short.where(F.col("level") >= least).select("word", "c", "log_p").collect())


def score_texts(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = EM_ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = docs.select("doc_id", "text")
    counts = cut(word_counts(docs), "lm-counts")
    ends = docs.where(~_held_out()).count()
    trained = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_train, n_types = trained[0] + ends, trained[1] + (1 if ends else 0)
    pieces = train_pieces(counts, trained[1], ends, Pieces.load(vocabulary), rounds)
    table = cut(with_lattice(counts, pieces), "lm-words")
    top = frequent_words(table, frequent)

    rows = docs.withColumn("tid", F.xxhash64("text"))
    found = map_texts(rows, "text", ["doc_id", "tid"], MARK_FIELDS, _scorer(top))
    found = cut(found, "lm-scan")
    rare = found.where(F.col("word").isNotNull()).select("doc_id", "tid", "word", "n").join(table, "word")
    rare = rare.select(
        "doc_id", "tid", F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * F.log10(F.col("c") + 1.0)).alias("log_counts"), (F.col("n") * F.col("log_p")).alias("log_p"),
    )
    marks = found.where(F.col("word").isNull()).select("doc_id", "tid", F.col("n").alias("rows"), "n_tokens", "n_known", "log_counts", "log_p")
    cols = ["rows", "n_tokens", "n_known", "log_counts", "log_p"]
    sums = rare.unionByName(marks).groupBy("doc_id", "tid").agg(*(F.sum(c).alias(c) for c in cols))
    # Repeated rows were summed together: share out and repeat.
    end_known, end_log = int(ends > 0), float(np.log10(ends + 1.0))
    floor = float(np.log10(n_train + n_types + 1.0))
    tokens = (F.col("n_tokens") / F.col("rows")).cast("long")
    return (
        sums.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .withColumn("held_out", F.coalesce(_held_out(), F.lit(False)))
        .select(
            "doc_id",
            "held_out",
            tokens.alias("n_tokens"),
            ((F.col("n_known") / F.col("rows")).cast("long") + end_known).alias("n_known"),
            F.lit(n_train).cast("long").alias("train_tokens"),
            (F.col("log_counts") / F.col("rows") + end_log - tokens * floor).alias("base_score"),
            ((F.col("log_p") / F.col("rows") + pieces.log_end) / float(np.log(10.0))).alias("score"),
        )
    )
