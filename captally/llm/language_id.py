"""Language identification with blended-spectrum string kernels.

The kernel of two texts is the number of character n-grams (n = 1..3, over
lower-cased letters with runs of anything else as one space) present in both,
normalised to 1 for equal texts.  ``LANDMARKS`` training texts span a Nyström
feature space; one ridge regression per language (one against the rest) is
solved in it, and texts are scored in batches as presence matrix x landmark
matrix x coefficients.

Training rows are a bounded sample: at most ``ROWS_PER_LANGUAGE`` distinct
texts of each language, those with the smallest hashes of their text.  What
reaches the driver is bounded by that: the landmarks' n-gram sets and a
kernel row per sampled text.  Prediction is one pass over whole texts, with no
shuffle, and uses the text alone.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is everything if there is nothing to learn from; a text that shares no
n-gram with a landmark gets the language with the most training texts; a null
doc_id is not held out and not learned from; repeated rows count once in
training and are predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import map_texts
from captally.operators.materialize import cut

MAX_GRAM = 3
LANDMARKS = 240
ROWS_PER_LANGUAGE = 600
RIDGE = 0.05
#: Texts scored as one matrix product.
SCORE_ROWS = 256
HOLD_OUT = (4, 2)
SPACE = 32


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row offsets in code points) of UTF-8 bytes."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32)
    b0, b1, b2, b3 = (padded[at + i] for i in range(4))
    low = np.uint32(0x3F)
    cp = np.where(b0 < 0x80, b0, ((b0 & 0x1F) << 6) | (b1 & low))
    cp = np.where(b0 >= 0xE0, ((b0 & 0x0F) << 12) | ((b1 & low) << 6) | (b2 & low), cp)
    cp = np.where(b0 >= 0xF0, ((b0 & 0x07) << 18) | ((b1 & low) << 12) | ((b2 & low) << 6) | (b3 & low), cp)
    return cp, np.searchsorted(at, offsets)


def _letter_codes() -> np.ndarray:
    """Code 0..255 of every code point of the basic plane: letters lower-cased, anything else a space.

    ASCII letters keep their value; others share 128 codes by their low seven
    bits, which keeps the letters of one script block apart.
    """
    codes = np.full(1 << 16, SPACE, np.uint8)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            codes[c] = low if low < 128 else 128 + low % 128
    return codes


class GramReader:
    """Character n-grams of batches of texts as integer keys."""

    def __init__(self) -> None:
        self.codes = _letter_codes()

    def letters(self, data, offsets):
        """(codes with single spaces, row of each, whether each row has a letter)."""
        cp, starts = code_points(data, offsets)
        codes = self.codes[np.minimum(cp, 0xFFFF)]
        for c in np.unique(cp[cp > 0xFFFF]):
            if chr(min(int(c), 0x10FFFF)).isalpha():
                codes[cp == c] = 128 + int(c) % 128
        n = len(starts) - 1
        row = np.repeat(np.arange(n), np.diff(starts))
        letter = codes != SPACE
        keep = letter.copy()
        keep[1:] |= letter[:-1] & (row[1:] == row[:-1])
        return codes[keep], row[keep], np.bincount(row[letter], minlength=n) > 0

    def grams(self, codes, row):
        """(keys, rows) for each n: the key is the n codes as one number above those of shorter grams."""
        wide = codes.astype(np.int64)
        key, base = np.zeros(len(wide), np.int64), 0
        for n in range(1, MAX_GRAM + 1):
            m = len(wide) - n + 1
            if m <= 0:
                return
            key = (key[:m] << 8) | wide[n - 1 :]
            whole = row[:m] == row[n - 1 :]
            yield base + key[whole], row[:m][whole]
            base += 1 << (8 * n)


KEY_SPACE = sum(1 << (8 * n) for n in range(1, MAX_GRAM + 1))


def _gram_sets():
    reader = GramReader()

    def sets(data, offsets):
        codes, row, _ = reader.letters(data, offsets)
        found = list(reader.grams(codes, row))
        keys, rows = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
        pairs = np.unique(rows * KEY_SPACE + keys)
        ends = np.searchsorted(pairs, np.arange(len(offsets)) * KEY_SPACE).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array((pairs % KEY_SPACE).astype(np.int32)))]

    return sets


class Landmarks:
    """Gram sets of the landmark texts as a presence matrix over their vocabulary."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int32)

    def matrix(self) -> np.ndarray:
        """vocabulary x landmarks, each column scaled to length one."""
        m = np.zeros((len(self.vocabulary), len(self.sets)), np.float32)
        for j, s in enumerate(self.sets):
            m[np.searchsorted(self.vocabulary, s), j] = 1 / np.sqrt(len(s))
        return m

    def kernel(self):
        """Makes ``f(bytes, offsets)``, which yields (rows, kernel with every landmark, has a letter)."""
        reader, matrix = GramReader(), self.matrix()
        place = np.full(KEY_SPACE, -1, np.int32)
        place[self.vocabulary] = np.arange(len(self.vocabulary))

        def kernel(data, offsets):
            for lo in range(0, len(offsets) - 1, SCORE_ROWS):
                part = offsets[lo : lo + SCORE_ROWS + 1]
                codes, row, lettered = reader.letters(data[part[0] : part[-1]], part - part[0])
                present = np.zeros((len(part) - 1, len(self.vocabulary)), np.float32)
                for keys, rows in reader.grams(codes, row):
                    at = place[keys]
                    known = at >= 0
                    present[rows[known], at[known]] = 1
                size = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
                yield (present @ matrix) / size, lettered

        return kernel


def held_out(doc_id: str = "doc_id"):
    n, r = HOLD_OUT
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n == r, F.lit(False))


class LanguageModel:
    """Languages, landmarks and one column of coefficients per language."""

    def __init__(self, languages: list[str], landmarks: Landmarks, coefficients: np.ndarray) -> None:
        self.languages, self.landmarks, self.coefficients = languages, landmarks, coefficients


def training_sample(docs: DataFrame, rows_per_language: int) -> DataFrame:
    """(lang, h, text, nth, n_lang): at most ``rows_per_language`` distinct texts per language.

    Hashes are thinned by their value to about three times that before they
    are ranked, so no task ranks a whole language.
    """
    rows = docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    rows = rows.select("lang", F.xxhash64("text").alias("h"), "text")
    hashes = cut(rows.select("lang", "h").distinct(), "lang-hashes")
    sizes = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lang"))
    unit = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    # One row per language, as many as the model itself has columns: a broadcast deals no language to one task.
    thin = hashes.join(F.broadcast(sizes), "lang").where(unit * F.col("n_lang") < 3 * rows_per_language + 50)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "h"))
    chosen = cut(thin.withColumn("nth", nth).where(F.col("nth") <= rows_per_language), "lang-chosen")
    texts = rows.join(chosen, ["lang", "h"])
    return texts.groupBy("lang", "h", "nth", "n_lang").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, landmarks: int = LANDMARKS, rows_per_language: int = ROWS_PER_LANGUAGE, ridge: float = RIDGE) -> LanguageModel | None:
    """Learns from the text and non-null lang of documents that are not held out; None if there are none."""
    sample = cut(training_sample(docs, rows_per_language), "lang-sample")
    by_size = sample.groupBy("lang").agg(F.max("n_lang").alias("n")).orderBy(F.col("n").desc(), "lang").collect()
    languages = [r["lang"] for r in by_size]
    if not languages:
        return None
    each = max(1, landmarks // len(languages))
    chosen = sample.where(F.col("nth") <= each).select("lang", "nth", "text")
    field = T.StructField("grams", T.ArrayType(T.IntegerType()))
    sets = map_texts(chosen, "text", ["lang", "nth"], [field], _gram_sets).orderBy("lang", "nth").collect()
    marks = Landmarks([np.array(r["grams"], np.int32) for r in sets])

    def kernel_rows():
        kernel = marks.kernel()

        def rows(data, offsets):
            k = np.concatenate([x for x, _ in kernel(data, offsets)])
            ends = np.arange(len(k) + 1, dtype=np.int32) * k.shape[1]
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(k.ravel().astype(np.float32)))]

        return rows

    field = T.StructField("k", T.ArrayType(T.FloatType()))
    rows = map_texts(sample.select("lang", "h", "text"), "text", ["lang", "h"], [field], kernel_rows)
    rows = rows.orderBy("lang", "h").collect()
    k = np.array([r["k"] for r in rows], np.float64)
    y = np.array([[float(r["lang"] == name) for name in languages] for r in rows])
    base = marks.matrix().astype(np.float64)
    values, vectors = np.linalg.eigh(base.T @ base)
    sound = values > 1e-6 * values.max()
    whiten = vectors[:, sound] / np.sqrt(values[sound])
    phi = k @ whiten
    weight = 1.0 / np.maximum(y.sum(axis=0), 1)[y.argmax(axis=1)]  # every language counts alike
    weight *= len(y) / weight.sum()
    solved = np.linalg.solve((phi * weight[:, None]).T @ phi + ridge * np.eye(phi.shape[1]), (phi * weight[:, None]).T @ y)
    return LanguageModel(languages, marks, (whiten @ solved).astype(np.float32))


def _predictor(model: LanguageModel):
    names, coefficients, marks = np.array(model.languages, object), model.coefficients, model.landmarks

    def make():
        kernel = marks.kernel()

        def predict(data, offsets):
            best, score, lettered = [], [], []
            for k, has in kernel(data, offsets):
                s = k @ coefficients
                best.append(s.argmax(axis=1))
                score.append(np.clip(s.max(axis=1), 0, 1))
                lettered.append(has)
            best, score, lettered = np.concatenate(best), np.concatenate(score), np.concatenate(lettered)
            return [pa.array(np.where(lettered, names[best], "und"), pa.string()), np.where(lettered, score, 0).astype(np.float64)]

        return predict

    return make


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, from its text alone."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    fields = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]
    return map_texts(rows, "text", ["doc_id", "held_out"], fields, _predictor(model))


def identify_languages(docs: DataFrame, **fit_args) -> DataFrame:
    """Fits on the documents that are not held out and predicts all."""
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, fit(docs, **fit_args))
