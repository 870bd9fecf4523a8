"""Vectorised work on batches of whole texts inside Arrow tasks.

Spark partitions and shuffles the rows; these helpers run in a task over the
UTF-8 bytes of an Arrow string column.  Rows are taken in chunks of a few MB
of text (a longer text is a chunk of its own), so memory follows the chunk
and the longest text, not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_BYTES = 2 << 20

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True for the bytes of words [^\x20\x09-\x0D]+.
SPACED_WORD = np.ones(256, dtype=bool)
SPACED_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: True for the bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = True
ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x80:] = True


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them); null texts are empty."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    n = len(texts)
    if n == 0:
        return
    big = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if big else np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + chunk_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    new_fields: Sequence[T.StructField],
    make: Callable[[], Callable[[np.ndarray, np.ndarray], Sequence]],
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``keep`` columns of ``df`` plus ``new_fields`` computed from column ``text``.

    ``make`` runs once per task and returns ``f(bytes, offsets)``, which gives
    one Arrow array (or NumPy array) per new field, or a tuple of row numbers
    and such arrays where the result has other rows than the input.
    """
    keep = list(keep)
    cols = list(dict.fromkeys([*keep, text]))
    schema = T.StructType([*(df.schema[c] for c in keep), *new_fields])
    names = [f.name for f in schema.fields]

    def run(batches):
        f = make()
        for b in batches:
            at = {c: b.column(i) for i, c in enumerate(cols)}
            for lo, hi, data, offsets in text_chunks(at[text], chunk_bytes):
                made = f(data, offsets)
                kept = [at[c].slice(lo, hi - lo) for c in keep]
                if isinstance(made, tuple):
                    rows, made = made
                    kept = [c.take(pa.array(rows)) for c in kept]
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return df.select(*cols).mapInArrow(run, schema)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row's first): words never cross rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    first = np.empty(n, bool)
    first[0] = inside[0]
    np.logical_and(inside[1:], ~inside[:-1], out=first[1:])
    last = np.empty(n, bool)
    last[-1] = inside[-1]
    np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def count_per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class SpanHasher:
    """64-bit hashes of short byte spans from one polynomial prefix sum (mod 2**64)."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self) -> None:
        self._up = self._down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> "SpanHasher":
        n = len(data)
        if len(self._up) <= n:
            size = n + n // 8 + 1
            up, down = np.full(size, self.BASE, np.uint64), np.full(size, self.INVERSE, np.uint64)
            up[0] = down[0] = 1
            self._up, self._down = np.cumprod(up), np.cumprod(down)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=sums[1:])
        self._sums = sums
        return self

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self._sums[ends] - self._sums[starts]) * self._down[starts])


class PrimeHasher:
    """Hashes of byte spans from prefix sums modulo the prime 2**31 - 1."""

    PRIME = np.uint64((1 << 31) - 1)
    BASE = 1_103_515_245

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        have = 1
        while have < n:
            more = min(have, n - have)
            out[have : have + more] = out[:more] * np.uint64(pow(base, have, int(self.PRIME))) % self.PRIME
            have += more
        return out

    def load(self, data: np.ndarray) -> "PrimeHasher":
        n = len(data)
        if len(self.up) <= n:
            size = n + n // 8 + 1
            self.up, self.down = self.powers(self.BASE, size), self.powers(pow(self.BASE, -1, int(self.PRIME)), size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.up[:n] % self.PRIME, out=self.sums[1:])
        return self

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) % self.PRIME * self.down[starts] % self.PRIME


class TextHasher(SpanHasher):
    """64-bit hashes of spans of any length.

    A polynomial modulo 2**64 gives certain long strings of few distinct bytes
    the same hash whatever its base.  Spans over ``LONG`` bytes therefore also
    carry their hash modulo a prime, whose sums are made only if such a span
    is asked for.
    """

    LONG = 64

    def __init__(self) -> None:
        super().__init__()
        self._prime = PrimeHasher()

    def load(self, data: np.ndarray) -> "TextHasher":
        super().load(data)
        self._waiting = data
        return self

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = super().spans(starts, ends)
        long = np.flatnonzero(ends - starts > self.LONG)
        if len(long):
            if self._waiting is not None:
                self._prime.load(self._waiting)
                self._waiting = None
            out[long] = mix64(out[long] + self._prime.spans(starts[long], ends[long]) * np.uint64(self.BASE))
        return out


def window_hashes(units: np.ndarray, weights: Sequence[int]) -> np.ndarray:
    """Hash of every run of ``len(weights)`` unit hashes; weight 0 skips a position."""
    n = len(units) - len(weights) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, w in enumerate(weights):
        if w:
            total += units[j : j + n] * np.uint64(w)
    return mix64(total)


def odd_weights(n: int, seed: int = 1) -> list[int]:
    """``n`` fixed odd 64-bit multipliers."""
    x, out = seed & ((1 << 64) - 1), []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) & ((1 << 64) - 1)
        out.append((x ^ (x >> 29)) | 1)
    return out


def row_of(firsts: np.ndarray, n: int) -> np.ndarray:
    """Row index of each of ``n`` items, from the items-before-row table."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[:n]
