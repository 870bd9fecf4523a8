"""Sub-word tokenizer (SFT-1): byte-level merge-rank encoding of distinct words.

A vocabulary file lists ``base64(token bytes) rank`` a line; two tokens may
merge when their bytes together are a token, the lowest rank first.  All
distinct words of an Arrow batch are encoded in lockstep: one array holds
their tokens, and each step merges, in every word, all occurrences of that
word's lowest-ranked pair.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.functions.arrow_text import expand, flat

# Fixed value: how a text is cut into words before they are encoded (the
# public pattern of the byte-level vocabularies; every character is in one word).
WORD_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.iinfo(np.int64).max


class SubwordTokenizer:
    """Words, merge table and bytes of a vocabulary; ids are ranks, ``eos`` the first free one."""

    def __init__(self, tokens: dict[bytes, int], pattern: str = WORD_PATTERN) -> None:
        self.pattern = pattern
        self.size = max(tokens.values()) + 1
        self.eos = self.size
        single = [tokens.get(bytes([b]), -1) for b in range(256)]
        if min(single) < 0:
            raise ValueError("the vocabulary lacks single bytes")
        self.byte_ids = np.array(single, np.int64)
        pairs = [
            (tokens[t[:k]] * self.size + tokens[t[k:]], rank) for t, rank in tokens.items() for k in range(1, len(t)) if t[:k] in tokens and t[k:] in tokens
        ]
        pairs.sort()
        self.pair_keys = np.array([p for p, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        by_rank = [b""] * self.size
        for t, rank in tokens.items():
            by_rank[rank] = t
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.byte_ends = np.concatenate([[0], np.cumsum([len(t) for t in by_rank])]).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def encode_words(self, words: pa.Array) -> pa.Array:
        """Token ids of every word."""
        data, offsets = flat(words)
        ids = self.byte_ids[data]
        word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        n_words = len(offsets) - 1
        while len(ids):
            rank = np.full(len(ids), NO_RANK)
            same = word[1:] == word[:-1]
            rank[:-1][same] = self.ranks(ids[:-1][same], ids[1:][same])
            best = np.full(n_words, NO_RANK)
            np.minimum.at(best, word, rank)
            open_word = best[word] != NO_RANK
            done.append((word[~open_word], ids[~open_word]))
            ids, word, rank = ids[open_word], word[open_word], rank[open_word]
            if not len(ids):
                break
            hit = rank == best[word]
            # In a run such as a a a only every second pair is merged.
            start = hit & ~np.append(False, hit[:-1])
            place = np.arange(len(hit)) - np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))
            hit &= place % 2 == 0
            ids = np.where(hit, rank, ids)
            kept = ~np.append(False, hit[:-1])
            ids, word = ids[kept], word[kept]
        if not done:
            return pa.ListArray.from_arrays(pa.array(np.zeros(n_words + 1), pa.int32()), pa.array([], pa.int32()))
        word, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        ends = np.searchsorted(word[order], np.arange(n_words + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[order], pa.int32()))

    def decode_ids(self, ids: pa.Array) -> pa.Array:
        """Texts of lists of ids; ids outside the vocabulary have no text, broken UTF-8 becomes U+FFFD."""
        ids = ids.cast(pa.list_(pa.int64()))
        sizes = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        values = ids.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        known = (values >= 0) & (values < self.size)
        values, row = values[known], row[known]
        n = self.byte_ends[values + 1] - self.byte_ends[values]
        raw = self.bytes[np.repeat(self.byte_ends[values], n) + expand(n)].tobytes()
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, weights=n, minlength=len(sizes)))]).astype(np.int64).tolist()
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())

    def words(self, c: Column) -> Column:
        """The words of a text, in order; joined they are the text."""
        return F.regexp_extract_all(c, F.lit(self.pattern), F.lit(0))

    def encode_lists(self, lists: pa.Array) -> pa.Array:
        """Token ids of every list of words, one after the other; null has none."""
        sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        known = self.encode_words(coded.dictionary)
        at, ends = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), known.offsets.to_numpy().astype(np.int64)
        n = np.diff(ends)[at]
        places = np.repeat(ends[at], n) + expand(n)
        word_ends = np.append(0, np.cumsum(n))
        ids = known.values.take(pa.array(places)).cast(pa.int32())
        return pa.ListArray.from_arrays(pa.array(word_ends[np.append(0, np.cumsum(sizes))], pa.int32()), ids)

    def encode(self, words: Column) -> Column:
        """Token ids of a list of words; a batch's distinct words are encoded once."""
        return F.arrow_udf(self.encode_lists, T.ArrayType(T.IntegerType()))(words)

    def word_table(self, words: DataFrame) -> DataFrame:
        """(word, ids) of a table of distinct words."""
        encode = F.arrow_udf(self.encode_words, T.ArrayType(T.IntegerType()))
        return words.select("word", encode("word").alias("ids"))

    def decode(self, ids: Column) -> Column:
        return F.arrow_udf(self.decode_ids, T.StringType())(ids)


def read_tokenizer(spark: SparkSession, path: str, pattern: str = WORD_PATTERN) -> SubwordTokenizer:
    """The tokenizer of a vocabulary file: a fixed, documented size (some 50,000 lines), whatever the data."""
    lines = [r.value.split() for r in spark.read.text(path).collect()]
    return SubwordTokenizer({base64.b64decode(t): int(rank) for t, rank in filter(None, lines)}, pattern)
