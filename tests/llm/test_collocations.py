"""Phrase collocations against a plain count."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from captally.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_count, max_words=5, top=2000, percent=100):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    f[key] = f.get(key, 0) + 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, w), a in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                if 100 * a >= percent * cand[(lang, w[i : i + size])]:
                    gone.add((lang, w[i : i + size]))
    rows = {}
    for (lang, w), a in cand.items():
        if (lang, w) in gone:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[(lang, w[:k])] * f[(lang, w[k:])]), k, f[(lang, w[:k])], f[(lang, w[k:])]) for k in range(1, len(w)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    out = set()
    for lang, found in rows.items():
        for rank, (s, a, w, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, w.decode(), -a, left, right, n[lang], -s))
    return out


def docs(seed, n):
    r = random.Random(seed)
    words = "The of und ÉCOLE école a b c d x\u0000y 日本 \U0001f642 o'neil".split(" ")
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(1, 60)):
            parts.append(r.choice(words) if r.random() < 0.6 else r.choice(["of the a", "New York city hall", "a a a a"]))
            parts.append(r.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "\r\n", " "]))
        rows.append(("".join(parts), r.choice(["en", "de", None, ""])))
    rows += [(None, "en"), ("", None), (" \n ", "fr"), ("word", "fr"), ("same phrase here", "xx"), ("same phrase here", "xx")]
    return rows + rows[:3] + [("long run of words " * 20_000, "en")]


def report(spark, rows, **how):
    df = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1 as fp", "2 as c", "3 as words", "'z' as phrase", "0 as n").repartition(3)
    got = [tuple(r) for r in collocations.collocations(df, **how).collect()]
    assert len(set(got)) == len(got)
    return set(got)


@pytest.mark.parametrize("how", [{"min_count": 2}, {"min_count": 5, "percent": 60}, {"min_count": 3, "top": 4}, {"min_count": 2, "max_words": 3}])
def test_equals_a_plain_count(spark, how):
    rows = docs(1, 120)
    assert report(spark, rows, **how) == plain(rows, **how) != set()


def test_a_full_filter_and_small_buffers_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MIN_FILTER_BITS", 64)
    monkeypatch.setattr(collocations, "MAX_FILTER_BITS", 64)
    monkeypatch.setattr(collocations, "BUFFER", 8)
    rows = docs(2, 60)
    assert report(spark, rows, min_count=2) == plain(rows, 2)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """With wide fingerprints of three bits nearly all phrases collide; their checks tell them apart."""
    monkeypatch.setattr(collocations.Runs, "fingerprints", lambda self, first, words: self.bytes[self.lo[first]].astype(np.uint64) & np.uint64(7))
    rows = docs(3, 40)
    assert report(spark, rows, min_count=2) == plain(rows, 2)


def test_collisions_that_texts_show_are_counted_by_bytes(spark, monkeypatch):
    """Fingerprint and check made equal for all words of one first letter, and every text named by one pointer."""
    monkeypatch.setattr(collocations.Runs, "fingerprints", lambda self, first, words: self.bytes[self.lo[first]].astype(np.uint64) + np.uint64(words))
    monkeypatch.setattr(collocations.PrimeHasher, "spans", lambda self, starts, ends: starts.astype(np.uint64) * np.uint64(0))
    monkeypatch.setattr(collocations, "POINTER_BITS", 0)
    rows = docs(4, 40)
    assert report(spark, rows, min_count=2) == plain(rows, 2)


def test_equal_wide_hash_other_bytes():
    """Thue-Morse strings of 1,024 bytes collide in a polynomial modulo 2**64; the prime tells them apart."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    data = np.frombuffer(f"{one} {two} {one}".encode(), np.uint8)
    runs = collocations.Runs(collocations.Hashers(), data, np.array([0, len(data)]), np.array([1], np.uint64), np.array([0]))
    got = runs.counted(runs.all_runs(1), 1)
    assert len(set(got.check.tolist())) == 2 and got.c.sum() == 3


def test_products_beyond_64_bits(spark):
    big = 10**13
    rows = [("en", 0, None, 10**16), ("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 2)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, words int, phrase string, f long")).first()
    assert got.score == 1000 * (big - 2) * 10**16 // (big * (big - 1))


def test_no_rows(spark):
    assert report(spark, [(None, None), ("a b", "en")], min_count=2) == set()
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
