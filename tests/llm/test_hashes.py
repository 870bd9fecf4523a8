"""Hashes of long structured strings: no two different lines or words are merged."""

import brute_llm as brute
import numpy as np

from captally.llm import lm_scoring, quality_rules
from captally.llm.text_batches import SpanHasher, TextHasher


def thue_morse(n: int, a: str = "a", b: str = "b") -> str:
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def pair(n):
    return thue_morse(n), thue_morse(n, "b", "a")


def hashes(hasher, texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    return hasher.load(data).spans(ends - [len(t) for t in texts], ends).tolist()


def test_spans_of_any_length():
    for n in (16, 64, 65, 1024, 4096, 1 << 15):
        x, y = pair(n)
        h = hashes(TextHasher(), [x, "pad", y, x])
        assert h[0] != h[2] and h[0] == h[3]
    assert len(set(hashes(SpanHasher(), pair(2048)))) == 1  # what the plain polynomial does
    # A chunk after a longer one, and spans on both sides of the limit in one call.
    hasher = TextHasher()
    first = hashes(hasher, ["q" * 5000, "short", "w" * 70])
    assert hashes(hasher, ["short", "w" * 70]) == first[1:]


def test_long_lines_and_words(spark):
    x, y = pair(2048)
    lines = "\n".join([x, y, x, " ".join(f"w{i}" for i in range(40))])
    words = f"{x} {y} {x} tail"
    docs = spark.createDataFrame([(1, lines, "en", "a"), (2, words, "en", "a")], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(docs).collect()}
    for i, t in ((1, lines), (2, words)):
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == tuple(brute.quality(t))
    scored = [tuple(r)[:6] for r in lm_scoring.score_texts(docs).orderBy("doc_id").collect()]
    want = [(i, *r) for i, r in zip((1, 2), brute.word_scores([(1, lines), (2, words)]), strict=True)]
    for a, b in zip(scored, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-7
