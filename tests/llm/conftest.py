"""Odd documents shared by the tests of the training-data operators."""

import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

VOCAB = "the of and to a in is that river stone quiet märz señor élan über water light 42 x-ray o'neil naïve rapidly".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(VOCAB) + ("" if r.random() < 0.5 else str(r.randrange(400))) for _ in range(n)]
    return "".join(w + (".\n" if r.random() < 0.08 else " ") for w in words).strip()


#: Clashing names an input may carry besides its own columns.
EXTRA = ["size", "target", "fp", "kept", "whole", "tid", "k1", "group", "m", "word", "h", "taken", "removed"]


def odd_rows():
    long_text = prose(1, 20_000)
    rows = [
        (1, prose(2, 120), "en", "a"),
        (2, prose(2, 120), "en", "b"),  # exact copy
        (3, prose(2, 120) + " tail", "en", None),  # near copy
        (4, None, "en", "a"),
        (5, "", None, "a"),
        (6, "   \n\t ", "de", "b"),
        (7, "one", "de", "b"),
        (8, "one two", "de", "c"),
        (9, long_text, "en", "a"),
        (10, long_text[:50_000] + " changed " + long_text[50_000:], "en", "a"),
        (None, prose(3, 60), "fr", "c"),
        (None, None, None, None),
        (11, prose(4, 40), None, "c"),
        (11, prose(4, 40), None, "c"),  # repeated row
        (11, prose(5, 40), None, "c"),  # same id, other text
        (12, "aaaa " * 300, "en", "a"),
        (13, "x" * 5_000, "en", "b"),
        (14, "na\u0000me \U0001f642 日本語   ÉCOLE école " + prose(6, 30), "fr", "c"),
        (15, "same line\n" * 40 + prose(7, 25), "en", "a"),
    ]
    return rows


def schema(extra: bool) -> T.StructType:
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in (EXTRA if extra else [])])


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, copies, repeated rows and clashing extra columns."""
    rows = [(i, t, la, so, len(t or ""), *(["?"] * len(EXTRA))) for i, t, la, so in odd_rows()]
    return spark.createDataFrame(rows, schema(True)).repartition(3, "text")


@pytest.fixture(scope="session")
def none(spark):
    """No rows at all."""
    return spark.createDataFrame([], schema(False))
