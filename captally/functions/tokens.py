"""Tokenisers used by the metrics (STR-5, STR-6, STR-7) as column functions.

STR-5 and STR-6 are plain Spark expressions.  STR-7 is the longest-match lexer
of ``captally.functions.lexer`` over Arrow batches.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.functions.lexer import lex
from captally.functions.text import WHITESPACE_CLASS, _col


def whitespace_tokens(c) -> Column:
    """STR-5: split on runs of whitespace, no empty tokens (Python ``str.split()``)."""
    return F.filter(F.split(_col(c), f"{WHITESPACE_CLASS}+"), lambda w: w != "")


def space_tokens(c) -> Column:
    """STR-6: split on single spaces, empty tokens kept (Python ``str.split(' ')``)."""
    return F.split(_col(c), " ")


def caption_text(c) -> Column:
    """What the caption lexer reads: lower case, with plain apostrophes."""
    return F.translate(F.lower(_col(c)), "’", "'")


def _lex_batch(texts: pa.Array) -> pa.Array:
    got = lex(texts)
    return pa.ListArray.from_arrays(pa.array(got.ends, pa.int32()), got.values.cast(pa.string()))


def caption_tokens(c) -> Column:
    """STR-7: caption tokens, lower-cased, punctuation dropped (rules: ``captally.functions.lexer``); null has none."""
    return F.arrow_udf(_lex_batch, T.ArrayType(T.StringType()))(caption_text(c))
