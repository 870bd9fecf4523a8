"""Scalar text functions, all built from JVM-side Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, as a regex
# class that Java and RE2 read the same way.  U+001C..U+001F are included
# (Python treats them as whitespace, Java's \s does not).
WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """STR-1: remove leading and trailing Unicode whitespace (Python ``str.strip()``)."""
    return F.regexp_replace(_col(c), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def first_sentence(c) -> Column:
    """STR-2: text before the first '.', plus '.', when a '.' is present."""
    c = _col(c)
    return F.when(F.instr(c, ".") > 0, F.concat(F.substring_index(c, ".", 1), F.lit("."))).otherwise(c)


def image_of_key(c) -> Column:
    """STR-3: the image name in a ``image#k`` key."""
    return F.substring_index(_col(c), "#", 1)


def append_eos(c, eos: str) -> Column:
    """STR-4: caption followed by the end-of-sequence text."""
    return F.concat(_col(c), F.lit(eos))


def plot_title(index, caption) -> Column:
    """STR-8: two-line title of a qualitative row."""
    return F.format_string("ID: %s\nPred: %s", _col(index), _col(caption))


def image_id(c) -> Column:
    """ID-1: stable non-negative 52-bit id, first 13 hex digits of SHA-256."""
    return F.conv(F.substring(F.sha2(_col(c), 256), 1, 13), 16, 10).cast("bigint")


def scale_round(c, scale: float = 100.0, digits: int = 2) -> Column:
    """NUM-1: ``round(x * scale, digits)``."""
    return F.round(_col(c) * F.lit(scale), digits)


def to_json_text(*cols) -> Column:
    """JSN-1: JSON object text of the given columns."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))


def wrap_single(c) -> Column:
    """ARR-1: caption as a one-element list."""
    return F.array(_col(c))


def image_path(image, folder: str) -> Column:
    """PRJ-2: folder + image name."""
    return F.concat_ws("/", F.lit(folder.rstrip("/")), _col(image))
