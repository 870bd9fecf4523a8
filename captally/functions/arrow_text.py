"""Vectorised splitting of Arrow string columns, used inside Arrow tasks."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The UTF-8 forms of the white space that Python's str.split() splits on (see text.WHITESPACE_CLASS).
ASCII_SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20]
TWO_BYTE_SPACES = [(0xC2, 0x85), (0xC2, 0xA0)]
THREE_BYTE_SPACES = [(0xE1, 0x9A, 0x80), *((0xE2, 0x80, x) for x in range(0x80, 0x8B)), (0xE2, 0x80, 0xA8), (0xE2, 0x80, 0xA9),
                     (0xE2, 0x80, 0xAF), (0xE2, 0x81, 0x9F), (0xE3, 0x80, 0x80)]


class Tokens(NamedTuple):
    """Tokens of many rows: those of row i are ``values[ends[i]:ends[i + 1]]``."""

    values: pa.Array  # strings or dictionary-encoded strings
    ends: np.ndarray


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, row offsets into them) of a string column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of ``data`` as a string column."""
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes()))


def spaces(data: np.ndarray) -> np.ndarray:
    """True for every byte of a white-space character."""
    table = np.zeros(256, bool)
    table[ASCII_SPACES] = True
    out = table[data]
    forms = (*TWO_BYTE_SPACES, *THREE_BYTE_SPACES)
    leads = {b: np.flatnonzero(data == b) for b in {form[0] for form in forms}}
    for form in forms:
        at = leads[form[0]]
        at = at[: np.searchsorted(at, len(data) - len(form) + 1)]
        for k, b in enumerate(form[1:], 1):
            at = at[data[at + k] == b]
        for k in range(len(form)):
            out[at + k] = True
    return out


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, runs before each row) of the runs of True, which never cross rows."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def split_whitespace(texts: pa.Array) -> Tokens:
    """Python's ``str.split()`` of every row."""
    data, offsets = flat(texts)
    starts, ends, firsts = runs(~spaces(data), offsets)
    return Tokens(gather(data, starts, ends), firsts)


def split_spaces(texts: pa.Array) -> Tokens:
    """Python's ``str.split(" ")`` of every row: empty tokens are kept, an empty row has one."""
    data, offsets = flat(texts)
    starts, ends, firsts = space_spans(data, offsets)
    return Tokens(gather(data, starts, ends), firsts)


def space_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, tokens before each row) of ``split_spaces``."""
    cut = np.flatnonzero(data == 0x20)
    per_row = np.diff(np.searchsorted(cut, offsets)) + 1
    firsts = np.zeros(len(offsets), np.int64)
    np.cumsum(per_row, out=firsts[1:])
    starts = np.empty(firsts[-1], np.int64)
    ends = np.empty(firsts[-1], np.int64)
    inner = np.ones(firsts[-1], bool)
    inner[firsts[:-1]] = False
    starts[firsts[:-1]] = offsets[:-1]
    starts[inner] = cut + 1
    last = np.zeros(firsts[-1], bool)
    last[firsts[1:] - 1] = True
    ends[last] = offsets[1:]
    ends[~last] = cut
    return starts, ends, firsts


def expand(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each group of the given sizes."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
