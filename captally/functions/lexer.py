"""STR-7: a longest-match lexer for captions in the style of the treebank tokenizer.

The rules below are compiled, when the module is loaded, into one transition
table over character classes.  The lexer walks the table over all distinct
white-space chunks of an Arrow batch in lockstep, one character a step: what
takes time is a NumPy step over many chunks, not a Python call per caption.

At every place the longest match wins, and of equally long ones the rule that
stands first.  A rule may ask that no letter or digit follows (``whole``), cut
its match in two tokens (``cut``), or yield no token (``drop``):

* ``cannot``, ``gonna`` and the like are two words, ``isn't`` is ``is n't``, ``man's`` is
  ``man 's``; other apostrophes inside a word stay (``o'clock``);
* web and mail addresses, numbers with inner ``. , :``, single letters with
  points (``u.s.``) and known abbreviations (``mr.``) are one token;
* words keep inner hyphens and ampersands (``well-known``, ``at&t``);
* quotes, brackets, dashes, ellipses and ``. , : ; ? !`` are dropped;
* any other visible character is a token (``$``, ``%``).

Not modelled: sentence ends after abbreviations, smileys, escaped brackets.
"""

from __future__ import annotations

import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from captally.functions.arrow_text import Tokens, expand, flat, gather, runs, spaces

# Words that are cut in two, suffixes that are cut off, and
# abbreviations that keep their point.
CUT_WORDS = ("can|not", "gon|na", "got|ta", "wan|na", "gim|me", "lem|me", "'t|is", "'t|was", "d'|ye", "more|'n")
SUFFIXES = ("n't", "'s", "'re", "'ve", "'ll", "'d", "'m")
ABBREVIATIONS = (
    "mr mrs ms dr prof st jr sr gen col sgt capt lt cmdr gov sen rep rev hon pres inc corp ltd bros ave blvd rd vs etc approx dept est "
    "al jan feb apr aug sept oct nov dec"
).split()
DROPPED = "?!;\"`()[]{}…–—“”„«»‘"

#: Characters with a class of their own, besides a-z; the other classes come before them.
MARKS = "'.,:-&@/_+?"
IN_ADDRESS = "=%#~$*"
END, SYMBOL, WIDE, DIGIT, ADDRESS, DROP = range(6)
LETTER_AT = 6
CLASS_OF = {c: LETTER_AT + i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz" + MARKS)}
N_CLASSES = LETTER_AT + len(CLASS_OF)
LETTERS = {CLASS_OF[c] for c in "abcdefghijklmnopqrstuvwxyz"}
ALNUM = {WIDE, DIGIT, *LETTERS}
FOLLOWS_WORD = np.zeros(N_CLASSES, bool)
FOLLOWS_WORD[list(ALNUM)] = True


def character_class(code: int) -> int:
    c = chr(code)
    if c in CLASS_OF:
        return CLASS_OF[c]
    if c.isascii() and c.isalnum():
        return DIGIT if c.isdigit() else WIDE
    if c in IN_ADDRESS:
        return ADDRESS
    if c in DROPPED:
        return DROP
    kind = unicodedata.category(c)
    if kind[0] in "LNM":
        return WIDE
    return END if kind[0] == "Z" or kind in ("Cc", "Cf", "Cs", "Co") else SYMBOL


ASCII_CLASSES = np.array([character_class(i) for i in range(128)], np.uint8)

# ---------------------------------------------------------------- rules
# A pattern is a set of classes, or ("seq" | "any", patterns...), ("some", pattern) or ("maybe", pattern).


def text(s: str):
    return ("seq", *({CLASS_OF[c]} for c in s))


def some(p):
    return ("some", p)


def maybe(p):
    return ("maybe", p)


def marks(s: str) -> set:
    return {CLASS_OF[c] for c in s}


LETTER = LETTERS
WORD = ("seq", some(ALNUM), maybe(some(("seq", marks("-&"), some(ALNUM)))), maybe(some(("seq", marks("'"), some(ALNUM)))))
NUMBER = ("seq", some({DIGIT}), some(("seq", marks(".,:"), some({DIGIT}))))
IN_URL = ALNUM | marks(".,:-&@/_+?") | {ADDRESS}


class Rule(NamedTuple):
    pattern: object
    cut: int = 0  # from the start (> 0) or the end (< 0) of the match
    whole: bool = False
    drop: bool = False


RULES = [
    *(Rule(text(w.replace("|", "")), cut=w.index("|"), whole=True) for w in CUT_WORDS),
    *(Rule(("seq", ("any", WORD, NUMBER), text(s)), cut=-len(s), whole=True) for s in SUFFIXES),
    Rule(text("'em"), whole=True),
    Rule(("seq", ("any", ("seq", text("http"), maybe(text("s")), text("://")), text("www.")), maybe(some(IN_URL)), ALNUM | marks("/"))),
    Rule(("seq", ALNUM, maybe(some(ALNUM | marks("._+-"))), marks("@"), some(ALNUM), some(("seq", marks("-."), some(ALNUM))))),
    Rule(("seq", some(("seq", LETTER, marks("."))), LETTER), whole=True),
    Rule(("seq", LETTER, marks("."), some(("seq", LETTER, marks("."))))),
    *(Rule(text(a + ".")) for a in ABBREVIATIONS),
    Rule(NUMBER),
    Rule(WORD),
    Rule(some(marks(".")), drop=True),
    Rule(some(marks("-")), drop=True),
    Rule({DROP, *marks("',:?")}, drop=True),
    Rule({SYMBOL, ADDRESS, *marks("&@/_+")}),
]


def transition_table(rules: list[Rule]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state x class -> state, rule accepted before a word character, rule accepted elsewhere); states 0 dead, 1 start."""
    moves: list[list[tuple]] = []

    def state() -> int:
        moves.append([])
        return len(moves) - 1

    def add(pattern, start: int) -> int:
        """Add the moves of ``pattern`` from ``start``; the state after it."""
        if isinstance(pattern, set):
            end = state()
            moves[start].append((pattern, end))
            return end
        kind, *parts = pattern
        if kind == "seq":
            for p in parts:
                start = add(p, start)
            return start
        end = state()
        if kind == "any":
            for p in parts:
                moves[add(p, start)].append((None, end))
            return end
        inner = state()
        moves[start].append((None, inner))
        moves[after := add(parts[0], inner)].append((None, end))
        if kind == "some":
            moves[after].append((None, inner))
        else:
            moves[start].append((None, end))
        return end

    first = state()
    accepts = {}
    for number, rule in enumerate(rules):
        entry = state()
        moves[first].append((None, entry))
        accepts[add(rule.pattern, entry)] = number

    def closure(states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for on, to in moves[todo.pop()]:
                if on is None and to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    known = {frozenset(): 0, closure({first}): 1}
    order = list(known)
    rows = []
    for states in order:  # grows while it is walked
        row = []
        for c in range(N_CLASSES):
            to = closure({t for s in states for on, t in moves[s] if on is not None and c in on})
            if to not in known:
                known[to] = len(known)
                order.append(to)
            row.append(known[to])
        rows.append(row)
    none = len(rules)
    inside = [min((accepts[s] for s in st if s in accepts and not rules[accepts[s]].whole), default=none) for st in order]
    ending = [min((accepts[s] for s in st if s in accepts), default=none) for st in order]
    return np.array(rows, np.int32), np.array(inside, np.int16), np.array(ending, np.int16)


TABLE, INSIDE, ENDING = transition_table(RULES)
CUT = np.array([r.cut for r in RULES])
DROPS = np.array([r.drop for r in RULES])

# ---------------------------------------------------------------- walking


def classes_of(codes: np.ndarray) -> np.ndarray:
    out = ASCII_CLASSES[np.minimum(codes, 127)]
    wide = codes > 127
    if wide.any():
        values, at = np.unique(codes[wide], return_inverse=True)
        out[wide] = np.array([character_class(int(v)) for v in values], np.uint8)[at]
    return out


def walk(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, rule) of every match; lanes begin at ``starts`` and end at the next END class."""
    none = len(RULES)
    begin = starts[classes[starts] != END]
    at, state = begin.copy(), np.ones(len(begin), np.int32)
    best_end, best = begin.copy(), np.full(len(begin), none, np.int16)
    found: list[tuple] = []
    while len(begin):
        state = TABLE[state, classes[at]]
        going = state != 0
        at = at + going
        rule = np.where(FOLLOWS_WORD[classes[at]], INSIDE[state], ENDING[state])
        hit = going & (rule != none)
        best_end = np.where(hit, at, best_end)
        best = np.where(hit, rule, best)
        done = ~going
        if done.any():
            found.append((begin[done], best_end[done], best[done]))
            begin = np.where(done, best_end, begin)
            at = np.where(done, best_end, at)
            state = np.where(done, 1, state)
            best = np.where(done, none, best)
            left = ~done | (classes[at] != END)
            if not left.all():
                begin, at, state, best_end, best = (x[left] for x in (begin, at, state, best_end, best))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z
    return tuple(np.concatenate(x) for x in zip(*found))


def lex_chunks(chunks: pa.Array) -> Tokens:
    """Tokens of distinct chunks without white space."""
    data, offsets = flat(chunks)
    # A space after each chunk ends its lane.
    size = np.diff(offsets)
    spread = np.full(len(data) + len(size), 0x20, np.uint8)
    spread[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data
    codes = np.frombuffer(spread.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    classes = classes_of(codes)
    bytes_at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF), out=bytes_at[1:])
    # Control characters end a lane too: every place after an END class begins one.
    begins = np.flatnonzero((classes != END) & np.append(True, classes[:-1] == END)) if len(classes) else np.zeros(0, np.int64)
    start, end, rule = walk(classes, begins)
    kept = ~DROPS[rule] if len(rule) else np.zeros(0, bool)
    start, end, cut = start[kept], end[kept], CUT[rule[kept]] if len(rule) else np.zeros(0, np.int64)
    middle = np.where(cut > 0, start + cut, end + cut)
    two = cut != 0
    starts = np.concatenate([start, middle[two]])
    ends = np.concatenate([np.where(two, middle, end), end[two]])
    order = np.argsort(starts, kind="stable")
    starts, ends = bytes_at[starts[order]], bytes_at[ends[order]]
    firsts = np.searchsorted(starts, offsets + np.arange(len(offsets)))
    return Tokens(gather(spread, starts, ends), firsts)


def lex(texts: pa.Array) -> Tokens:
    """Caption tokens of every row of lower-cased texts, as a dictionary-encoded column."""
    data, offsets = flat(texts)
    starts, ends, firsts = runs(~spaces(data), offsets)
    chunks = gather(data, starts, ends).dictionary_encode()
    ids = chunks.indices.to_numpy(zero_copy_only=False)
    lexed = lex_chunks(chunks.dictionary)
    counts = np.diff(lexed.ends)
    n = counts[ids]
    at = np.repeat(lexed.ends[:-1][ids], n) + expand(n)
    values = lexed.values.dictionary_encode()
    total = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=total[1:])
    indices = pc.take(values.indices, pa.array(at))
    return Tokens(pa.DictionaryArray.from_arrays(indices, values.dictionary), total[firsts])
