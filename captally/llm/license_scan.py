"""License scans by template-markup matching.

Templates are written in a small markup: ``[[ ... ]]`` is an optional region,
``{{lo-hi}}`` a replaceable region of lo to hi words, ``{{a|b}}`` one of some
words; everything else is mandatory wording.  Each template is compiled into
a token automaton whose states remember how much of the wording was seen; a
text gets the template's label where the automaton accepts a run of its words,
so the mandatory wording must be there exactly, in order.

Every whole text is tokenised once, in vectorised batches.  Automata only run
in texts that hold all of a template's mandatory words, and only from words
that can begin it; both are necessary conditions, so nothing is missed.

Base phrases are looked for in every text besides; their labels always stay.

Defined results: null and empty texts have no words, no labels, score 0 and
null places; repeated rows are scanned alike; an empty table gives an empty
result.  ``score`` is 0 without a label, 0.5 with base labels only, and
otherwise the largest share of a template's wording (optional included) found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from captally.llm.text_batches import ALNUM_WORD, LOWER, TextHasher, map_texts, row_of, word_spans

# Base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Templates of license notices, from the public license texts.
TEMPLATES = {
    "apache-2.0": "[[this {{0-3}} is]] {{licensed|released|distributed}} under the [[terms of the]] apache license [[version 2 0]]",
    "apache-2.0-notice": "licensed under the apache license version 2 0 the license you may not use {{1-4}} except in compliance with the license",
    "mit": "{{released|licensed|distributed|available}} under the [[terms of the]] mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software [[and associated documentation files the software]] to deal in the software without restriction",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "bsd": "{{released|licensed|distributed|available}} under [[the terms of]] [[{{a|the}}]] {{0-2}} bsd {{0-2}} license",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl-3.0": "[[this {{0-3}} is]] {{licensed|released|distributed}} under the [[terms of the]] gnu general public license [[as published by the free software foundation]] [[either]] version 3",
    "gpl-2.0": "[[this {{0-3}} is]] {{licensed|released|distributed}} under the [[terms of the]] gnu general public license [[as published by the free software foundation]] [[either]] version 2",
    "gpl-notice": "you can redistribute it and or modify it under the terms of the gnu [[{{lesser|affero}}]] general public license as published by the free software foundation",
    "lgpl": "gnu {{lesser|library}} general public license [[version {{1-2}}]]",
    "agpl": "gnu affero general public license [[version 3]]",
    "mpl-2.0": "subject to the terms of the mozilla public license [[v]] [[version]] 2 0",
    "cc-by-4.0": "{{licensed|released|available}} under [[{{a|the}}]] [[creative commons]] [[attribution]] cc by 4 0",
    "cc-by-sa": "{{licensed|released|available}} under [[{{a|the}}]] [[creative commons]] cc by sa [[{{1-2}}]]",
    "cc-by-nc": "{{licensed|released|available}} under [[{{a|the}}]] [[creative commons]] cc by nc [[4 0]]",
    "cc-by-nd": "{{licensed|released|available}} under [[{{a|the}}]] [[creative commons]] cc by nd [[4 0]]",
    "cc-by-text": "creative commons attribution [[{{0-2}}]] 4 0 international [[public]] license",
    "cc0": "creative commons [[cc0]] {{zero|universal|1}} [[1 0]] [[universal]] public domain dedication",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "proprietary": "all rights reserved [[worldwide]] [[no part of this {{1-3}} may be]] {{reproduced|unauthorized|confidential|proprietary}}",
    "spdx-apache-2.0": "spdx license identifier apache 2 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-gpl": "spdx license identifier {{gpl|lgpl|agpl}} {{1-2}}",
    "spdx-bsd": "spdx license identifier bsd {{1-2}} clause",
}


class TokenAutomaton:
    """Nondeterministic automaton of one template over words."""

    def __init__(self, template: str) -> None:
        self.words: list[dict[str, int]] = [{}]
        self.any: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        self.mandatory: set[str] = set()
        self.wording = 0
        opened: list[int] = []
        for unit in template.replace("[[", " [[ ").replace("]]", " ]] ").split():
            if unit == "[[":
                opened.append(self._state())
            elif unit == "]]":
                self.free[opened.pop()].append(self._state())
            elif unit.startswith("{{") and unit[2].isdigit() and "-" in unit:
                lo, hi = map(int, unit[2:-2].split("-"))
                skips = []
                for i in range(hi):
                    if i >= lo:
                        skips.append(len(self.words) - 1)
                    self.any[-1] = len(self.words)
                    self._new()
                for s in skips:
                    self.free[s].append(len(self.words) - 1)
            else:
                choices = unit.strip("{}").split("|")
                for w in choices:
                    self.words[-1][w] = len(self.words)
                self._new()
                self.wording += 1
                if len(choices) == 1 and not opened:
                    self.mandatory.add(unit)
        self.last = len(self.words) - 1
        self.first = {w for s in self._closed({0: 0}) for w in self.words[s]}

    def _new(self) -> int:
        self.words.append({})
        self.any.append(None)
        self.free.append([])
        return len(self.words) - 1

    def _state(self) -> int:
        """A fresh state reached freely from the current one, so regions do not share states."""
        old = len(self.words) - 1
        self.free[old].append(self._new())
        return len(self.words) - 1

    def _closed(self, active: dict[int, int]) -> dict[int, int]:
        todo = list(active)
        while todo:
            s = todo.pop()
            for t in self.free[s]:
                if active.get(t, -1) < active[s]:
                    active[t] = active[s]
                    todo.append(t)
        return active

    def longest(self, words: list[str | None]) -> tuple[int, float] | None:
        """(words used, share of the wording seen) of the longest accepted run from the start of ``words``."""
        active, found = self._closed({0: 0}), None
        for n, w in enumerate(words, 1):
            following: dict[int, int] = {}
            for s, seen in active.items():
                if w in self.words[s]:
                    t = self.words[s][w]
                    following[t] = max(following.get(t, -1), seen + 1)
                if self.any[s] is not None:
                    following[self.any[s]] = max(following.get(self.any[s], -1), seen)
            if not following:
                break
            active = self._closed(following)
            if self.last in active:
                found = (n, active[self.last] / self.wording)
        return found

    @property
    def most_words(self) -> int:
        return len(self.words)


FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_base", T.LongType(), False),
    T.StructField("first_word", T.LongType(), True),
    T.StructField("last_word", T.LongType(), True),
    T.StructField("base_labels", T.StringType(), False),
    T.StructField("labels", T.StringType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("matches", T.StringType(), False),
]


def _scanner(templates: dict[str, str], phrases: dict[str, str]):
    def make():
        automata = {label: TokenAutomaton(t) for label, t in templates.items()}
        known = sorted({w for a in automata.values() for s in a.words for w in s} | {w for p in phrases for w in p.split()})
        data = np.frombuffer("".join(known).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in known])
        hasher = TextHasher()
        hashes = hasher.load(data).spans(ends - [len(w.encode()) for w in known], ends)
        order = np.argsort(hashes)
        hashes, known = hashes[order], [known[i] for i in order]
        number = {w: i for i, w in enumerate(known)}
        needs = {label: np.array([number[w] for w in a.mandatory]) for label, a in automata.items()}
        firsts_of = {label: np.array([number[w] for w in a.first]) for label, a in automata.items()}

        def scan(data, offsets):
            n = len(offsets) - 1
            low = LOWER[data]
            starts, ends, firsts = word_spans(low, offsets, ALNUM_WORD)
            h = hasher.load(low).spans(starts, ends)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            ids = np.where(hashes[at] == h, at, -1)
            row = row_of(firsts, len(starts))

            # Base phrases: every place.
            n_base = np.zeros(n, np.int64)
            first_word, last_word = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base_labels: list[set] = [set() for _ in range(n)]
            for phrase, label in phrases.items():
                words = [number[w] for w in phrase.split()]
                m = len(ids) - len(words) + 1
                if m <= 0:
                    continue
                hit = row[:m] == row[len(words) - 1 :]
                for j, w in enumerate(words):
                    hit &= ids[j : j + m] == w
                place = np.flatnonzero(hit)
                rows, inside = row[place], place - firsts[row[place]]
                np.add.at(n_base, rows, 1)
                np.minimum.at(first_word, rows, inside)
                np.maximum.at(last_word, rows, inside)
                for r in np.unique(rows):
                    base_labels[r].add(label)

            # Templates: only rows with all mandatory words.
            has = np.zeros((n, len(known)), bool)
            seen = ids >= 0
            has[row[seen], ids[seen]] = True
            labels = [set(x) for x in base_labels]
            score = np.array([0.5 if x else 0.0 for x in labels])
            matches: list[list] = [[] for _ in range(n)]
            for label, automaton in automata.items():
                rows = np.flatnonzero(has[:, needs[label]].all(axis=1))
                for r in rows:
                    mine = ids[firsts[r] : firsts[r + 1]]
                    upto = 0
                    for p in np.flatnonzero(np.isin(mine, firsts_of[label])):
                        if p < upto:
                            continue
                        words = [known[i] if i >= 0 else None for i in mine[p : p + automaton.most_words]]
                        if found := automaton.longest(words):
                            upto = p + found[0]
                            labels[r].add(label)
                            score[r] = max(score[r], found[1])
                            matches[r].append(f"{label}:{p}:{upto}")
            none = n_base == 0
            return [
                np.diff(firsts).astype(np.int64),
                n_base,
                pa.array(first_word, pa.int64(), mask=none),
                pa.array(last_word, pa.int64(), mask=none),
                pa.array([",".join(sorted(x)) for x in base_labels]),
                pa.array([",".join(sorted(x)) for x in labels]),
                score,
                pa.array([",".join(x) for x in matches], pa.string()),
            ]

        return scan

    return make


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """doc_id, n_words, base places, labels, score and ``matches`` (label:first word:end word) of every document."""
    return map_texts(docs.select("doc_id", "text"), "text", ["doc_id"], FIELDS, _scanner(templates, phrases))
