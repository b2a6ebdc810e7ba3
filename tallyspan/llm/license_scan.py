"""License scans with a generalised suffix automaton over the words of license templates.

The automaton reads a text word by word and always knows its longest match:
the longest run of words ending here that occurs in some template (the matching
statistic). Matches of ``MIN_MATCH`` words and more are chained per template,
in the order of both text and template, into spans; a template that a chain
covers to ``MIN_COVER`` gives its label. The base phrases are templates too:
one occurs where the automaton's match ends with the whole phrase.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.texts import byte_texts, plain_words, slices

MIN_MATCH = 4
MIN_COVER = 0.5
MAX_GAP = 30
TEMPLATE_WORDS = 1_000_000  # most words of all templates together; the automaton is broadcast

# Phrases whose every occurrence counts, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of widely used public license notices, and their labels.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
]


class Automaton:
    """A generalised suffix automaton over word numbers, with all templates' places of each state."""

    def __init__(self, templates: list[tuple[str, list[bytes]]], phrases: list[tuple[str, list[bytes]]]):
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [words for _, words in templates] + [words for _, words in phrases]
        if sum(map(len, texts)) > TEMPLATE_WORDS:
            raise ValueError(f"templates hold more than {TEMPLATE_WORDS} words")
        self.labels = [label for label, _ in templates]
        self.sizes = [len(words) for _, words in templates]
        at: list[dict[int, int]] = []  # of each state, where it first ends in each template
        for k, words in enumerate(texts):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, self.words.setdefault(word, len(self.words) + 1))
                while len(at) < len(self.next):
                    at.append({})
                if k < len(templates):
                    at[last].setdefault(k, i + 1)
        while len(at) < len(self.next):
            at.append({})
        # what ends at a state also ends at the shorter states that it links to
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            for k, i in at[state].items():
                up = at[self.link[state]]
                up[k] = min(up.get(k, i), i)
        self.at = at
        # the phrases that a match at a state ends with, if it is long enough
        own: dict[int, list[tuple[int, str]]] = {}
        for label, words in phrases:
            state = 0
            for word in words:
                state = self.next[state][self.words[word]]
            own.setdefault(state, []).append((len(words), label))
        self.ends: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for state in sorted(range(len(self.next)), key=lambda s: self.length[s]):
            above = self.ends[self.link[state]] if state else []
            self.ends[state] = above + own.get(state, [])

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state of the length after p's for what p reads by c, apart from the longer q."""
        twin = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def scan(self, words: list[bytes]):
        """The phrases' (start, label) places, and the maximal matches (start, length, state) of MIN_MATCH words."""
        get = self.words.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        known = np.flatnonzero(ids)
        step, link, length, ends = self.next, self.link, self.length, self.ends
        bases: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []
        state = size = 0
        before = -1
        for i, c in zip(known.tolist(), ids[known].tolist(), strict=True):
            if i != before + 1 or c not in step[state]:
                if size >= MIN_MATCH:
                    matches.append((before + 1 - size, size, state))
                if i != before + 1:
                    state = size = 0
                while state and c not in step[state]:
                    state = link[state]
                    size = length[state]
            state = step[state].get(c, 0)
            size = size + 1 if state else 0
            before = i
            if size:
                for n, label in ends[state]:
                    if n <= size:
                        bases.append((i + 1 - n, label))
        if size >= MIN_MATCH:
            matches.append((before + 1 - size, size, state))
        return bases, matches

    def chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Per template and chain: its label, first word, word after its last one, and share of the template."""
        chains: list[tuple[str, int, int, float]] = []
        open_: dict[int, list[int]] = {}  # template: first word, end in text, end in template, words covered

        def close(k):
            first, end, _, covered = open_.pop(k)
            chains.append((self.labels[k], first, end, min(1.0, covered / self.sizes[k])))

        for start, size, state in matches:
            end = start + size
            for k, at in self.at[state].items():
                if (chain := open_.get(k)) is not None:
                    new = min(end - chain[1], at - chain[2])
                    if start <= chain[1] + MAX_GAP and new > 0:
                        open_[k] = [chain[0], end, at, chain[3] + min(size, new)]
                        continue
                    close(k)
                open_[k] = [start, end, at, size]
        for k in list(open_):
            close(k)
        return chains


def automaton(templates=None, phrases=None) -> Automaton:
    """The automaton of (label, text) templates and of phrases with their labels."""
    split = lambda text: plain_words(text.encode())
    return Automaton(
        [(label, words) for label, text in (TEMPLATES if templates is None else templates) if (words := split(text))],
        [(label, words) for text, label in (PHRASES if phrases is None else phrases).items() if (words := split(text))],
    )


FOUND = [
    ("n_words", pa.int64(), "BIGINT"),
    ("n_base", pa.int64(), "BIGINT"),
    ("first_word", pa.int64(), "BIGINT"),
    ("last_word", pa.int64(), "BIGINT"),
    ("base_labels", pa.string(), "STRING"),
    ("labels", pa.string(), "STRING"),
    ("score", pa.float64(), "DOUBLE"),
    (
        "spans",
        pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])),
        "ARRAY<STRUCT<label: STRING, start: BIGINT, end: BIGINT, cover: DOUBLE>>",
    ),
]


def scan_licenses(docs: DataFrame, templates=None, phrases=None, min_cover: float = MIN_COVER) -> DataFrame:
    """Per row of ``docs``: the phrases' places, labels, and the template spans found.

    ``spans`` are the chains that cover ``min_cover`` of a template, ``labels``
    those of the spans and phrases, ``score`` the largest share of a template or
    phrase that the text holds (1 with a phrase, 0 with nothing). Every row
    gives a row, repeated ones too; null and empty texts have no words. Texts
    stream through the automaton, which is all a task keeps. Other columns are
    ignored.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # plain values only, since workers unpickle them without this package
    known = {"templates": templates, "phrases": phrases}
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def task(batches):
        known = shared.value
        if "built" not in known:  # once in each worker
            known["built"] = automaton(known["templates"], known["phrases"])
        machine = known["built"]
        for batch in slices(batches):
            rows = []
            for text in byte_texts(batch):
                words = plain_words(text)
                bases, matches = machine.scan(words)
                chains = machine.chain(matches)
                spans = [c for c in chains if c[3] >= min_cover]
                base = {label for _, label in bases}
                starts = [at for at, _ in bases]
                rows.append(
                    (
                        len(words),
                        len(bases),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | {c[0] for c in spans})),
                        1.0 if bases else max((c[3] for c in chains), default=0.0),
                        [dict(zip(("label", "start", "end", "cover"), c, strict=True)) for c in spans],
                    )
                )
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(list(values), kind) for values, (_, kind, _) in zip(columns, FOUND, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], names=["doc_id", *(name for name, _, _ in FOUND)]
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(task, ", ".join([f"doc_id {kind}", *(f"{name} {sql}" for name, _, sql in FOUND)]))
