"""License scans: matching statistics of texts against a generalised suffix automaton of license words.

All templates stand in one automaton, parted by separators. A text's words are streamed through it: at
each word the longest stretch that ends there and occurs in any template is known. Stretches that can't
go on are matches; those of one template that follow each other in both sequences, with few words
between, are chained, and a chain that covers enough of its template marks a span. Where spans of
different templates overlap, the one with the most matched words stays.

Words are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case. Base
phrases are looked up word by word besides; their labels are always kept.

Nothing is shuffled; the automaton is built from the fixed templates in each task.

Edge cases: a null or empty text has no words, no labels and score 0; repeated rows are scanned alike; an
empty table gives no rows; texts of any length are streamed whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from creditframe.llm import _automaton, _text

# Phrases and labels that the scan's contract names.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices by which the licenses are usually granted, with their SPDX-like labels.
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "licensed under CC0 1.0"),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "licensed under CC BY-ND 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
]

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:long,end:long,covered:double>>"
)
_SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())])
)


@dataclass(frozen=True)
class Span:
    """Words ``start`` to ``end`` of a text cover this share of a template."""

    label: str
    start: int
    end: int
    matched: int
    covered: float


class Scanner:
    """Matching statistics of word numbers against all templates, and the chains in them."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str], covered: float, max_gap: int):
        self._covered, self._gap = covered, max_gap
        texts = [text for _, text in templates] + list(phrases)
        data, offsets = _text.flat(pa.array(texts, pa.string()))
        data = _text.lower(data)
        starts, ends, first = _text.words(data, offsets, _text.ALPHANUMERIC)
        self._vocabulary, ids = np.unique(_text.word_hashes(data, starts, ends), return_inverse=True)
        sequences = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        self._labels = [label for label, _ in templates]
        self._sizes = [len(x) for x in sequences[: len(templates)]]
        self._phrases = list(zip(phrases.values(), sequences[len(templates) :]))
        joined, self._place, pairs = [], [], set()
        for k, sequence in enumerate(sequences[: len(templates)]):
            joined += [*sequence, -1 - k]
            self._place += [(k, at) for at in range(len(sequence) + 1)]
            pairs |= set(zip(sequence, sequence[1:]))
        self._automaton = _automaton.build(joined)
        self._ends = self._automaton.ends()
        n = len(self._vocabulary)
        self._pairs = np.zeros(n * n, bool)
        self._pairs[[a * n + b for a, b in pairs]] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number in the templates' vocabulary, or -1."""
        at = np.minimum(np.searchsorted(self._vocabulary, hashes), len(self._vocabulary) - 1)
        return np.where(self._vocabulary[at] == hashes, at, -1)

    def base(self, numbers: np.ndarray, texts: np.ndarray) -> list[tuple[str, np.ndarray]]:
        """For each phrase its label and the places where it begins; ``texts`` tells which text a word is of."""
        out = []
        for label, phrase in self._phrases:
            n = max(len(numbers) - len(phrase) + 1, 0)
            here = texts[:n] == texts[len(phrase) - 1 : len(phrase) - 1 + n]
            for k, word in enumerate(phrase):
                here &= numbers[k : k + n] == word
            out.append((label, np.flatnonzero(here)))
        return out

    def candidates(self, numbers: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Places of words that some template has followed by the text's next word."""
        a, b = numbers[:-1], numbers[1:]
        here = (a >= 0) & (b >= 0) & (texts[:-1] == texts[1:])
        here[here] = self._pairs[a[here] * len(self._vocabulary) + b[here]]
        return np.flatnonzero(here)

    def matches(self, numbers: list[int], runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """(template, place in it, place in the text, length) of the stretches that can't be made longer.

        ``runs`` are the stretches in which each two neighbours occur in a template; no match of two or
        more words reaches beyond one.
        """
        step, link, length = self._automaton.step, self._automaton.link, self._automaton.length
        found = []
        for first, last in runs:
            state = n = 0
            for at in range(first, last + 1):
                word = numbers[at]
                if word not in step[state]:
                    self._note(found, state, n, at)
                    while state and word not in step[state]:
                        state = link[state]
                        n = length[state]
                state = step[state].get(word, 0)
                n = n + 1 if state else 0
            self._note(found, state, n, last + 1)
        return found

    def _note(self, found: list, state: int, n: int, at: int) -> None:
        if n >= 2:
            for end in self._ends[state]:
                template, place = self._place[end]
                found.append((template, place - n, at - n, n))

    def spans(self, found: list[tuple[int, int, int, int]]) -> list[Span]:
        """Chains that cover their template, without overlaps, in the text's order."""
        chains = []
        best: dict[int, list] = {}
        for template, place, at, n in sorted(found, key=lambda m: (m[2], -m[3], m[0], m[1])):
            open_ = [c for c in best.get(template, []) if at - c[2] <= self._gap]
            before = max((c for c in open_ if c[1] <= place and c[2] <= at), key=lambda c: c[3], default=None)
            chain = (before[0] if before else at, place + n, at + n, n + (before[3] if before else 0), template)
            best[template] = [*open_, chain]
            chains.append(chain)
        chosen: list[Span] = []  # in the text's order
        for start, _, end, matched, template in sorted(chains, key=lambda c: (-c[3], c[0], c[2], c[4])):
            share = matched / self._sizes[template]
            after = bisect_left(chosen, start, key=lambda s: s.start)
            free = (not after or chosen[after - 1].end <= start) and (after == len(chosen) or end <= chosen[after].start)
            if share >= self._covered and free:
                chosen.insert(after, Span(self._labels[template], start, end, matched, share))
        return chosen


def scan(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = BASE_PHRASES,
    covered: float = 0.8,
    max_gap: int = 4,
) -> DataFrame:
    """One row per document: counts of base phrases, all labels, and the covered spans in words.

    ``covered`` is the least share of a template's words that a chain matches, ``max_gap`` the most words
    of the text between two matches of a chain. ``score`` is the largest covered share, 1 for a base phrase.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases, covered, max_gap)
        for rows, data, offsets in _text.pieces(batches, "text"):
            data = _text.lower(data)
            starts, ends, first = _text.words(data, offsets, _text.ALPHANUMERIC)
            numbers = scanner.numbers(_text.word_hashes(data, starts, ends))
            texts = np.repeat(np.arange(rows.num_rows), np.diff(first))
            n = rows.num_rows
            counts, least, most = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base: dict[int, set[str]] = {}
            for label, places in scanner.base(numbers, texts):
                owner = texts[places]
                np.add.at(counts, owner, 1)
                np.minimum.at(least, owner, places - first[owner])
                np.maximum.at(most, owner, places - first[owner])
                for k in np.unique(owner).tolist():
                    base.setdefault(k, set()).add(label)
            spans: dict[int, list[Span]] = {}
            hits = scanner.candidates(numbers, texts)
            if len(hits):
                edges = np.flatnonzero(np.diff(hits) != 1) + 1
                parts = np.split(hits, edges)
                words = numbers.tolist()
                by_text: dict[int, list[tuple[int, int]]] = {}
                for part in parts:
                    by_text.setdefault(int(texts[part[0]]), []).append((int(part[0]), int(part[-1]) + 1))
                for k, runs in by_text.items():
                    if chosen := scanner.spans(scanner.matches(words, runs)):
                        spans[k] = chosen
            out = []
            for k, doc_id in enumerate(rows.column(0).to_pylist()):
                own, at = spans.get(k, []), int(first[k])
                names = base.get(k, set())
                found = int(counts[k])
                out.append(
                    (
                        doc_id,
                        int(first[k + 1]) - at,
                        found,
                        int(least[k]) if found else None,
                        int(most[k]) if found else None,
                        ",".join(sorted(names)),
                        ",".join(sorted(names | {s.label for s in own})),
                        min(1.0, max([1.0 if found else 0.0, *(s.covered for s in own)])),
                        [{"label": s.label, "start": s.start - at, "end": s.end - at, "covered": min(1.0, s.covered)} for s in own],
                    )
                )
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), _SPANS]
            names = [x.split()[0] for x in SCHEMA.split(", ")[:8]] + ["spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    needed = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return needed.mapInArrow(run, SCHEMA)
