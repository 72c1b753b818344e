"""License scan: exact set-similarity join of text blocks with notice templates.

A block is a run of words, wherever its lines break, that begins and ends with
words of a template and is at most ``spread`` times as long as the template.
Block and template are compared as sets of words; a pair matches if the block
contains at least ``threshold`` of the template's words.  Words are put in one
global order, rarest in the whole corpus first, and three filters keep the join
exact and small:

* prefix: a match holds one of the first ``|T| - o + 1`` words of the template,
  ``o`` being the overlap needed, so texts without any such rare word are never
  looked at and a template only in texts that hold one of its own;
* length: a text with fewer than ``o`` different words of the template cannot
  match it, nor can a block of fewer than ``o`` places of them;
* position: words of the template before the rarest one that the text holds
  are missing, so the rest of the template must reach ``o``.

The order comes from a first pass over all documents, in which Spark adds up
the partial counts of the tasks.  Only words of the templates are counted, as
no other can add to an overlap, so the counts have the size of the templates.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import columns_of, plain_words, scan_texts, sliced

#: Phrases whose words, standing consecutively, give a base label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("proprietary", "All rights reserved. No part of this work may be reproduced without permission"),
)
THRESHOLD = 0.8
#: Longest block, as a multiple of the number of different words of its template.
SPREAD = 2


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]  # in the global order
    needed: int

    @property
    def prefix(self) -> tuple[bytes, ...]:
        return self.words[: len(self.words) - self.needed + 1]


class TemplateIndex:
    """Inverted index over the prefixes of the templates."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: Mapping[bytes, int], threshold: float):
        words = [(label, set(plain_words(text.encode()))) for label, text in templates]
        universe = sorted(set().union(*[w for _, w in words]), key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(universe)}
        self.templates = [
            Template(label, tuple(sorted(w, key=self.rank.__getitem__)), max(1, math.ceil(threshold * len(w) - 1e-9)))
            for label, w in words
            if w
        ]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(self.templates):
            for place, word in enumerate(template.prefix):
                self.postings[word].append((t, place))

    def blocks(self, words: list[bytes], spread: int = SPREAD) -> list[tuple[int, int, int, float]]:
        """(template, first word, last word, containment) of the matching blocks, one after the other for each template.

        Of blocks that begin inside the first one that matches, the one that
        contains most counts, and of equal ones the shortest.
        """
        places: dict[bytes, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            if word in self.rank:
                places[word].append(i)
        chosen: dict[int, int] = {}  # template -> place of its rarest word here
        for word in places:
            for t, place in self.postings.get(word, ()):
                chosen[t] = min(place, chosen.get(t, place))
        found = []
        for t, place in chosen.items():
            template = self.templates[t]
            size, needed = len(template.words), template.needed
            held = [w for w in template.words[place:] if w in places]
            if size - place < needed or len(held) < needed:  # position, length
                continue
            own = sorted((i, k) for k, w in enumerate(held) for i in places[w])
            found += [(t, *block) for block in _windows(own, spread * size, needed, size)]
        return found


def _windows(own: list[tuple[int, int]], width: int, needed: int, size: int) -> Iterator[tuple[int, int, float]]:
    """Matching blocks in order, (first place, last place, containment), from the sorted (place, word) pairs of a template."""
    distinct, counts, right = [], Counter(), 0  # different words in the window that begins at each place
    for first, word in own:
        while right < len(own) and own[right][0] < first + width:
            counts[own[right][1]] += 1
            right += 1
        distinct.append(len(counts))
        counts[word] -= 1
        if not counts[word]:
            del counts[word]

    def end(i: int) -> int:
        """Where the block that begins at the i-th place has all of its different words."""
        seen: set[int] = set()
        while len(seen) < distinct[begin]:
            seen.add(own[i][1])
            i += 1
        return own[i - 1][0]

    begin = i = 0
    while i < len(own):
        begin = i
        if distinct[i] < needed:
            i += 1
            continue
        reach, best = end(i), (-distinct[i], end(i) - own[i][0], own[i][0], end(i))
        while i < len(own) and own[i][0] <= reach:
            begin = i
            best = min(best, (-distinct[i], end(i) - own[i][0], own[i][0], end(i)))
            i += 1
        n, _, first, last = best
        yield first, last, -n / size
        i = next((k for k in range(i, len(own)) if own[k][0] > last), len(own))


def word_counts(docs: DataFrame, universe: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Occurrences in all documents of the given words; the result has one row per word at most."""
    source = docs.select(docs[f"`{text_col}`"].alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for whole in batches:
            for batch in sliced(whole):
                for text in batch.column(0).cast(pa.binary()).to_pylist():
                    if text:
                        counts.update(filter(universe.__contains__, plain_words(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    rows = source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"].encode(): r["n"] for r in rows}


def phrase_starts(words: list[bytes], phrases: Mapping[bytes, str]) -> list[tuple[int, str]]:
    """(word index, label) of all places of the phrases."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        needle = b" " + phrase + b" "
        at, index, counted = joined.find(needle), 0, 0
        while at >= 0:
            index += joined.count(b" ", counted, at)
            counted = at
            out.append((index, label))
            at = joined.find(needle, at + 1)
    return out


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    spread: int = SPREAD,
) -> DataFrame:
    """Append license findings of whole texts.

    ``n_words``; ``places``, an array of (word, label) of the phrases by word;
    ``blocks``, an array of (label, line, lines, word, words, containment) of
    the matching text blocks, lines and words from 0.  A null text has no words and no findings.
    Two passes over the texts, no shuffle of documents.  ``templates`` is a
    fixed list of the caller and goes to every task.
    """
    universe = {w for _, text in templates for w in plain_words(text.encode())}
    counts = word_counts(docs, universe, text_col)
    coded = {b" ".join(plain_words(p.encode())): label for p, label in phrases.items()}
    fields = (
        "n_words bigint, places array<struct<word:bigint,label:string>>, "
        "blocks array<struct<label:string,line:bigint,lines:bigint,word:bigint,words:bigint,containment:double>>"
    )

    def make() -> Callable:
        index = TemplateIndex(templates, counts, threshold)
        rare = set(index.postings)
        last_words = {p.split()[-1] for p in coded}

        def one(text: bytes | None) -> tuple:
            words = plain_words(text or b"")
            places = [] if last_words.isdisjoint(words) else sorted(phrase_starts(words, coded))
            blocks = [] if rare.isdisjoint(words) else index.blocks(words, spread)
            ends = list(accumulate(len(plain_words(line)) for line in text.split(b"\n"))) if blocks else []
            return (
                len(words),
                [{"word": w, "label": label} for w, label in places],
                [
                    {
                        "label": index.templates[t].label, "line": bisect_right(ends, first),
                        "lines": bisect_right(ends, last) - bisect_right(ends, first) + 1,
                        "word": first, "words": last - first + 1, "containment": share,
                    }
                    for t, first, last, share in sorted(blocks, key=lambda b: (b[1], b[2], b[0]))
                ],
            )

        return lambda texts: columns_of([one(t) for t in texts], 3)

    return scan_texts(docs, fields, make, text_col, keep)
