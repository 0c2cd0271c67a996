"""License scan (operator 6).

Base labels are phrases whose words stand consecutively. Further labels come from a positional
index over the words of licence templates:

1. document frequencies of the template words over the whole corpus give their IDF;
2. the ``ANCHORS`` words of highest IDF of each template are looked up in every file;
3. occurrences are chained in the template's order; between two of them the text may have up to ``GAP`` words more than the
   template, or fewer, so that comment marks, line numbers and edits don't break a chain. ``MIN_VOTES`` anchors must agree;
4. the template is aligned with the words about the chain, and its key phrases must all stand there.

Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters. Null or empty texts
have no words, no labels and score 0. Each row is answered by itself.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import words

# fixed values: phrases of the base labels
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# label -> (wording, key phrases that must stand in it)
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License Version 2.0 the License you may not use this file except in "
                   "compliance with the License", ["apache license", "version 2 0"]),
    "mit": ("Permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the Software to deal in the Software without restriction",
            ["permission is hereby granted free of charge", "without restriction"]),
    "mit-short": ("Licensed under the MIT License", ["mit license"]),
    "apache-short": ("Licensed under the Apache License", ["apache license"]),
    "bsd": ("Redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use", "source and binary forms"]),
    "isc": ("Permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["with or without fee"]),
    "gpl-notice": ("This program is free software you can redistribute it and or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation",
                   ["free software", "gnu general public license"]),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License v 2 0",
                ["mozilla public license"]),
    "cc-by-nc": ("Licensed under CC BY NC 4 0", ["cc by nc"]),
    "cc-by-sa": ("Licensed under CC BY SA 4 0", ["cc by sa"]),
    "cc-by-nd": ("Licensed under CC BY ND 4 0", ["cc by nd"]),
    "cc-by-4.0": ("Licensed under CC BY 4 0", ["cc by 4 0"]),
    "cc0": ("This work is dedicated to the public domain under CC0 1 0", ["cc0"]),
    "unlicense": ("This is free and unencumbered software released into the public domain",
                  ["unencumbered software", "public domain"]),
}
ANCHORS = 6
MIN_VOTES = 2
GAP = 12            # words that may be set in between two anchors
MIN_ALIGNED = 0.6   # share of a template's words found in its order


def _template_words() -> dict[str, list[bytes]]:
    return {label: words(text) for label, (text, _) in TEMPLATES.items()}


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of documents holding each template word: as many rows as there are
    template words, summed over all documents."""
    vocab = {w for ws in _template_words().values() for w in ws}

    def count(batches):
        seen = Counter()
        for b in batches:
            for t in b.column("text"):
                seen[b""] += 1
                seen.update(vocab.intersection(words(t.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long") \
               .groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"].encode(): r["n"] for r in rows}
    return found.pop(b"", 0), found


class TemplateIndex:
    """Postings (label, position) of the anchor words."""

    def __init__(self, n_docs: int, frequency: dict[bytes, int]):
        self.templates = _template_words()
        self.keys = {label: [b" " + b" ".join(words(k)) + b" " for k in keys] for label, (_, keys) in TEMPLATES.items()}
        self.postings: dict[bytes, list[tuple[str, int]]] = defaultdict(list)
        self.needed = {}
        idf = lambda w: math.log((n_docs + 1) / (frequency.get(w, 0) + 1))
        for label, ws in self.templates.items():
            anchors = sorted(set(ws), key=lambda w: (-idf(w), w))[:ANCHORS]
            self.needed[label] = min(MIN_VOTES, len(anchors))
            for pos, w in enumerate(ws):
                if w in anchors:
                    self.postings[w].append((label, pos))
        self.anchors = set(self.postings)

    def labels(self, ws: list[bytes]) -> dict[str, float]:
        """Label -> aligned share of its template."""
        hits = self.anchors.intersection(ws)
        if not hits:
            return {}
        placed = defaultdict(list)      # label -> (place in the text, place in the template)
        for at, w in enumerate(ws):
            if w in hits:
                for label, pos in self.postings[w]:
                    placed[label].append((at, pos))
        found = {}
        for label, points in placed.items():
            for lo, hi in self._chains(label, points):
                share = self._aligned(label, ws[max(0, lo):hi])
                if share >= MIN_ALIGNED and share > found.get(label, 0):
                    found[label] = share
        return found

    def _chains(self, label: str, points: list[tuple[int, int]]):
        """(from, to) in the text about each longest chain of enough anchors."""
        size, open_ = len(self.templates[label]), deque()     # (at, pos, anchors, from), those near enough to go on
        best = None
        for at, pos in points:
            while open_ and at - open_[0][0] > size + GAP:
                open_.popleft()
            n, start = 1, at - pos
            for at0, pos0, n0, start0 in open_:
                if pos0 < pos and at0 < at and at - at0 <= pos - pos0 + GAP and n0 + 1 > n:
                    n, start = n0 + 1, start0
            open_.append((at, pos, n, start))
            if n >= self.needed[label]:
                if best and (at > best[1] + GAP or start > best[1]):
                    yield best[0] - GAP, best[1] + GAP
                    best = None
                end = at + size - pos
                best = (min(best[0], start), max(best[1], end)) if best else (start, end)
        if best:
            yield best[0] - GAP, best[1] + GAP

    def _aligned(self, label: str, window: list[bytes]) -> float:
        """Share of the template's words that stand in the window in order (longest common subsequence); 0 without all key phrases."""
        joined = b" " + b" ".join(window) + b" "
        if not all(k in joined for k in self.keys[label]):
            return 0.0
        places = defaultdict(list)
        for k in range(len(window) - 1, -1, -1):
            places[window[k]].append(k)
        ends: list[int] = []
        for w in self.templates[label]:
            for k in places.get(w, ()):
                i = bisect_left(ends, k)
                ends[i:i + 1] = [k]
        return len(ends) / len(self.templates[label])


def base_places(ws: list[bytes]) -> list[tuple[int, str]]:
    """(start word, label) of every place of a base phrase, in order."""
    joined = b" " + b" ".join(ws) + b" "
    out = []
    for phrase, label in BASE_PHRASES.items():
        needle = b" " + phrase.encode() + b" "
        at, before, last = joined.find(needle), 0, 0
        while at >= 0:
            before, last = before + joined.count(b" ", last, at), at
            out.append((before, label))
            at = joined.find(needle, at + 1)
    return sorted(out)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: words, base places, labels, score."""
    index = TemplateIndex(*document_frequencies(docs))

    def run(batches):
        for b in batches:
            out = []
            for t in b.column("text"):
                ws = words(t.as_py())
                base = base_places(ws)
                more = index.labels(ws)
                own = sorted({label for _, label in base})
                out.append((len(ws), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                            ",".join(own), ",".join(sorted({*own, *more})),
                            1.0 if own else max(more.values(), default=0.0)))
            cols = list(zip(*out)) if out else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(cols, types))],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                              "labels", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double")
