"""Benchmark decontamination by greedy string tiling (operator 3).

Seeds are ``MIN_MATCH`` consecutive words shared by a document and a benchmark item, found by
Karp-Rabin hashes of the word ids. Seeds on one diagonal that follow each other make a match; tiling
marks the longest match whose words are unmarked on both sides, cuts what is left of the others, and
goes on until no match of ``MIN_MATCH`` words remains. An item is found in a document when the
tiles cover at least ``COVERAGE`` of its words, in whatever order they stand.

The benchmark goes to the tasks in blocks of at most about ``BLOCK_WORDS`` words; documents are
scanned once a block and never shuffled. The result has a row per (document, item) found.

Null or empty texts hold nothing. Items without words are never found; items of fewer than
``MIN_MATCH`` words are found where all their words stand in a row. Repeated items are all reported.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import grouped, words

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_WORDS = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every window of n ids, modulo 2 ** 64."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        out = out * _BASE + ids[k:k + len(out)]
    return out


def tile(doc: np.ndarray, item: np.ndarray, pairs: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (doc start, item start, length) of the tiles, from the seeds' places."""
    heap = []
    diagonals = defaultdict(list)
    for i, j in pairs:
        diagonals[i - j].append(i)
    for d, starts in diagonals.items():
        starts = np.unique(starts)
        cut = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
        for lo, hi in zip(cut, [*cut[1:], len(starts)]):
            i, n = int(starts[lo]), int(hi - lo) + least - 1
            if np.array_equal(doc[i:i + n], item[i - d:i - d + n]):     # equal hashes may differ in words
                heap.append((-n, i - d, i))
    heapq.heapify(heap)
    used_doc, used_item, tiles = np.zeros(len(doc), bool), np.zeros(len(item), bool), []
    while heap:
        n, j, i = heapq.heappop(heap)
        n = -n
        free = ~(used_doc[i:i + n] | used_item[j:j + n])
        if free.all():
            used_doc[i:i + n] = used_item[j:j + n] = True
            tiles.append((i, j, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if hi - lo >= least:
                heapq.heappush(heap, (lo - hi, j + lo, i + lo))
    return tiles


class Benchmark:
    """Seeds of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(item_id, words(text)) for item_id, text in items]
        self.vocab = {w: k for k, w in enumerate(sorted({w for _, ws in split for w in ws}), 1)}
        self.items = [(item_id, np.array([self.vocab[w] for w in ws], np.uint64)) for item_id, ws in split if ws]
        postings = defaultdict(lambda: defaultdict(list))   # seed length -> hash -> (item, place)
        for k, (_, ids) in enumerate(self.items):
            n = min(MIN_MATCH, len(ids))
            for j, h in enumerate(rolling(ids, n).tolist()):
                postings[n][h].append((k, j))
        self.postings = {n: dict(p) for n, p in postings.items()}
        self.hashes = {n: np.array(sorted(p), np.uint64) for n, p in postings.items()}

    def search_all(self, texts: list[str | None]) -> Iterator[list[tuple[int, float, int, int]]]:
        for part in grouped(texts):
            yield from self.search(part)

    def search(self, texts: list[str]) -> Iterator[list[tuple[int, float, int, int]]]:
        """Per text the items found: (item id, coverage, tiles, longest tile)."""
        get = self.vocab.get
        docs = [np.fromiter((get(w, 0) for w in words(t)), np.uint64) for t in texts]
        ends = np.cumsum([len(d) for d in docs])
        flat = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        seeds = defaultdict(list)      # (doc, item) -> places
        for n, known in self.hashes.items():
            if len(flat) < n:
                continue
            outside = np.cumsum(np.concatenate([[0], flat == 0]))
            at = np.flatnonzero((outside[n:] == outside[:-n]) & (owner[n - 1:] == owner[:len(owner) - n + 1]))
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h = h * _BASE + flat[at + k]
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[place] == h
            for p, x in zip(at[hit].tolist(), h[hit].tolist()):
                d = int(owner[p])
                i = p - (int(ends[d - 1]) if d else 0)
                for k, j in self.postings[n][x]:
                    seeds[d, k].append((i, j))
        found = defaultdict(list)
        for (d, k), pairs in seeds.items():
            item_id, item = self.items[k]
            if len({j for _, j in pairs}) + (MIN_MATCH - 1) * len(pairs) < COVERAGE * len(item):
                continue    # even apart, these seeds can't cover enough
            tiles = tile(docs[d], item, pairs, min(MIN_MATCH, len(item)))
            share = sum(n for _, _, n in tiles) / len(item)
            if share >= COVERAGE:
                found[d].append((item_id, share, len(tiles), max(n for _, _, n in tiles)))
        for d in range(len(docs)):
            yield sorted(found.get(d, []))


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of about ``BLOCK_WORDS`` words, by a hash of their id."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
                     .filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-total // BLOCK_WORDS))
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        if rows:
            yield [(r["item_id"], r["text"]) for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest) of every item found in a document."""
    schema = "doc_id long, item_id long, coverage double, n_tiles int, longest int"
    types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
    names = ["doc_id", "item_id", "coverage", "n_tiles", "longest"]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scan(items):
        def run(batches):
            bench = Benchmark(items)
            for b in batches:
                rows = [(d, *hit) for d, hits in zip(b.column("doc_id").to_pylist(),
                                                     bench.search_all(b.column("text").to_pylist())) for hit in hits]
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)
        return source.mapInArrow(run, schema)

    parts = [scan(items) for items in blocks(benchmark)]
    out = parts[0] if parts else source.sparkSession.createDataFrame([], schema)
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, columns as before."""
    out = docs
    for items in blocks(benchmark):
        out = out.filter(~_leaks(items)("text"))
    return out


def _leaks(items):
    held = []

    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(Benchmark(items))
        return pd.Series([bool(x) for x in held[0].search_all(texts.tolist())], dtype=bool)
    return leaks
