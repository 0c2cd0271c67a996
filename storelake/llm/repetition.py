"""Quality rules by repetition coverage (operator 11).

Texts of a batch are one stream of word numbers. Windows of n words carry a rolling hash, H(n+1) = H(n) * BASE +
next word, so each length extends the one before. Windows of equal hash within a text are sorted together
and compared word by word, so a collision of hashes counts nothing. A window can only repeat at n + 1 words if it
repeats at n: each length looks only at what the length before left. Words inside such windows are covered;
coverage is measured in code points of words. Of 2 to 4 words, the most frequent window is measured, all
its places; of 5 to 10 words, all windows that stand earlier in the text. Lines equal to an earlier one are
measured likewise.

A text is kept unless it fails the base rules (too few words; more than half of its words in repeated
three-word windows), a coverage exceeds its share in ``TOP_SHARE``, ``REPEAT_SHARE`` or ``LINE_SHARE``, all per
cent of the text's word characters (lines: also of its lines that hold a word), or its symbols exceed
``SYMBOL_SHARE`` per cent of its words.

Null texts count as empty: all counts 0, base_failed. Each row is answered by itself, also when ids repeat or
are null; further columns are ignored. An empty table gives an empty result. A text is held in memory whole,
with some 100 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import grouped

BATCH_CHARS = 1_000_000
MIN_WORDS = 50
REPEAT_WORDS = 3                                   # window of the base rule
# fixed values: the published shares, in per cent, above which a text is judged repetitive
TOP_SHARE = {2: 20, 3: 18, 4: 16}                  # characters in the most frequent window of n words
REPEAT_SHARE = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}    # characters in windows seen before
LINE_SHARE = {"lines": 30, "chars": 20}
SYMBOL_SHARE = 10

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"


def _flags(of: bytes) -> np.ndarray:
    return np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(of, np.uint8))


_IS_SPACE, _IS_SYMBOL = _flags(_SPACE), _flags(_SYMBOLS)
_IS_START = (np.arange(256) & 0xC0) != 0x80        # first byte of a code point


def _numbers(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Equal byte ranges get equal numbers. Ranges are in order and apart."""
    edge = np.zeros(len(data) + 1, np.int8)
    np.add.at(edge, start, 1)
    np.add.at(edge, stop, -1)
    inside = data[np.cumsum(edge[:-1]) > 0]
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    ranges = pa.Array.from_buffers(pa.large_binary(), len(start),
                                   [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(inside.tobytes())])
    return ranges.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xDABA0B6EB09322E3)
    return x ^ (x >> np.uint64(29))


def _runs(key: np.ndarray, same) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``key`` and, in that order, the number of the run of equal items; ``same(x, y)`` says which
    neighbours of equal key are really equal."""
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    equal[equal] = same(order[1:][equal], order[:-1][equal])
    return order, np.cumsum(np.concatenate([[0], ~equal])) if len(order) else order


class Words:
    """The words of several texts, their lines, and what repeats within each text."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        self.n_texts = len(texts)
        text_end = np.cumsum([len(r) + 1 for r in raw])
        space = _IS_SPACE[data]
        word_edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        start, stop = word_edge[::2], word_edge[1::2]
        self.text = np.searchsorted(text_end, start, side="right")
        points = np.concatenate([[0], np.cumsum(_IS_START[data] & ~space)])
        self.chars = points[stop] - points[start]
        self.word = _numbers(data, start, stop)
        self.n_words = np.bincount(self.text, minlength=self.n_texts)
        self.word_chars = self._sum(self.chars)
        symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data])])
        self.n_symbols = symbols[text_end] - symbols[text_end - [len(r) + 1 for r in raw]]
        self.last = np.cumsum(self.n_words)[self.text]       # where the words of the own text end
        self._lines(data, points, text_end, start)

    def _sum(self, x: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
        where = self.text if where is None else where
        return np.bincount(where, weights=x, minlength=self.n_texts).astype(np.int64)

    def _lines(self, data, points, text_end, word_start):
        stop = np.flatnonzero(data == 10)                    # the joining line feeds end the last lines
        start = np.concatenate([[0], stop[:-1] + 1])
        held = np.searchsorted(word_start, stop) > np.searchsorted(word_start, start)
        start, stop = start[held], stop[held]
        text = np.searchsorted(text_end, start, side="right")
        chars = points[stop] - points[start]
        # (text, line): repeats of a line in one text stand together, the first one first
        number = _numbers(data, start, stop) if len(start) else start
        _, first = np.unique(text * (len(number) + 1) + number, return_index=True)
        again = np.ones(len(number), bool)
        again[first] = False
        self.n_lines = np.bincount(text, minlength=self.n_texts)
        self.n_dup_lines = np.bincount(text[again], minlength=self.n_texts)
        self.dup_line_chars = self._sum(chars[again], text[again])

    def repeats(self, longest: int):
        """For n = 2, 3, ... ``longest``: (n, starts of the windows found twice or more in their text, a number that
        equal windows share, whether an equal one stands before)."""
        mixed = _mixed(self.word)
        at, h = np.arange(len(self.word)), _mixed(self.text * np.int64(2**32)) * _BASE + mixed
        for n in range(2, longest + 1):
            inside = at + n <= self.last[at]
            at = at[inside]
            h = h[inside] * _BASE + mixed[at + n - 1]

            def same(x, y, at=at, n=n):
                x, y = at[x], at[y]
                ok = self.text[x] == self.text[y]
                for k in range(n):
                    ok &= self.word[x + k] == self.word[y + k]
                return ok

            order, run = _runs(h, same)
            twice = np.bincount(run, minlength=1)[run] > 1 if len(run) else np.zeros(0, bool)
            first = np.concatenate([[True], run[1:] != run[:-1]])[twice] if len(run) else twice
            kept = order[twice]                              # the sort is stable: a run's first place comes first
            by_place = np.argsort(at[kept])
            at, h = at[kept][by_place], h[kept][by_place]
            yield n, at, run[twice][by_place], ~first[by_place]

    def covered(self, at: np.ndarray, n: int) -> np.ndarray:
        """Which words stand in one of the windows of ``n`` words from ``at`` on."""
        edge = np.zeros(len(self.word) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        return np.cumsum(edge[:-1]) > 0

    def top_chars(self, at: np.ndarray, copy: np.ndarray, n: int) -> np.ndarray:
        """Characters of the repeated window that has the most of them in each text, all its copies together."""
        if not len(at):
            return np.zeros(self.n_texts, np.int64)
        upto = np.concatenate([[0], np.cumsum(self.chars)])
        _, run = np.unique(copy, return_inverse=True)
        total = np.bincount(run, weights=upto[at + n] - upto[at]).astype(np.int64)
        out = np.zeros(self.n_texts, np.int64)
        np.maximum.at(out, self.text[at], total[run])
        return out


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """The counts of every text; the columns of :func:`quality_rules` but doc_id."""
    w = Words(texts)
    out = {"n_words": w.n_words, "word_chars": w.word_chars, "n_symbols": w.n_symbols, "n_dup_lines": w.n_dup_lines,
           "n_repeat_words": np.zeros(len(texts), np.int64), "n_lines": w.n_lines, "dup_line_chars": w.dup_line_chars}
    kept = 100 * w.n_symbols <= SYMBOL_SHARE * w.n_words
    kept &= (100 * w.n_dup_lines <= LINE_SHARE["lines"] * w.n_lines) & (100 * w.dup_line_chars <= LINE_SHARE["chars"] * w.word_chars)
    for n, at, copy, seen in w.repeats(max(REPEAT_SHARE)):
        if n == REPEAT_WORDS:
            out["n_repeat_words"] = w._sum(w.covered(at, n))
        if n in TOP_SHARE:
            out[f"top_{n}_chars"] = w.top_chars(at, copy, n)
            kept &= 100 * out[f"top_{n}_chars"] <= TOP_SHARE[n] * w.word_chars
        if n in REPEAT_SHARE:
            out[f"dup_{n}_chars"] = w._sum(w.chars * w.covered(at[seen], n))
            kept &= 100 * out[f"dup_{n}_chars"] <= REPEAT_SHARE[n] * w.word_chars
    out["base_failed"] = (w.n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * w.n_words)
    out["kept"] = kept & ~out["base_failed"]
    return out


LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars",
         *(f"top_{n}_chars" for n in TOP_SHARE), *(f"dup_{n}_chars" for n in REPEAT_SHARE)]
FLAGS = ["base_failed", "kept"]


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per document the counts of the rules and the verdict."""
    def run(batches):
        for b in batches:
            ids, at = b.column("doc_id"), 0
            for part in grouped(b.column("text").to_pylist(), BATCH_CHARS):
                m = measure(part)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), *(pa.array(m[c], pa.int64()) for c in LONGS), *(pa.array(m[c], pa.bool_()) for c in FLAGS)],
                    ["doc_id", *LONGS, *FLAGS])
                at += len(part)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return narrow.mapInArrow(run, ", ".join(["doc_id long", *(f"{c} long" for c in LONGS), *(f"{c} boolean" for c in FLAGS)]))
