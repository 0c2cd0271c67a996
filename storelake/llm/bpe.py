"""Byte-level BPE encoding and decoding (operator 2).

Pieces are encoded in padded matrices, one per length bucket. In each round every row merges its
leftmost pair of minimum rank and the finished rows leave the matrix. Pair ranks come from an
open-addressing table over (left id, right id). A row shrinks by one id per round, so a matrix of
width L takes at most L - 1 rounds. Pieces above ``MAX_WIDTH`` bytes are encoded one at a time,
merging all places of the minimum pair per round, with the same result.

Each worker remembers the ids of the chunks it has met (text between blanks); the memory is bounded.

Null texts count as empty: no ids, the digest of the empty string. Each row is answered by itself.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import grouped

MAX_WIDTH = 256
CACHE_ENTRIES = 150_000
CACHE_CHARS = 48            # longer chunks are not remembered

_NONE = np.int32(2**31 - 1)
# white space other than blank and line feed; str.split and the expression differ on some of them
_ODD_SPACE = [chr(c) for c in (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                               0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


class PairTable:
    """(left id, right id) -> id of the merged token, by hashing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = self._keys(left, right)
        self.bits = max(4, int(4 * len(keys) + 1).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            free = self.keys[slot[todo]] == -1
            tried = todo[free]
            self.keys[slot[tried]] = keys[tried]
            won = self.keys[slot[tried]] == keys[tried]
            self.values[slot[tried[won]]] = merged[tried[won]]
            todo = np.concatenate([todo[~free], tried[~won]])
            slot[todo] = (slot[todo] + 1) & (size - 1)
            self.probes += 1

    @staticmethod
    def _keys(left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys):
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``_NONE`` where there is no such pair; negative ids are padding."""
        keys = self._keys(left, right)
        slot = self._slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], _NONE)
        out[(left < 0) | (right < 0)] = _NONE
        open_ = np.flatnonzero((at != keys) & (at != -1) & (left >= 0) & (right >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return out


class ByteBPE:
    """Encoder and decoder for a ranks file, with the piece expression of its vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocab = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.vocab[i] = token
        self.names = [str(i) for i in range(len(self.vocab))]
        self.dtype = np.uint16 if len(self.vocab) <= 1 << 16 else np.uint32
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(i)
        self.pairs = PairTable(*(np.array(x, np.int32) for x in (left, right, merged)))
        # \s of the public library is the Unicode property; this library's own is wider
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.cache: dict[str, bytes] = {}

    # pieces -> ids

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        lens = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < lens[:, None], self.byte_ids[raw], -1).astype(np.int32)
        out: list[np.ndarray] = [None] * len(pieces)
        rows = np.arange(len(pieces))
        rank = self.pairs.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), -1)
        while len(rows):
            width = ids.shape[1]
            if width == 1:
                for r, x in zip(rows, ids):
                    out[r] = x[x >= 0]
                break
            at = rank.argmin(1)     # the first of equal minima: the leftmost pair
            low = rank[np.arange(len(rows)), at]
            live = low < _NONE
            for r, x in zip(rows[~live], ids[~live]):
                out[r] = x[x >= 0]
            rows, ids, rank, at, low = rows[live], ids[live], rank[live], at[live], low[live]
            if not len(rows):
                break
            n = np.arange(len(rows))
            ids[n, at] = low
            cols = np.arange(width - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
            cols = np.arange(width - 2)
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
            for side in (at - 1, at):   # the two pairs that hold the new id
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                rank[ok, side[ok]] = self.pairs.look_up(ids[ok, side[ok]], ids[ok, side[ok] + 1])
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        rank = self.pairs.look_up(ids[:-1], ids[1:])
        while len(rank) and (low := rank.min()) < _NONE:
            at = np.flatnonzero(rank == low)
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, at, 0))
            at = at[(at - run) % 2 == 0]
            merged, after = self._merge(ids, at, low)
            if len(at) > 1 and len(after) and after.min() < low:   # a new pair goes before the rest
                merged, after = self._merge(ids, at[:1], low)
            ids, rank = merged, after
        return ids

    def _merge(self, ids, at, low):
        ids = ids.copy()
        ids[at] = low
        ids = np.delete(ids, at + 1)
        return ids, self.pairs.look_up(ids[:-1], ids[1:])

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) > MAX_WIDTH:
                out[i] = self._long(p)
            else:
                buckets.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            step = max(1, 1_000_000 // width)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                for i, ids in zip(part, self._matrix([pieces[r] for r in part], width)):
                    out[i] = ids
        return out

    # texts -> ids

    def _chunks(self, text: str) -> list[str]:
        """Parts of a text that are encoded separately: a blank between two characters that are
        not white space starts a new piece, and so does a line feed between such characters."""
        if ("  " in text or " \n" in text or "\n " in text or "\n\n" in text
                or any(c in text for c in _ODD_SPACE)):
            return self.pieces.findall(text)
        out = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append("\n")
            first, *rest = line.split(" ")
            if first:
                out.append(first)
            out += [" " + w for w in rest]
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        chunks = [self._chunks(t) for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        new = list(set().union(*chunks).difference(self.cache))
        pieces = [self.pieces.findall(c) for c in new]
        parts = list({p for ps in pieces for p in ps}.difference(self.cache))
        known = dict(zip(parts, (x.astype(self.dtype).tobytes()
                                 for x in self.encode_pieces([p.encode("utf-8", "replace") for p in parts]))))
        cache = self.cache
        get = lambda p: known[p] if p in known else cache[p]
        cache.update((p, x) for p, x in known.items() if len(p) <= CACHE_CHARS)
        passing = {}
        for c, ps in zip(new, pieces):
            (cache if len(c) <= CACHE_CHARS else passing)[c] = b"".join(map(get, ps))
        for cs in chunks:
            if passing:
                ids = b"".join([cache[c] if c in cache else passing[c] for c in cs])
            else:
                ids = b"".join(map(cache.__getitem__, cs))
            yield np.frombuffer(ids, self.dtype)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


@functools.cache
def load(path: str, pattern: str) -> ByteBPE:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return ByteBPE(ranks, pattern)


def vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    """The given vocabulary file and expression, or the public ones."""
    if path is None or pattern is None:
        import public_tokenizers
        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    return path, pattern


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every text."""
    where = vocabulary(path, pattern)

    def run(batches):
        bpe = load(*where)
        for b in batches:
            got = [x.astype(np.int32) for part in grouped(b.column("text").to_pylist()) for x in bpe.encode(part)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _ids_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def encode_report(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes decoded from them."""
    where = vocabulary(path, pattern)

    def run(batches):
        bpe = load(*where)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for part in grouped(b.column("text").to_pylist()):
                for x in bpe.encode(part):
                    ids = x.tolist()
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(bpe.names.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _ids_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
