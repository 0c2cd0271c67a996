"""Token ids in binary shards with keyed access (operator 5).

Documents are tokenized, range-partitioned by ``doc_id`` and written in ascending order, one file a
shard, in the shared folder:

    payload     ids of all documents of the shard, back to back, little-endian, 2 or 4 bytes an id
    index       per slot of a minimal perfect hash: fingerprint (u4), length (u4), payload offset (u8)
    bits, ranks bit array of the hash's levels and the number of set bits before each 64-bit word
    footer      JSON with the places of the parts; its length (u4) and the magic close the file

The hash takes (doc_id, ordinal) to its slot by a cascade of bit arrays: a key owns its bit on the
first level where no other key falls on it, and its slot is the number of set bits before. A lookup
reads one bit per level, one rank, one index entry and the document's own ids. A stored fingerprint
tells keys that aren't in the shard.

A manifest has one row a shard; the ids before a shard are the sum over the shards before it.

Null texts count as empty and get the end id alone. A null ``doc_id`` sorts first and is stored
under the smallest 64-bit integer. Rows with equal ``doc_id`` are stored in the order of their ids'
hash and told apart by their ordinal.
"""

from __future__ import annotations

import functools
import json
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.common import grouped, stored, text_or_empty
from storelake.session import scratch_path

END_ID = 1
SHARD_BYTES = 32 << 20      # text bytes a shard aims at
GAMMA = 2.0                 # bits per key on each level
MAX_LEVELS = 64
CACHE_ENTRIES = 500_000
CACHE_CHARS = 48
JOINED = 64                 # chunks encoded together
MAGIC = b"IDSHARD1"
_NO_ID = -(1 << 63)


# tokenizing

class ChunkTokenizer:
    """The public tokenizer behind a bounded memory of chunks.

    Its pieces never span white space, so chunks between blanks are encoded separately. It lower-cases
    letter by letter, so texts of Latin-1 characters, where that changes no other character, are
    lower-cased first and share their chunks. Strings of added tokens have their own ids. A Latin-1 chunk that ends in a letter or digit and one
    mark falls into these two pieces.
    """

    MARKS = frozenset(".,;:!?")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.cache: dict[str, bytes] = {}
        # characters of a byte-level entry are bytes; the mark of a word's end is none of them
        self.lengths = np.zeros(self.tok.get_vocab_size(), np.int64)
        for entry, i in self.tok.get_vocab().items():
            self.lengths[i] = len(entry.removesuffix("</w>"))

    def _marked(self, chunk: str) -> bool:
        return chunk[-1:] in self.MARKS and chunk[-2:-1].isalnum() and (chunk.isascii() or max(chunk) < "\u0100")

    def _folded(self, text: str) -> str:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        low = text.lower()
        # an added token counts as written, so one in capitals must not become one
        return text if any(t in low and low.count(t) != text.count(t) for t in self.special) else low

    def encode(self, texts: list[str]) -> list[bytes]:
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        chunks = [self._folded(t).replace("\n", " ").split(" ") for t in texts]
        new = set().union(*chunks).difference(cache)
        marked = [c for c in new if self._marked(c)]
        todo = list(new.difference(marked).union(c[:-1] for c in marked).union(c[-1] for c in marked).difference(cache))
        self._learn(todo)
        for c in marked:
            cache[c] = cache[c[:-1]] + cache[c[-1]]
        out = [b"".join(map(cache.__getitem__, cs)) for cs in chunks]
        for c in new.union(todo):
            if len(c) > CACHE_CHARS:
                del cache[c]
        return out


    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks and remember their ids. Lower-case Latin-1 chunks are encoded ``JOINED`` at a time with a blank between
        them; the lengths of the tokens tell where each ends, and a group that doesn't come out even is done chunk by chunk."""
        plain = [c for c in chunks if c and c.isalnum() and c.islower() and (c.isascii() or max(c) < "\u0100")]
        groups = [plain[k:k + JOINED] for k in range(0, len(plain), JOINED)]
        single = list(set(chunks).difference(plain))
        size = self.dtype.itemsize
        for g, e in zip(groups, self.tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum([len(c.encode()) for c in g])
            cut = np.searchsorted(ends, want)
            if len(ends) and ends[-1] == want[-1] and (ends[cut] == want).all():
                data, at = ids.tobytes(), [0, *(size * (cut + 1)).tolist()]
                self.cache.update(zip(g, [data[i:j] for i, j in zip(at, at[1:])]))
            else:
                single += g
        for c, e in zip(single, self.tok.encode_batch_fast(single, add_special_tokens=False)):
            self.cache[c] = array(self.code, e.ids).tobytes()


@functools.cache
def tokenizer(path: str) -> ChunkTokenizer:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallel part
    return ChunkTokenizer(path)


# minimal perfect hash

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_keys(doc_ids: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
    return _mix(_mix(doc_ids.astype(np.int64).view(np.uint64), 1) + ordinals.astype(np.uint64), 2)


class PerfectHash:
    """Slots 0..n-1 for n distinct 64-bit keys."""

    def __init__(self, sizes: list[int], words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys
        while len(left):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            m = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            at = (_mix(left, 100 + len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m), bits.append(alone)
            left = left[~alone[at]]
        words = np.packbits(np.concatenate(bits) if bits else np.zeros(0, bool), bitorder="little").view("<u8")
        count = np.bitwise_count(words).astype(np.int64)
        return cls(sizes, words, (np.cumsum(count) - count).astype("<u4"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; some slot or -1 for a key that isn't stored."""
        out, base, open_ = np.full(len(keys), -1, np.int64), 0, np.arange(len(keys))
        for level, m in enumerate(self.sizes):
            bit = base + (_mix(keys[open_], 100 + level) % np.uint64(m)).astype(np.int64)
            word, place = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> place) & np.uint64(1) == 1
            before = np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
            out[open_[hit]] = self.ranks[bit[hit] >> 6] + before[hit]
            open_, base = open_[~hit], base + m
        return out


# files

def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (pafs.LocalFileSystem(), path)


class ShardWriter:
    """Appends documents to one shard file; the file appears under its name when it is complete, so
    a repeated or lost attempt leaves no half file."""

    def __init__(self, path: str, dtype: np.dtype):
        self.fs, self.path = _file_system(path)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out, self.dtype = self.fs.open_output_stream(self.temp), dtype
        self.ids, self.ordinals, self.lens = [], [], []

    def add(self, doc_id: int, ids: bytes) -> None:
        again = bool(self.ids) and self.ids[-1] == doc_id
        self.ordinals.append(self.ordinals[-1] + 1 if again else 0)
        self.ids.append(doc_id)
        self.lens.append(len(ids) // self.dtype.itemsize)
        self.out.write(ids)

    def close(self) -> dict:
        lens = np.array(self.lens, np.int64)
        keys = hash_keys(np.array(self.ids, np.int64), np.array(self.ordinals, np.int64))
        mph = PerfectHash.build(keys)
        index = np.zeros(len(keys), [("fp", "<u4"), ("n", "<u4"), ("at", "<u8")])
        slot = mph.slots(keys)
        index["fp"][slot] = (keys >> np.uint64(32)).astype(np.uint32)
        index["n"][slot] = lens
        index["at"][slot] = np.cumsum(lens) - lens
        total = int(lens.sum())
        at = total * self.dtype.itemsize
        foot = {"dtype": self.dtype.str, "docs": len(keys), "ids": total, "sizes": mph.sizes,
                "index": at, "words": at + index.nbytes, "ranks": at + index.nbytes + mph.words.nbytes}
        tail = json.dumps(foot).encode()
        for part in (index.tobytes(), mph.words.tobytes(), mph.ranks.tobytes(), tail, np.array([len(tail)], "<u4").tobytes(), MAGIC):
            self.out.write(part)
        self.out.close()
        self.fs.move(self.temp, self.path)
        return foot


class ShardReader:
    """Keyed access to one shard file."""

    def __init__(self, path: str):
        fs, path = _file_system(path)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        end = self._at(size - 12, 12)
        if end[4:] != MAGIC:
            raise ValueError(f"{path} is not a shard")
        n = int(np.frombuffer(end[:4], "<u4")[0])
        foot = json.loads(self._at(size - 12 - n, n))
        self.dtype, self.docs, self.ids = np.dtype(foot["dtype"]), foot["docs"], foot["ids"]
        words = sum(foot["sizes"]) // 64
        self.index = np.frombuffer(self._at(foot["index"], 16 * self.docs), [("fp", "<u4"), ("n", "<u4"), ("at", "<u8")])
        self.mph = PerfectHash(foot["sizes"], np.frombuffer(self._at(foot["words"], 8 * words), "<u8"),
                               np.frombuffer(self._at(foot["ranks"], 4 * words), "<u4"))

    def _at(self, offset: int, n: int) -> bytes:
        return self.file.read_at(n, offset) if n else b""

    def find(self, doc_ids: np.ndarray, ordinals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset in ids and number of ids of each key; the number is -1 where a key isn't stored."""
        keys = hash_keys(doc_ids, ordinals)
        slot = self.mph.slots(keys)
        if not self.docs:
            return np.zeros(len(keys), np.int64), np.full(len(keys), -1)
        entry = self.index[np.maximum(slot, 0)]
        ok = (slot >= 0) & (entry["fp"] == (keys >> np.uint64(32)).astype(np.uint32))
        return entry["at"].astype(np.int64), np.where(ok, entry["n"].astype(np.int64), -1)

    def read(self, offset: int, n: int) -> np.ndarray:
        w = self.dtype.itemsize
        return np.frombuffer(self._at(int(offset) * w, int(n) * w), self.dtype)

    def close(self) -> None:
        self.file.close()


# Spark jobs

def _key():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key")


def _bounds(docs: DataFrame, shard_bytes: int) -> list[int]:
    """Largest key of every shard but the last; a few numbers per shard."""
    total = docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    n = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // shard_bytes))
    at = [i / n for i in range(1, n)]
    got = docs.select(_key()).select(F.percentile_approx("key", at, 100 * n).alias("q")).first()["q"]
    return sorted(set(got or []))


def write_store(docs: DataFrame, folder: str, path: str, end_id: int = END_ID,
                shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, list[int]]:
    """Write the shards; returns the manifest (shard, path, docs, ids, before) and the bounds."""
    bounds = _bounds(docs, shard_bytes)

    def encode(batches):
        tok = tokenizer(path)
        end = np.array([end_id], tok.dtype).tobytes()
        for b in batches:
            ids = [x + end for part in grouped(b.column("text").to_pylist()) for x in tok.encode(part)]
            shard = np.searchsorted(np.array(bounds, np.int64), b.column("key").to_numpy(), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column("key"), pa.array(ids, pa.binary())],
                                             ["shard", "key", "ids"])

    def write(batches):
        writer, shard, rows = None, None, []

        def done():
            foot = writer.close()
            rows.append((shard, f"{folder}/{shard:06d}.ids", foot["docs"], foot["ids"]))

        for b in batches:
            shards, keys, ids = (b.column(i) for i in range(3))
            for s, k, x in zip(shards.to_pylist(), keys.to_pylist(), ids):
                if s != shard:
                    if writer:
                        done()
                    shard, writer = s, ShardWriter(f"{folder}/{s:06d}.ids", tokenizer(path).dtype)
                writer.add(k, x.as_py())
        if writer:
            done()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
            zip(*rows) if rows else [[]] * 4, [pa.int32(), pa.string(), pa.int64(), pa.int64()])],
            ["shard", "path", "docs", "ids"])

    coded = docs.select(_key(), F.col("text").cast("string").alias("text")) \
                .mapInArrow(encode, "shard int, key long, ids binary")
    files = coded.repartitionById(len(bounds) + 1, F.col("shard")) \
                 .sortWithinPartitions("shard", "key", F.xxhash64("ids"), "ids") \
                 .mapInArrow(write, "shard int, path string, docs long, ids long")
    manifest = stored(files, "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0))), bounds


def read_store(keys: DataFrame, manifest: DataFrame, bounds: list[int]) -> DataFrame:
    """Look up (key, ordinal) rows in the shards: key, start, n_tokens, ids_crc32."""
    def place(batches):
        for b in batches:
            shard = np.searchsorted(np.array(bounds, np.int64), b.column("key").to_numpy(), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column("key"), b.column("ordinal")],
                                             ["shard", "key", "ordinal"])

    def look_up(batches):
        reader, at = None, None
        for b in batches:
            shards = b.column("shard").to_numpy()
            cut = np.flatnonzero(np.diff(shards, prepend=-1))
            for lo, hi in zip(cut, [*cut[1:], len(shards)]):
                path = b.column("path")[int(lo)].as_py()
                if path != at:
                    if reader:
                        reader.close()
                    reader, at = ShardReader(path), path
                part = b.slice(lo, hi - lo)
                keys, before = part.column("key").to_numpy(), part.column("before").to_numpy()
                offset, n = reader.find(keys, part.column("ordinal").to_numpy())
                if (n < 0).any():
                    raise KeyError(f"{at} lacks {keys[n < 0][:3].tolist()}")
                crc = [zlib.crc32(reader.read(o, m).astype("<u4").tobytes()) for o, m in zip(offset, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(before + offset), pa.array(n), pa.array(crc, pa.int64())],
                    ["key", "start", "n_tokens", "ids_crc32"])
        if reader:
            reader.close()

    placed = keys.mapInArrow(place, "shard int, key long, ordinal int").join(
        F.broadcast(manifest.select("shard", "path", "before")), "shard")     # one row a shard
    return placed.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "ordinal") \
                 .mapInArrow(look_up, "key long, start long, n_tokens long, ids_crc32 long")


def store_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents, then read each back by its key."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    manifest, bounds = write_store(docs, scratch_path(docs.sparkSession, "token-shards"), path)
    counted = docs.groupBy(_key()).count()
    keys = counted.select("key", F.explode(F.sequence(F.lit(0), (F.col("count") - 1).cast("int"))).alias("ordinal"))
    found = read_store(keys, manifest, bounds)
    return found.select(F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"), "start", "n_tokens", "ids_crc32")
