"""Cross-tokenizer alignment (operator 13): byte ranges of two tokenizations cut into common groups.

The token ends of both sides are merged along the merge path. Diagonals every ``PIECE`` steps cut the
path into pieces of equal work; a binary search on each diagonal finds where its piece begins on both
sides, so the pieces need nothing from each other. Each piece walks its own steps and emits the overlaps
it meets and the places where both sides end; a group that runs over a cut gets its number from the
running sum of the pieces' closed groups. All pieces of a batch of texts step together in numpy, so
one huge text is as many pieces as many small ones.

How many documents hold an id pair is counted over the corpus: every task keeps a dictionary of the
pairs it has met, with their documents, in blocks of at most about ``BLOCK_PAIRS`` pairs. Texts refer
to places in their block's dictionary. The dictionaries, not the texts, are summed and joined with the
sums, and each block's texts meet their own answered dictionary in one sorted pass.

Texts that are null, empty, or whose tokens' bytes don't join to a blank and the text on both sides have no
tokens: zeros and an empty digest. Each row is a document by itself, also when ids repeat or are
null. Further columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.session import scratch_path

PIECE = 256                 # merged ends a piece walks
BATCH_CHARS = 500_000       # texts aligned together
CACHE_ENTRIES = 150_000     # chunks remembered, twice as many and a batch more at most
CACHE_CHARS = 64            # longer chunks are not
JOINED = 64                 # chunks encoded together
CUT = re.compile(r"(?<=\S) (?!\Z)")
BLOCK_PAIRS = 200_000       # pairs in a block's dictionary, one batch more at most
PART = 4096                 # dictionary entries in a row
ROW_GROUP = 16 << 20

_FAR = np.int64(2**62)


def path_starts(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` stand among the first ``d`` merged ends, for every diagonal ``d``; equal ends
    take ``a`` first. One binary search per diagonal, all in step."""
    lo, hi = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        before = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.maximum(diagonals - 1 - mid, 0)])
        lo = np.where(before, mid + 1, lo)
        hi = np.where(open_ & ~before, mid, hi)
    return lo


def merge_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """Overlaps and groups of two rising lists of ends that cover the same bytes.

    Returns the overlapping places (``left`` in a, ``right`` in b, in order), and the group
    of every token of a and of b.
    """
    n = len(a) + len(b)
    cuts = np.arange(0, n, piece)
    i = path_starts(a, b, cuts)
    j = cuts - i
    steps = np.minimum(cuts + piece, n) - cuts
    a_end, b_end = np.append(a, _FAR), np.append(b, _FAR)
    shape = (piece, len(cuts))
    at_a, at_b, kind = np.zeros(shape, np.int32), np.zeros(shape, np.int32), np.zeros(shape, np.int8)
    for step in range(piece if n else 0):
        live = step < steps
        x, y = a_end[i], b_end[j]
        take_a = live & (x <= y)
        take_b = live & ~take_a
        closing = take_b & (i > 0) & (a_end[i - 1] == y)      # the a of equal end went first
        at_a[step], at_b[step] = i, j
        kind[step] = take_a + 2 * take_b + closing            # 0 none, 1 an end of a, 2 of b, 3 of both
        i, j = i + take_a, j + take_b
    at_a, at_b, kind = at_a.T.ravel(), at_b.T.ravel(), kind.T
    closed = kind == 3
    per_piece = closed.sum(1)
    group = np.cumsum(closed, 1) - closed + (np.cumsum(per_piece) - per_piece)[:, None]
    kind, group = kind.ravel(), group.ravel()
    linked = (kind == 1) | (kind == 2)
    return at_a[linked], at_b[linked], group[kind == 1], group[kind >= 2]


class Tokenizers:
    """Both libraries' encoders with the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark's cores are dealt to tasks
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.by_chunk = _cuts_at_blanks(self.a, self.b)
        # ids of both sides of chunks met lately, and of those met before them
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.older: dict[str, tuple[bytes, bytes] | None] = {}
        self.a_bytes = _byte_level(self.a)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # ids as text, followed by what separates them in a group digest
        self.a_text = [np.array([f"{k}{end}".encode() for k in range(len(self.a_bytes))], object) for end in ",|"]
        self.b_text = [np.array([f"{k}{end}".encode() for k in range(len(self.b_bytes))], object) for end in ",;"]

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(re.fullmatch("<0x(..)>", piece)[1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for every text; none where a side's bytes don't join to blank + text.

        Where both sides cut before a blank that follows no white space, texts are encoded by such chunks, and
        chunks met before are remembered up to a bound; those that come again outlast the others."""
        chunks = [CUT.split(t) for t in texts] if self.by_chunk else [[t] for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        known = self.known
        asked = {c for parts in chunks for c in parts} - known.keys() - {""}
        again = asked & self.older.keys()
        known.update((c, self.older[c]) for c in again)
        new = list(asked - again)
        if self.by_chunk:
            # chunks that end in white space may not stand before another
            whole = [c for c in new if not c[-1].isspace()]
            self._learn([whole[k:k + JOINED] for k in range(0, len(whole), JOINED)] + [[c] for c in new if c[-1].isspace()])
        else:
            self._learn([[c] for c in new])
        out = ([], [])
        for parts in chunks:
            ids = [known[c] for c in parts] if parts != [""] else []
            ids = [] if None in ids else ids
            for side in (0, 1):
                out[side].append(np.frombuffer(b"".join([x[side] for x in ids]), np.int32))
        for c in new:
            if len(c) > CACHE_CHARS:
                del known[c]
        return out

    def _learn(self, groups: list[list[str]]) -> None:
        """Encode chunks, those of a group joined by blanks, and remember the ids of each."""
        texts, singly = [" ".join(g) for g in groups], []
        for g, t, x, y in zip(groups, texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False),
                              self.b.encode(texts, num_threads=1)):
            raw, x = (" " + t).encode(), x.ids
            if not b"".join(map(self.a_bytes.__getitem__, x)) == raw == b"".join(map(self.b_bytes.__getitem__, y)):
                if len(g) == 1:
                    self.known[g[0]] = None
                singly += [[c] for c in g if len(g) > 1]
                continue
            ends = np.cumsum([len(c.encode()) + 1 for c in g])
            sides = []
            for ids, length in ((x, self.a_len), (y, self.b_len)):
                ids = np.array(ids, np.int32)
                cut = [0, *(4 * (np.searchsorted(np.cumsum(length[ids]), ends) + 1)).tolist()]
                data = ids.tobytes()
                sides.append([data[s:e] for s, e in zip(cut, cut[1:])])
            self.known.update(zip(g, zip(*sides)))
        if singly:
            self._learn(singly)


def _cuts_at_blanks(a, b) -> bool:
    """Whether no token of either side runs from a character that isn't white space over a blank: ``a`` cuts its
    text by the byte-level expression before it merges, ``b`` has no such piece and changes no character."""
    spec = json.loads(a.to_str())
    pre = spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and spec["truncation"] is None
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    crossing = any(re.search("[^▁]▁", p) for p in pieces)
    probe = "Ａ  ﬁ ½ Å e\u0301 \u00ad \u200b"
    kept = "".join(b.id_to_piece(i) if not b.is_byte(i) else "" for i in b.encode("x  y z")) == "▁x▁▁y▁z" and b.normalize(probe) == "▁" + probe.replace(" ", "▁")
    return bool(plain and kept and not crossing)


def _byte_level(tok) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary: printable Latin-1 characters stand for themselves,
    the other bytes for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(x): x for x in own} | {chr(0x100 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}
    out = [b""] * tok.get_vocab_size(with_added_tokens=True)
    for entry, i in tok.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
    return out


@functools.lru_cache(2)
def load(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def vocabularies(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    if a_path is None or b_path is None:
        import public_tokenizers
        a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
        b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    return a_path, b_path


class Aligned:
    """The alignment of a list of texts, side by side: token ids, their groups, overlaps, per-text counts."""

    def __init__(self, tok: Tokenizers, texts: list[str], piece: int = PIECE):
        a, b = tok.encode(texts)
        self.n_a = np.array([len(x) for x in a], np.int64)
        self.n_b = np.array([len(x) for x in b], np.int64)
        self.a = np.concatenate([np.zeros(0, np.int32), *a]).astype(np.int64)
        self.b = np.concatenate([np.zeros(0, np.int32), *b]).astype(np.int64)
        # texts end on both sides, so groups and overlaps never run from one into the next
        left, right, self.group_a, self.group_b = merge_ends(
            np.cumsum(tok.a_len[self.a]), np.cumsum(tok.b_len[self.b]), piece)
        self.left, self.right = left, right
        self.from_a, self.from_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        self.text_of_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_links = np.bincount(self.text_of_a[left], minlength=len(texts))
        self.n_groups = np.bincount(self.text_of_a[self._last(self.group_a)], minlength=len(texts))

    @staticmethod
    def _last(group: np.ndarray) -> np.ndarray:
        """Whether a token is the last of its group."""
        return np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)

    def digests(self, tok: Tokenizers) -> list[str]:
        last_a, last_b = self._last(self.group_a), self._last(self.group_b)
        b_before = np.concatenate([[0], np.cumsum(np.bincount(self.group_b))]) if len(self.b) else np.zeros(1, np.int64)
        a_upto = np.cumsum(np.bincount(self.group_a)) if len(self.a) else np.zeros(0, np.int64)
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + b_before[self.group_a]] = np.where(
            last_a, tok.a_text[1][self.a], tok.a_text[0][self.a])
        out[np.arange(len(self.b)) + a_upto[self.group_b]] = np.where(
            last_b, tok.b_text[1][self.b], tok.b_text[0][self.b])
        start = self.from_a + self.from_b
        return [hashlib.sha256(b"".join(out[s:s + n])[:-1]).hexdigest() if n else ""
                for s, n in zip(start.tolist(), (self.n_a + self.n_b).tolist())]

    def pairs(self, n_b_ids: int):
        """Distinct linked id pairs of every text: text, pair code, how often."""
        code = self.a[self.left] * n_b_ids + self.b[self.right]
        span = np.int64(code.max() + 1) if len(code) else np.int64(1)
        key = self.text_of_a[self.left] * span + code
        key, times = np.unique(key, return_counts=True)
        return key // span, key % span, times


def _parts(batch: pa.RecordBatch):
    """Slices of a batch with about ``BATCH_CHARS`` bytes of text, and their texts; only one slice is in Python's
    strings at a time."""
    length = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = length[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(length, before + BATCH_CHARS, side="right")))
        part = batch.slice(at, to - at)
        yield part, part.column("text").to_pylist()
        at = to


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document the alignment itself: (doc_id, a_ids, b_ids, group_a, group_b), the group of every
    token of both sides, from 0."""
    where = vocabularies(a_path, b_path)

    def run(batches):
        tok = load(*where)
        for whole in batches:
            for batch, texts in _parts(whole):
                cols = [[] for _ in range(4)]
                x = Aligned(tok, texts)
                for k in range(len(texts)):
                    sa = slice(x.from_a[k], x.from_a[k] + x.n_a[k])
                    sb = slice(x.from_b[k], x.from_b[k] + x.n_b[k])
                    first = x.group_a[sa.start] if x.n_a[k] else 0
                    for col, v in zip(cols, (x.a[sa], x.b[sb], x.group_a[sa] - first, x.group_b[sb] - first)):
                        col.append(v.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, pa.list_(pa.int32())) for c in cols)],
                    ["doc_id", "a_ids", "b_ids", "group_a", "group_b"])

    return _documents(docs).mapInArrow(
        run, "doc_id long, a_ids array<int>, b_ids array<int>, group_a array<int>, group_b array<int>")


_COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long"
_ENCODED = f"block long, {_COUNTS}, groups_sha256 string, places binary, times binary, first int, codes array<long>, docs array<long>"
_ENCODED_ARROW = pa.schema([("block", pa.int64()), *((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
                            ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
                            ("first", pa.int32()), ("codes", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])


def _columns(n: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _ENCODED_ARROW],
        schema=_ENCODED_ARROW)


def _encode(docs: DataFrame, where: tuple[str, str]) -> DataFrame:
    """Rows of two kinds: documents, whose pairs are places in their block's dictionary, and the
    dictionaries, ``PART`` entries a row from place ``first`` on (``codes`` is null on documents)."""

    def entries(block, known, docs_of):
        codes = np.fromiter(known, np.int64, len(known))
        cut = range(0, len(codes), PART)
        return _columns(len(cut), block=[block] * len(cut), first=list(cut),
                        codes=[codes[k:k + PART] for k in cut], docs=[docs_of[k:min(k + PART, len(codes))] for k in cut])

    def run(batches):
        tok = load(*where)
        block, known, docs_of = TaskContext.get().partitionId() << 32, {}, np.zeros(0, np.int64)
        for whole in batches:
            for batch, texts in _parts(whole):
                x = Aligned(tok, texts)
                text, code, times = x.pairs(len(tok.b_bytes))
                distinct, inverse, n_docs = np.unique(code, return_inverse=True, return_counts=True)
                place = np.array([known.setdefault(c, len(known)) for c in distinct.tolist()], np.int64)
                if len(docs_of) < len(known):
                    docs_of = np.concatenate([docs_of, np.zeros(len(known) - len(docs_of), np.int64)])
                docs_of[place] += n_docs
                place, times = place[inverse].astype(np.uint32), times.astype(np.uint32)
                cut = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
                yield _columns(len(texts), block=[block] * len(texts), doc_id=batch.column("doc_id"), n_a=x.n_a, n_b=x.n_b,
                               n_groups=x.n_groups, n_links=x.n_links, groups_sha256=x.digests(tok),
                               places=[place[s:e].tobytes() for s, e in zip(cut, cut[1:])],
                               times=[times[s:e].tobytes() for s, e in zip(cut, cut[1:])])
                if len(known) >= BLOCK_PAIRS:
                    yield entries(block, known, docs_of)
                    block, known, docs_of = block + 1, {}, np.zeros(0, np.int64)
        if known:
            yield entries(block, known, docs_of)

    return _documents(docs).mapInArrow(run, _ENCODED)


def alignment_report(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    where = vocabularies(a_path, b_path)
    n_b_ids = len(load(*where).b_bytes)
    # small row groups: a task holds one of them while it writes
    path = scratch_path(docs.sparkSession, "aligned")
    written = _encode(docs, where)
    written.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    encoded = docs.sparkSession.read.schema(written.schema).parquet(path)
    known = (encoded.filter(F.col("codes").isNotNull())
             .select("block", "first", F.posexplode(F.arrays_zip("codes", "docs")).alias("at", "e"))
             .select("block", (F.col("first") + F.col("at")).alias("place"), F.col("e.codes").alias("code"),
                     F.col("e.docs").alias("docs")))
    held = known.groupBy("code").agg(F.sum("docs").alias("held")).withColumn("a_id", F.expr(f"code div {n_b_ids}"))
    top = held.groupBy("a_id").agg(F.max("held").alias("top"))
    held = held.join(top, "a_id").select("code", "held", (F.col("held") == F.col("top")).alias("best"))
    answered = (known.join(held, "code").groupBy("block", F.expr(f"place div {PART}").alias("part"))
                .agg(F.sort_array(F.collect_list(F.struct("place", "held", "best"))).alias("e"))
                .select("block", "part", F.col("e.place").alias("place"), F.col("e.held").alias("held"), F.col("e.best").alias("best")))
    texts = encoded.filter(F.col("codes").isNull()).drop("first", "codes", "docs")
    both = texts.unionByName(answered, allowMissingColumns=True)
    # a block's dictionary stands before its documents
    dealt = both.repartition("block").sortWithinPartitions("block", F.col("part").asc_nulls_last())

    def run(batches):
        block, held, best = None, None, None
        for b in batches:
            blocks, parts = b.column("block").to_numpy(), b.column("part").is_valid().to_numpy(zero_copy_only=False)
            column = {c: b.column(c) for c in ("place", "held", "best", "places", "times")}
            rows, sums, bests = np.flatnonzero(~parts), [], []
            for k in range(len(blocks)):
                if blocks[k] != block:
                    block, held, best = blocks[k], np.zeros(0, np.int64), np.zeros(0, np.int64)
                if parts[k]:
                    place = column["place"][k].values.to_numpy()
                    if len(held) <= place[-1]:
                        more = np.zeros(place[-1] + 1 - len(held), np.int64)
                        held, best = np.concatenate([held, more]), np.concatenate([best, more])
                    held[place] = column["held"][k].values.to_numpy()
                    best[place] = column["best"][k].values.to_numpy(zero_copy_only=False)
                else:
                    place = np.frombuffer(column["places"][k].as_buffer(), np.uint32)
                    times = np.frombuffer(column["times"][k].as_buffer(), np.uint32).astype(np.int64)
                    sums.append(int(times @ held[place]) if len(place) else 0)
                    bests.append(int(times @ best[place]) if len(place) else 0)
            kept = b.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[:5], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), kept.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return dealt.mapInArrow(run, f"{_COUNTS}, n_best long, count_sum long, groups_sha256 string")
