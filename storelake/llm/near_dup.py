"""Near-duplicate documents by DartMinHash (operator 7).

A document is the multiset of its five-word shingles (words lower-cased); similarity is the weighted
Jaccard of two multisets, and documents of 0.8 or more are linked. Signatures come from hashed
darts: a shingle that stands w times has a region of weight w, into which its hash throws darts as
a Poisson process over ranks. Only darts of rank up to (expected number needed) / (total weight) are
drawn, so a long document draws few per shingle; each dart falls on one of ``K`` coordinates, and a
coordinate keeps its earliest dart. Coordinates still open make the document draw on, at twice the
rank. Two documents share a coordinate's dart with probability equal to their similarity.

Linking, without all pairs of a group:

1. documents of equal multisets are one class, represented by the smallest id;
2. representatives meet in buckets of ``ROWS`` equal coordinates, in ``BANDS`` bands; each is
   compared with the bucket's smallest id, its hub;
3. members that the links found so far don't join with their hub are compared with all members of the
   bucket by their signatures, block by block inside numpy. A pair counts in the first band that it shares.
   Members of pairs above ``ESTIMATE`` between different components are sent with their multisets to the same
   block pair once more, where the pairs are verified, likeliest first, as long as the links found there don't
   already join them. Only links that join components leave a task; pairs never do, tested or not.

Every candidate pair is verified on the multisets, whose elements are 32 bits of a hash: texts of up to some 100,000 words
are compared exactly but for a chance of 1e-5 or so a pair of words. At similarity 0.8 the bands miss a pair with
probability (1 - 0.8 ** 5) ** 20 = 0.0004, at 0.9 with 1e-8.

Documents without words (null, empty) are linked with nothing. Fewer than five words are one
shingle. Rows with equal ``doc_id`` count as one document; rows without ``doc_id`` are left alone.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import grouped, stored, tidy, words
from storelake.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 20
K = ROWS * BANDS
DARTS = K * (math.log(K) + 2)       # darts after which nearly all coordinates are taken
BLOCK = 1024                        # members of a bucket compared at once
BLOCK_WEIGHT = 4_000_000            # shingles they hold together, about
ESTIMATE = 0.65                     # signature agreement that makes a candidate; 0.8 has a deviation of 0.04
WORD_CACHE = 100_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.cache
def _word_cache() -> dict[bytes, int]:
    return {}


def _word_ids(ws: list[bytes]) -> np.ndarray:
    cache = _word_cache()
    if len(cache) > WORD_CACHE:
        cache.clear()
    for w in set(ws).difference(cache):
        cache[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(cache.__getitem__, ws), np.uint64, len(ws))


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, element) of all texts, sorted by text: an element is a shingle and how many
    equal ones came before, so that multisets become sets."""
    ids = [_word_ids(words(t)) for t in texts]
    flat = np.concatenate([np.zeros(0, np.uint64), *ids])
    n = np.array([len(x) for x in ids], np.int64)
    start = np.cumsum(n) - n
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(texts)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + start[owner]
    size = np.minimum(n, SHINGLE)[owner]
    h = _mix(size.astype(np.uint64))
    for k in range(SHINGLE):
        more = size > k
        h = np.where(more, _mix(h * _U(0x9E3779B97F4A7C15) + flat[np.minimum(at + k, len(flat) - 1)]), h) if len(h) else h
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    where = np.arange(len(h))
    before = where - np.maximum.accumulate(np.where(first, where, 0))
    return owner, _mix(h + before.astype(np.uint64) * _U(0xD1342543DE82EF95))


def signatures(owner: np.ndarray, elems: np.ndarray, n_texts: int) -> np.ndarray:
    """K coordinates of each text (rows of texts without elements stay 0): the earliest darts."""
    out = np.zeros((n_texts, K), np.uint64)
    weight = np.bincount(owner, minlength=n_texts)
    open_ = weight > 0
    reach = DARTS / np.maximum(weight, 1)
    while open_.any():
        live = np.flatnonzero(open_[owner])
        who, e = owner[live], elems[live]
        rank, slots, ranks, darts, throw = np.zeros(len(e)), [], [], [], 0
        while len(e):
            throw += 1
            dart = _mix(e + _U(throw * 0x9E3779B97F4A7C15 % 2 ** 64))
            rank = rank - np.log(((dart >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
            hit = rank <= reach[who]
            who, e, rank, dart = who[hit], e[hit], rank[hit], _mix(dart[hit] + _U(1))
            slots.append(who * K + (dart % _U(K)).astype(np.int64)), ranks.append(rank), darts.append(dart)
        slot, rank, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
        order = np.lexsort((rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        full = np.bincount(slot[first] // K, minlength=n_texts) == K
        done = first[full[slot[first] // K]]
        out.reshape(-1)[slot[done]] = dart[done]
        open_ &= ~full
        reach[open_] *= 2
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS))
    for r in range(ROWS):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
    return h


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, weight, multiset key (h1, h2), band keys, coordinates cut to 32 bits."""
    def run(batches):
        for b in batches:
            for part, ids in _parts(b):
                owner, e = elements(part)
                sig = signatures(owner, e, len(part))
                keys = []
                for salt in (3, 5):
                    total = np.zeros(len(part), np.uint64)
                    np.add.at(total, owner, _mix(e * _U(salt)))
                    keys.append(pa.array(total.view(np.int64)))
                bands = band_keys(sig).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.bincount(owner, minlength=len(part)).astype(np.int64)), *keys,
                     pa.array(list(bands), pa.list_(pa.int64())),
                     pa.array([x.astype(np.uint32).tobytes() for x in sig], pa.binary())],
                    ["doc_id", "weight", "h1", "h2", "bands", "sig"])

    return _source(docs).mapInArrow(tidy(run), "doc_id long, weight long, h1 long, h2 long, bands array<long>, sig binary")


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _parts(batch):
    at = 0
    for part in grouped(batch.column("text").to_pylist()):
        yield part, batch.column("doc_id").slice(at, len(part))
        at += len(part)


def multisets(docs: DataFrame) -> DataFrame:
    """(id, elems): sorted 32-bit elements of each text."""
    def run(batches):
        for b in batches:
            for part, ids in _parts(b):
                owner, e = elements(part)
                cut = np.searchsorted(owner, np.arange(len(part) + 1))
                e = e.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([np.sort(e[i:j]).tobytes() for i, j in zip(cut, cut[1:])], pa.binary())], ["id", "elems"])
    return _source(docs).mapInArrow(tidy(run), "id long, elems binary")


def jaccard(p: np.ndarray, q: np.ndarray) -> float:
    """Of two sorted element lists; 0 where their lengths rule ``SIMILARITY`` out."""
    if min(len(p), len(q)) < SIMILARITY * max(len(p), len(q)) or not len(p):
        return 0.0
    both = np.sort(np.concatenate([p, q]), kind="stable")
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return same / (len(p) + len(q) - same)


def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaccard(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in zip(a, b)], dtype=float)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of at least ``SIMILARITY``."""
    left = sets.select(F.col("id").alias("a"), F.col("elems").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("elems").alias("y"))
    return pairs.distinct().join(left, "a").join(right, "b") \
                .filter(F.pandas_udf(similarity, "double")("x", "y") >= SIMILARITY).select("a", "b")


def _work(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the block pairs to compare: (key, m, t, apart, rep). Members apart from their hub's component stand on one
    side, all members of their buckets on the other; either side is cut into blocks, and a member stands in each pair of its
    block. Buckets of two hold nothing that the hub hasn't settled."""
    own = labels.select(F.col("node").alias("rep"), F.col("component").alias("_own"))
    its = labels.select(F.col("node").alias("hub"), F.col("component").alias("_its"))
    placed = (members.filter("n > 2").join(own, "rep", "left").join(its, "hub", "left")
              .select("key", "rep", "weight", "hub", (F.coalesce("_own", "rep") != F.coalesce("_its", "hub")).alias("apart")))
    placed = stored(placed, "placed")
    many = F.lit(float(BLOCK_WEIGHT))

    def blocks(which):
        return F.ceil(F.greatest(F.count(which) / BLOCK, F.sum(F.when(which.isNotNull(), F.col("weight"))) / many)).cast("int")

    apart = F.when(F.col("apart"), 1)
    sized = placed.groupBy("key").agg(blocks(apart).alias("n_m"), blocks(F.lit(1)).alias("n_t")).filter("n_m > 0")
    both = placed.join(sized, "key")
    mine = both.filter("apart").select("key", F.pmod(F.xxhash64("rep"), "n_m").cast("int").alias("m"),
                                       F.explode(F.sequence(F.lit(0), F.col("n_t") - 1)).alias("t"), F.lit(True).alias("mine"), "apart", "rep")
    theirs = both.select("key", F.explode(F.sequence(F.lit(0), F.col("n_m") - 1)).alias("m"),
                         F.pmod(F.xxhash64("rep"), "n_t").cast("int").alias("t"), F.lit(False).alias("mine"), "apart", "rep")
    return mine.unionAll(theirs)


_PAIR = ["key", "m", "t"]


def _groups(batches, size: int):
    """The rows of each block pair, from batches sorted by it, about ``size`` rows of small pairs at a time: (table, starts)."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < size:
            continue
        cut = _starts(held)
        if len(cut) > 1:
            yield held.slice(0, cut[-1]).combine_chunks(), cut[:-1]
            held = held.slice(cut[-1])
    if held is not None and held.num_rows:
        yield held.combine_chunks(), _starts(held)


def _starts(t: pa.Table) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in _PAIR:
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _candidates(sig, bands, part, mine, apart, reps, key):
    """(i, j, agreement) of pairs, one of each side, of different components and above ``ESTIMATE``, that share no earlier band."""
    left, right = np.flatnonzero(mine), np.flatnonzero(~mine)
    band = np.argmax(bands[left[0]] == key) if len(left) else 0
    out = []
    for i in left:
        j = right[(part[right] != part[i]) & (~apart[right] | (reps[right] > reps[i]))]
        if band:
            j = j[~(bands[j, :band] == bands[i, :band]).any(1)]
        same = (sig[j] == sig[i]).mean(1)
        ok = same >= ESTIMATE
        out.append((np.full(ok.sum(), i), j[ok], same[ok]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]


def _arrays(t: pa.Table):
    def fixed(c, kind):
        return np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(t.num_rows, -1)
    bands = t.column("bands").combine_chunks()
    return (fixed("sig", np.uint32), bands.flatten().to_numpy().reshape(t.num_rows, -1),
            *(t.column(c).to_numpy(zero_copy_only=False) for c in ("component", "mine", "apart", "rep", "key")))


def _promising(batches):
    """The members that stand in a candidate pair: rows of their block pair."""
    for t, starts in _groups(batches, 2 * BLOCK):
        arrays, hit = _arrays(t), np.zeros(t.num_rows, bool)
        for s, e in zip(starts, np.append(starts[1:], t.num_rows)):
            *some, keys = (x[s:e] for x in arrays)
            i, j, _ = _candidates(*some, keys[0])
            hit[s + i], hit[s + j] = True, True
        for b in t.select([*_PAIR, "mine", "apart", "rep"]).filter(pa.array(hit)).to_batches():
            yield b


def _joining(batches):
    """Links between components among the candidate pairs of each block pair, as few as join what is to be joined."""
    for t, starts in _groups(batches, 256):
        arrays, elems, found = _arrays(t), t.column("elems"), ([], [])
        for s, e in zip(starts, np.append(starts[1:], t.num_rows)):
            *some, keys = (x[s:e] for x in arrays)
            i, j, same = _candidates(*some, keys[0])
            parent = {int(p): int(p) for p in np.unique(some[2])}

            def root(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in elems.slice(s, e - s)]
            for k in np.argsort(-same, kind="stable"):
                p, q = root(int(some[2][i[k]])), root(int(some[2][j[k]]))
                if p != q and jaccard(sets[i[k]], sets[j[k]]) >= SIMILARITY:
                    parent[p] = q
                    ends = sorted((int(some[5][i[k]]), int(some[5][j[k]])))
                    found[0].append(ends[0]), found[1].append(ends[1])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])


def _rest_links(labels: DataFrame, members: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links between components that the hubs haven't found."""
    known = sigs.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left") \
                .select("rep", "sig", "bands", F.coalesce("component", "rep").alias("component"))

    def in_pairs(rows):
        return rows.repartition(*_PAIR).sortWithinPartitions(*_PAIR)

    pair = "key long, m int, t int, mine boolean, apart boolean, rep long"
    work = _work(members, labels).select(*_PAIR, "mine", "apart", "rep").join(known, "rep")
    some = stored(in_pairs(work).mapInArrow(tidy(_promising), pair), "promising")
    whole = some.join(known, "rep").join(sets.select(F.col("id").alias("rep"), "elems"), "rep")
    return stored(in_pairs(whole).mapInArrow(tidy(_joining), "a long, b long"), "links")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id of the document's group), kept (doc_id = class_id)."""
    signed = stored(sign(docs), "dart-signatures")
    whole = signed.filter(F.col("doc_id").isNotNull() & (F.col("weight") > 0))
    same = ["h1", "h2", "weight"]
    reps = stored(whole.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"),
                                           F.any_value("sig").alias("sig")), "representatives")
    buckets = reps.select("rep", "weight", F.explode("bands").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = stored(buckets.join(hubs, "key"), "buckets")
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    # the ids grow with the corpus: a merge join at every size
    sets = stored(multisets(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")), "multisets")
    links = stored(_verified(members.filter("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")),
                             sets), "links")
    labels = components(links)
    links = links.unionAll(_rest_links(labels, members, reps.select("rep", "sig", "bands"), sets))
    labels = components(links).select(F.col("node").alias("rep"), "component")
    named = reps.select(*same, "rep").join(labels, "rep", "left") \
                .select(*same, F.coalesce("component", "rep").alias("class_id"))
    out = signed.select("doc_id", *same).join(named, same, "left") \
                .withColumn("class_id", F.when(F.col("weight") > 0, F.col("class_id")))
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")) \
              .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that another document of their group stands for, columns as before."""
    gone = classes(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone["_gone"], "left_anti").select(*names)
