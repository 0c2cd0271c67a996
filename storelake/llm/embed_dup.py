"""Embedding near-duplicates by a pivot-permutation index (operator 8).

Each vector is described by its ``NEAREST`` nearest pivots (a bounded sample of the vectors). Its
inverted lists are the sets of ``SHARED`` of them: two vectors meet in a list exactly when they
share at least ``SHARED`` of their nearest pivots. Members of a list are verified by cosine in double
precision, a block of at most about ``BLOCK`` vectors against a block at a time; only per-vector
counts and one edge per vector leave a block pair, never the pairs. A pair that shares more pivots
meets in several lists; it counts in the one made of its smallest common pivots.

The pivots are up to ``PIVOTS`` vectors per dimension, spread out over a sample of ``SAMPLE`` times as
many (smallest hashes first); their number grows with the cube root of large tables, so that lists
keep their length. Every vector is indexed.
Recall against brute force is measured in the tests (0.999 and more).

Only vectors of equal label and dimension are compared. Vectors that are null, empty, zero or hold
null or non-finite components, and rows without label or id, link with nothing. Equal vectors are
one representative that counts as often as it stands. Rows with equal ``vec_id`` count separately.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import stored
from storelake.llm.graph import components

COSINE = 0.98
PIVOTS = 256
NEAREST = 6
SHARED = 3
SAMPLE = 8          # vectors drawn for each pivot wanted
APART = 0.9         # pivots have a cosine below this
BLOCK = 1024

_SAME = ["label", "dim", "h1", "h2"]


def _unit(rows) -> np.ndarray:
    x = np.array(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)     # large and small components don't overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _able():
    """Whether a row can link."""
    return F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _rows(vectors: DataFrame) -> DataFrame:
    e = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))    # -0.0 becomes 0.0
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", e.alias("embedding"))


def _usable(vectors: DataFrame) -> DataFrame:
    """Vectors that can link, keyed by label, dimension and a hash of the components."""
    return _rows(vectors).filter(_able()).select(
        "vec_id", "label", F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit("second"), "embedding").alias("h2"), "embedding")


def _spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n members of the sample, each the farthest from those before; none nearer than ``APART``
    to another, so that a crowd of near copies gives one pivot and not many that order at random."""
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < n:
        k = int(nearest.argmin())
        if nearest[k] >= APART:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, sample @ sample[k])
    return sample[chosen]


def _pivots(reps: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of each dimension that occurs, from a bounded sample by hash."""
    out = {}
    for r in reps.groupBy("dim").count().collect():
        n = max(PIVOTS, math.ceil(2.5 * r["count"] ** (1 / 3)))
        got = reps.filter(F.col("dim") == r["dim"]).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE * n) \
                  .select("embedding").collect()
        out[r["dim"]] = _spread(_unit([x["embedding"] for x in got]), n)
    return out


def describe(reps: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Representatives plus ``near``: their nearest pivots, in ascending order of pivot number."""
    def run(batches):
        for b in batches:
            near = []
            for dim, group in itertools.groupby(b.column("embedding").to_pylist(), len):
                p = pivots[dim]
                m = min(NEAREST, len(p))
                sims = _unit(list(group)) @ p.T
                near += np.sort(np.argpartition(-sims, m - 1, 1)[:, :m], 1).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.list_(pa.int32()))], [*b.schema.names, "near"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema.fields)
    return reps.mapInArrow(run, schema + ", near array<int>")


def _list_keys(described: DataFrame) -> DataFrame:
    """(label, dim, key, rep): the inverted lists."""
    def run(batches):
        for b in batches:
            out = ([], [])
            for k, near in enumerate(b.column("near").to_pylist()):
                for c in itertools.combinations(near, min(SHARED, len(near))):
                    out[0].append(k), out[1].append("-".join(map(str, c)))
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("label").take(at), b.column("dim").take(at),
                                              pa.array(out[1], pa.string()), b.column("rep").take(at)],
                                             ["label", "dim", "key", "rep"])
    d = described.select("label", "dim", "rep", "near")
    return d.mapInArrow(run, f"label {d.schema['label'].dataType.simpleString()}, dim int, key string, rep long")


def _link_block(key: str, same_block: bool, mine: list[dict], theirs: list[dict]):
    """Links of two blocks of a list: (rep, links, root) of each vector that has any."""
    ids = [np.array([x["rep"] for x in side]) for side in (mine, theirs)]
    count = [np.array([x["copies"] for x in side], np.int64) for side in (mine, theirs)]
    unit = [_unit([x["embedding"] for x in side]) for side in (mine, theirs)]
    link = unit[0] @ unit[1].T >= COSINE
    if same_block:
        link = np.triu(link, 1)
    own = [int(p) for p in key.split("-")]
    width = max(own)        # a smaller common pivot: the pair counts in another list
    marks = []
    for side in (mine, theirs):
        m = np.zeros((len(side), width + 1), np.float32)
        for i, x in enumerate(side):
            m[i, [p for p in x["near"] if p < width]] = 1
        m[:, own] = 0
        marks.append(m)
    link &= marks[0] @ marks[1].T < 0.5
    if not link.any():
        return
    label = [ids[0].copy(), ids[1].copy()]
    big = np.iinfo(np.int64).max
    while True:
        before = label[0].copy(), label[1].copy()
        if same_block:
            both = link | link.T
            label[0] = label[1] = np.minimum(label[0], np.where(both, label[0], big).min(1))
        else:
            label[0] = np.minimum(label[0], np.where(link, label[1], big).min(1))
            label[1] = np.minimum(label[1], np.where(link, label[0][:, None], big).min(0))
        if all((a == b).all() for a, b in zip(before, label)):
            break
    links = (link * count[1]).sum(1), (link * count[0][:, None]).sum(0)
    for side in (0, 1):
        for i in np.flatnonzero(links[side]):
            yield int(ids[side][i]), int(links[side][i]), int(label[side][i])


def _links(described: DataFrame) -> DataFrame:
    """(rep, links, root): per vector and block pair."""
    place = ["label", "dim", "key"]
    keys = _list_keys(described)
    sizes = keys.groupBy(*place).count().filter("count > 1")
    block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("count") / BLOCK)).cast("int").alias("block")
    members = keys.join(sizes, place).select(*place, "rep", block) \
                  .join(described.select("rep", "copies", "embedding", "near"), "rep")
    blocks = members.groupBy(*place, "block").agg(
        F.collect_list(F.struct("rep", "copies", "embedding", "near")).alias("held"))
    blocks = stored(blocks, "pivot-lists")
    mine = blocks.withColumnsRenamed({"block": "a", "held": "mine"})
    theirs = blocks.withColumnsRenamed({"block": "b", "held": "theirs"})
    both = mine.join(theirs, place).filter("a <= b").select("key", (F.col("a") == F.col("b")).alias("same"), "mine", "theirs")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                key, same, mine, theirs = (b.column(k)[i].as_py() for k in range(4))
                rows = list(_link_block(key, same, mine, theirs))
                cols = zip(*rows) if rows else [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], ["rep", "links", "root"])

    return both.mapInArrow(run, "rep long, links long, root long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    usable = _usable(vectors)
    reps = usable.groupBy(*_SAME).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
                                      F.any_value("embedding").alias("embedding"))
    reps = stored(reps, "vectors")
    described = stored(describe(reps, _pivots(reps)), "pivot-orders")
    found = stored(_links(described), "vector-links")
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    total = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = reps.select(*_SAME, "rep", "copies").join(total, "rep", "left") \
                .join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
                .select(*_SAME, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id"))
    linked = usable.select("vec_id", *_SAME).join(named, _SAME).select("vec_id", "n_links", "component_id")
    alone = _rows(vectors).filter(~_able()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
