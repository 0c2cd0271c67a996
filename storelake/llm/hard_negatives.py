"""Hard-negative mining by Fagin's threshold algorithm (operator 12).

Rows are dealt to blocks of at most ``BLOCK`` vectors, anchors into blocks of at most ``ANCHORS``. A pair of blocks
is one piece of work: the rows' block holds one sorted list per dimension, and an anchor reads the lists
in step, from the large end where its component is positive and from the small end where it is
negative. Every row met is scored at once by random access, as an exact integer. The threshold is the score
of a row that would stand at the current place of all lists; no row still unmet scores more. Reading stops once the
threshold lies strictly below the k-th score of every list wanted: rows that tie with it have then been met.
The best k of the blocks hold the best k of the table, which are ranked per anchor (Spark keeps k a
task before it shuffles).

First each anchor's positives are found so, then, with the scores that they allow (their window), the
negatives of all windows of an anchor in one reading. A window that isn't full holds the threshold to its
lowest score.

Rows without id or label, and vectors that are null or hold null or non-finite components (also after
multiplying), take no part. Shorter vectors count as ending in zeros. Rows equal in id, label and
vector count once, and so do vectors of one id that score alike; an anchor's other rows are those of another id. Ties go to the smaller id. Scores beyond a long are
held at its limits. Further columns are ignored. An empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.common import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90          # per cent of the positive's score between which negatives score
BLOCK = 16_384              # rows of a block: a piece of work holds one, its lists, and one block of anchors
ANCHORS = 8_192             # anchors of a block
LEAST = 1_024               # a small table is not cut finer to fill the cluster
TOGETHER = 8                # blocks of anchors that are broadcast at once
FIRST_READ = 64             # places read from all lists at first; twice as many each time after

_LIMIT = 2**63 - 1


def quantised(vectors: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, q): rows that take part, with integer components."""
    q = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                  & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    small = F.forall("embedding", lambda x: F.abs(F.lit(float(SCALE)) * x.cast("double")) < F.lit(2.0**62))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
            .filter(F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ok & small, F.lit(False)))
            .select("vec_id", "label", q.alias("q")))


_PACKED = "block long, n int, dim int, ids binary, labels binary, data binary"


def _pack(rows: DataFrame, most: int, name: str) -> DataFrame:
    """Rows dealt evenly to blocks of at most ``most``, and at least as many blocks as the cluster has cores where that
    leaves ``LEAST`` rows in each: ids, labels and the matrix as bytes."""
    n = rows.count()
    cores = min(rows.sparkSession.sparkContext.defaultParallelism, n // LEAST)
    rows = rows.repartition(max(1, cores, math.ceil(n / (0.9 * most))))

    def run(batches):
        block, held, n = TaskContext.get().partitionId() << 32, [], 0

        def packed(part):
            t = pa.Table.from_batches(part)
            q = t.column("q").combine_chunks()
            lengths = np.diff(q.offsets.to_numpy())
            dim = int(lengths.max(initial=0))
            data = np.zeros((t.num_rows, dim), np.int64)
            data[np.arange(dim) < lengths[:, None]] = q.flatten().to_numpy()
            peak = np.abs(data).max(initial=0)
            data = data.astype(np.int16 if peak < 2**15 else np.int64)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "n": pa.array([t.num_rows], pa.int32()), "dim": pa.array([dim], pa.int32()),
                "ids": [t.column("vec_id").to_numpy().astype(np.int64).tobytes()],
                "labels": [t.column("label").to_numpy().astype(np.int64).tobytes()], "data": [data.tobytes()]})

        for b in batches:
            while b.num_rows:
                take = min(b.num_rows, most - n)
                held.append(b.slice(0, take))
                n, b = n + take, b.slice(take)
                if n == most:
                    yield packed(held)
                    block, held, n = block + 1, [], 0
        if n:
            yield packed(held)

    return stored(rows.mapInArrow(run, _PACKED), name)


def _matrix(n: int, dim: int, data: bytes) -> np.ndarray:
    kind = np.int16 if n * dim * 2 == len(data) else np.int64
    return np.frombuffer(data, kind).reshape(n, dim)


def _wide(x: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, dim - x.shape[1]))) if x.shape[1] < dim else x


class Lists:
    """The rows of a block with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, peak: int):
        # equal rows stand once
        _, one = np.unique(np.column_stack([ids, labels, x]), axis=0, return_index=True)
        self.ids, self.labels, x = ids[one], labels[one], x[one].astype(np.int64)
        # products and sums are exact in doubles below 2**53, in longs below 2**63, else in Python's numbers
        reach = int(np.abs(x).max(initial=0)) * peak * max(1, x.shape[1])
        self.kind = np.float64 if reach < 2**53 else np.int64 if reach < 2**63 else object
        self.x = x.astype(self.kind)
        self.plain = self.kind is not object and len(np.unique(self.ids)) == len(self.ids)
        self.order = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(self.x, self.order, 0)

    def reads(self, a: np.ndarray):
        """Rounds of sorted access for one anchor: (rows met in this round, their scores, threshold after it)."""
        a = a.astype(self.kind)
        n, dims = len(self.ids), np.flatnonzero(a != 0)
        up = a[dims] < 0                                    # read from the small end
        met, at, step = np.zeros(n, bool), 0, FIRST_READ
        while at < n:
            to = min(n, at + step)
            places = np.arange(at, to)[:, None]
            rows = self.order[np.where(up, places, n - 1 - places), dims].ravel()
            new = np.zeros(n, bool)
            new[rows] = True
            new &= ~met
            met |= new
            rows = np.flatnonzero(new)
            threshold = (a[dims] * self.values[np.where(up, to - 1, n - to), dims]).sum()
            if to == n or not len(dims) or met.all():
                rows, threshold, to = np.concatenate([rows, np.flatnonzero(~met)]), None, n
            yield rows, (self.x[rows] @ a), threshold
            at, step = to, 2 * step

    def top(self, a: np.ndarray, ok: np.ndarray, windows: list[tuple[int, int]], k: int):
        """For each window (lowest, highest score) the rows of its first ``k`` by (score down, id), among ``ok``."""
        best = [(np.zeros(0, np.int64), np.zeros(0, self.kind)) for _ in windows]
        for rows, scores, threshold in self.reads(a):
            keep = ok[rows]
            rows, scores = rows[keep], scores[keep]
            open_ = False
            for w, (low, high) in enumerate(windows):
                inside = (scores >= low) & (scores <= high)
                if inside.any():
                    r, s = np.concatenate([best[w][0], rows[inside]]), np.concatenate([best[w][1], scores[inside]])
                    if len(r) > k and self.plain:
                        limit = np.partition(s, len(s) - k)[len(s) - k]
                        r, s = r[s >= limit], s[s >= limit]
                    order = np.lexsort((self.ids[r], -s)) if self.kind is not object else np.array(
                        sorted(range(len(r)), key=lambda i: (-s[i], self.ids[r[i]])), np.int64)
                    r, s = r[order], s[order]
                    if not self.plain:                      # one id may have several vectors of equal score
                        first = np.append(True, (self.ids[r[1:]] != self.ids[r[:-1]]) | (s[1:] != s[:-1]))
                        r, s = r[first], s[first]
                    best[w] = r[:k], s[:k]
                # an unmet row may still enter while the threshold reaches the k-th score, or the lowest allowed
                floor = best[w][1][-1] if len(best[w][0]) == k else low
                open_ |= threshold is not None and threshold >= floor
            if threshold is None or not open_:
                break
        return best


def _search(anchors: DataFrame, rows: DataFrame, schema: str, find) -> DataFrame:
    """``find(lists, anchor block as a dict of columns, its matrix)`` gives the result columns of a pair of blocks.

    The rows' blocks stay in their tasks. Blocks of anchors come to them by broadcast, ``TOGETHER`` blocks at a
    time (at most ``TOGETHER * ANCHORS`` anchors), and there are as many rounds as that takes.
    """
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                x = _matrix(row["n"], row["dim"], row["data"])
                a = _matrix(row["a_n"], row["a_dim"], row["a_data"])
                dim = max(x.shape[1], a.shape[1])
                lists = Lists(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), _wide(x, dim),
                              int(np.abs(a.astype(np.int64)).max(initial=0)))
                cols = find(lists, row, _wide(a, dim))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    spark = rows.sparkSession
    numbers = sorted(r[0] for r in anchors.select("block").collect())     # one number for ANCHORS anchors
    prefixed = anchors.select([F.col(c).alias(f"a_{c}") for c in anchors.columns])
    dealt = rows.repartition(max(1, rows.count()))                        # one block is one piece of work
    parts = []
    for k in range(0, len(numbers), TOGETHER):
        some = numbers[k:k + TOGETHER]
        pairs = dealt.withColumn("a_block", F.explode(F.array(*[F.lit(x).cast("long") for x in some])))
        near = F.broadcast(prefixed.filter(F.col("a_block").isin(some)))
        parts.append(pairs.join(near, "a_block").mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _held(score) -> int:
    return max(-_LIMIT - 1, min(_LIMIT, int(score)))


def _find_positives(k: int):
    def find(lists, row, a):
        ids, labels = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64)
        out = ([], [], [], [])
        for p in range(row["a_n"]):
            (rows, scores), = lists.top(a[p], (lists.labels == labels[p]) & (lists.ids != ids[p]),
                                        [(float("-inf"), float("inf"))], k)
            for col, v in zip(out, ([row["a_block"]] * len(rows), [p] * len(rows), lists.ids[rows].tolist(), map(_held, scores))):
                col.extend(v)
        return out
    return find


def _find_negatives(k: int, low: int, high: int):
    def find(lists, row, a):
        ids, labels = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64)
        out = ([], [], [], [], [])
        for p, scores in enumerate(row["a_windows"]):
            bounds = [(-(-low * s // 100), high * s // 100) for s in scores]
            windows = [(lo, hi) for lo, hi in bounds if lo <= hi]
            if not windows:
                continue
            best = lists.top(a[p], (lists.labels != labels[p]) & (lists.ids != ids[p]), windows, k)
            for s, (rows, found) in zip([s for s, (lo, hi) in zip(scores, bounds) if lo <= hi], best):
                for col, v in zip(out, ([row["a_block"]] * len(rows), [p] * len(rows), [s] * len(rows),
                                        lists.ids[rows].tolist(), map(_held, found))):
                    col.extend(v)
        return out
    return find


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` of every key; the same row found in two blocks counts once."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
            .dropDuplicates([*keys, "rank"]))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of equal label, the first ``negatives`` rows of
    another label that score between ``low`` and ``high`` per cent of the positive's score.

    ``is_anchor`` is a condition on ``vec_id``; ``label`` replaces the label column.
    """
    q = quantised(vectors, F.col("label") if label is None else label)
    rows = _pack(q, block, "negatives-rows")
    anchors = _pack(q.filter(is_anchor).dropDuplicates(["vec_id", "label", "q"]), anchor_block, "negatives-anchors")

    found = _search(anchors, rows, "a_block long, at long, id long, score long", _find_positives(positives))
    first = stored(_ranked(found, ["a_block", "at"], positives), "negatives-positives")

    # the windows of an anchor go with its block: at most ANCHORS * positives scores
    windows = (first.groupBy("a_block", "at").agg(F.sort_array(F.collect_set("score")).alias("w"))
               .groupBy("a_block").agg(F.map_from_entries(F.collect_list(F.struct("at", "w"))).alias("by_anchor")))
    asked = (anchors.join(windows, anchors["block"] == windows["a_block"])
             .withColumn("windows", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(
                 F.col("by_anchor")[i.cast("long")], F.array().cast("array<long>"))))
             .drop("by_anchor", "a_block"))
    found = _search(asked, rows, "a_block long, at long, positive_score long, id long, score long",
                    _find_negatives(negatives, low, high))
    hard = (_ranked(found, ["a_block", "at", "positive_score"], negatives)
            .select("a_block", "at", "positive_score", F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    names = anchors.select(F.col("block").alias("a_block"), "ids", "n").mapInArrow(_ids_of, "a_block long, at long, anchor_id long")
    pairs = first.select("a_block", "at", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (hard.join(pairs, ["a_block", "at", "positive_score"]).join(names, ["a_block", "at"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _ids_of(batches):
    for b in batches:
        for block, ids in zip(b.column("a_block").to_pylist(), b.column("ids").to_pylist()):
            ids = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids))), pa.array(ids)], ["a_block", "at", "anchor_id"])


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """Anchors are every hundredth id; every seventh id has its label moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % 100 == 0, label)
