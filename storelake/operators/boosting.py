"""Gradient-boosted regression trees over packed rows (M1, M5, M6): what MLlib's ``GBTRegressor`` fits, as a model of MLlib.

MLlib keeps an object per row and adds to three sums per feature and row for each of the 250 passes of a fit. Here a row
is its bins, several features to a 16-bit number, and eight bytes for what the trees so far leave of its label. The
candidate thresholds are the ones MLlib finds (``RandomForest.findSplits``), the choice among them follows its rules:

* variance impurity; a split needs ``minInstancesPerNode`` rows on both sides and ``minInfoGain``; a node is a leaf at
  ``maxDepth``, without gain, or when its impurity is nothing;
* categories are ordered by their mean label in the node, empty ones last;
* of equal gains the earlier feature's, then the lower threshold's, wins. Sums of doubles differ in their last digits
  with the order of adding, so gains within ``TIE`` of the largest count as equal;
* the first tree fits the label, every later one twice what is left of it, and weighs ``stepSize``.

All rows are counted for every tree. Of two children only the smaller one's rows are counted; the other's sums are the
parent's less these. A tree takes one pass per level; the pass over a finished tree's leaves also counts the next root.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.session import scratch_path

BLOCK_ROWS = 32_768         # rows handled together in a task
MAX_CODES = 1024            # distinct numbers of a group of features, unless one feature has more bins
TASK_BYTES = 128_000_000    # packed rows of a task
DRIVER_TASKS = 32           # more tasks than this have their sums added up on the executors
TIE = 1e-9
EPSILON = 2.0 ** -52        # MLlib's: an impurity below it is nothing


@dataclass
class Bins:
    """Candidate thresholds (None for a category) and bins of each feature, and how features share 16-bit numbers."""

    thresholds: list
    sizes: list[int]
    groups: list[list[int]] = field(init=False)
    place: dict = field(init=False)     # feature -> (group, factor of its bin in the group's number)
    codes: list[int] = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.groups = []
        room: list[int] = []
        self.place = {}
        for f in sorted(range(len(self.sizes)), key=lambda f: (-self.sizes[f], f)):
            g = next((g for g, used in enumerate(room) if used * self.sizes[f] <= MAX_CODES), len(room))
            if g == len(room):
                self.groups.append([])
                room.append(1)
            self.place[f] = (g, room[g])
            self.groups[g].append(f)
            room[g] *= self.sizes[f]
        self.codes = room
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def packed(self, columns: list[np.ndarray]) -> np.ndarray:
        """(groups, rows): the bins of each row."""
        out = np.zeros((len(self.groups), len(columns[0])), np.uint16)
        for f, v in enumerate(columns):
            g, factor = self.place[f]
            t = self.thresholds[f]
            bins = v.astype(np.int64) if t is None else np.searchsorted(t, v, side="left")
            if t is None and not ((bins == v) & (bins >= 0) & (bins < self.sizes[f])).all():
                raise ValueError(f"feature {f} has a category outside 0 to {self.sizes[f] - 1}")
            out[g] += (bins * factor).astype(np.uint16)
        return out

    def goes_right(self, f: int, left: np.ndarray) -> tuple[int, np.ndarray]:
        """The group of ``f`` and, per number of the group, whether its row is outside the bins ``left``."""
        g, factor = self.place[f]
        return g, ~left[np.arange(self.codes[g]) // factor % self.sizes[f]]

    def by_feature(self, sums: list[np.ndarray]) -> np.ndarray:
        """(nodes, 2, all bins) from the groups' (2, nodes, codes)."""
        out = np.zeros((sums[0].shape[1], 2, self.starts[-1]))
        for g, features in enumerate(self.groups):
            for f in features:
                factor, n = self.place[f][1], self.sizes[f]
                part = sums[g].reshape(2, out.shape[0], -1, n, factor).sum(axis=(2, 4))
                out[:, :, self.starts[f]:self.starts[f + 1]] = part.transpose(1, 0, 2)
        return out


@dataclass
class Node:
    rows: float
    total: float
    squares: float = 0.0
    gain: float = 0.0
    split: tuple | None = None      # (feature, bins that go left, threshold's place or left categories in order)

    @property
    def mean(self) -> float:
        return self.total / self.rows if self.rows else 0.0

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.rows) / self.rows if self.rows else 0.0


def best_split(bins: Bins, sums: np.ndarray, min_rows: int, min_gain: float) -> tuple | None:
    """(gain, feature, bins that go left, place, rows and total of the left side) of the best split by ``sums`` (2, bins)."""
    found = []
    for f, n in enumerate(bins.sizes):
        count, total = sums[:, bins.starts[f]:bins.starts[f + 1]]
        order = np.arange(n)
        if bins.thresholds[f] is None:
            order = np.argsort(np.where(count > 0, total / np.maximum(count, 1), np.inf), kind="stable")
        nl, sl = np.cumsum(count[order])[:-1], np.cumsum(total[order])[:-1]
        rows, whole = count.sum(), total.sum()
        nr, sr = rows - nl, whole - sl
        ok = (nl >= min_rows) & (nr >= min_rows)
        if not ok.any():
            continue
        gain = np.where(ok, nl * nr / rows ** 2 * (sl / np.maximum(nl, 1) - sr / np.maximum(nr, 1)) ** 2, -1.0)
        at = int(np.argmax(gain >= gain.max() * (1 - TIE)))
        left = np.zeros(n, bool)
        left[order[:at + 1]] = True
        found.append((gain[at], f, left, order[:at + 1] if bins.thresholds[f] is None else at, nl[at], sl[at]))
    top = max((s[0] for s in found), default=0.0)
    if top <= 0 or top < min_gain:
        return None
    return next(s for s in found if s[0] >= top * (1 - TIE))


# --- inside tasks -----------------------------------------------------------------
def rows_of(codes: np.ndarray, tree: dict, wanted: list[int]) -> dict:
    """Row numbers (None: all) of the wanted nodes; ``tree`` maps a node to its group and whether a number goes right."""
    ways = set()
    for node in wanted:
        while node:
            ways.add(node)
            node //= 2
    found = {1: None}
    for node in sorted(ways):
        if node not in tree or not {2 * node, 2 * node + 1} & ways:
            continue
        group, right = tree[node]
        rows = found[node]
        side = right.take(codes[group] if rows is None else codes[group].take(rows))
        for child in {2 * node, 2 * node + 1} & ways:
            at = np.flatnonzero(side if child & 1 else ~side)
            found[child] = at if rows is None else rows.take(at)
    return {node: found[node] for node in wanted}


class Sums:
    """Rows and total of the label per number of each group, for some nodes, and the sum of squares of each node."""

    def __init__(self, bins: Bins, nodes: int):
        self.bins, self.nodes = bins, nodes
        self.groups = [np.zeros((2, nodes, n)) for n in bins.codes]
        self.squares = np.zeros(nodes)

    def add(self, codes: np.ndarray, labels: np.ndarray, rows: list) -> None:
        some = None if self.nodes == 1 and rows[0] is None else np.concatenate(rows)
        if some is not None:
            labels = labels.take(some)
        ends = np.cumsum([len(labels)] if some is None else [len(r) for r in rows])
        for k, end in enumerate(ends):
            part = labels[ends[k - 1] if k else 0:end]
            self.squares[k] += part @ part
        for g, n in enumerate(self.bins.codes):
            at = (codes[g] if some is None else codes[g].take(some)).astype(np.int64)
            for k in range(1, self.nodes):
                at[ends[k - 1]:ends[k]] += k * n
            self.groups[g][0] += np.bincount(at, minlength=self.nodes * n).reshape(self.nodes, n)
            self.groups[g][1] += np.bincount(at, labels, self.nodes * n).reshape(self.nodes, n)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        return self.bins.by_feature(self.groups), self.squares


def _pack(bins: Bins):
    def run(batches):
        held: list[list[np.ndarray]] = []
        count = 0

        def block(columns):
            return pa.RecordBatch.from_arrays([pa.array([bins.packed(columns[1:]).tobytes()], pa.binary()),
                                               pa.array([columns[0].tobytes()], pa.binary())], ["codes", "labels"])
        for batch in batches:
            if batch.num_rows:
                held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                count += batch.num_rows
            if count >= BLOCK_ROWS:
                whole = [np.concatenate(c) for c in zip(*held)]
                cut = count - count % BLOCK_ROWS
                for a in range(0, cut, BLOCK_ROWS):
                    yield block([c[a:a + BLOCK_ROWS] for c in whole])
                held, count = [[c[cut:] for c in whole]], count - cut
        if count:
            yield block([np.concatenate(c) for c in zip(*held)])
    return run


def _count(bins: Bins, tree: dict, wanted: list[int]):
    def run(blocks):
        sums = Sums(bins, len(wanted))
        for codes, left in blocks:
            if codes is not None:
                at = rows_of(codes, tree, wanted)
                sums.add(codes, left, [at[k] for k in wanted])
        yield sums.result()
    return run


def _next(bins: Bins, tree: dict, steps: dict):
    """What is left of the labels after a tree whose leaves take ``steps``, block by block; then the sums of the whole
    for the next root, and the sum of squares of each leaf before."""
    def run(blocks):
        sums = Sums(bins, 1)
        squares = np.zeros(len(steps))
        for codes, left in blocks:
            if codes is None:
                continue
            after = left.copy()
            for k, (node, rows) in enumerate(rows_of(codes, tree, list(steps)).items()):
                old = left if rows is None else left.take(rows)
                squares[k] += old @ old
                after[slice(None) if rows is None else rows] = old - steps[node]
            sums.add(codes, after, [None])
            yield after
        yield (*sums.result(), squares)
    return run


def _last(items):
    for item in items:
        pass
    yield item


# --- the fit ----------------------------------------------------------------------
def _one_by_one(rdd: RDD) -> RDD:
    """``rdd`` with every element serialized by itself, so that two of them can be zipped as they lie."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _added(rdd: RDD):
    def add(a, b):
        return tuple(x + y for x, y in zip(a, b))
    if rdd.getNumPartitions() > DRIVER_TASKS:
        return rdd.treeReduce(add)
    return rdd.reduce(add)


def candidates(gbt: GBTRegressor, data: DataFrame, features: int) -> tuple[Bins, object]:
    """MLlib's candidate thresholds for ``data``, and its metadata of the training rows."""
    jvm = data.sparkSession._jvm
    gbt._transfer_params_to_java()
    java, ml = gbt._java_obj, jvm.org.apache.spark.ml
    categorical = ml.util.MetadataUtils.getCategoricalFeatures(data._jdf.schema().apply(gbt.getFeaturesCol()))
    strategy = java.getOldBoostingStrategy(categorical, jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()).treeStrategy()
    impl = getattr(ml.tree.impl, "DecisionTreeMetadata$").__getattr__("MODULE$")

    def instances(df):
        return getattr(ml.util, "DatasetUtils$").__getattr__("MODULE$").extractInstances(java, df._jdf, jvm.scala.Option.apply(None))
    # the metadata tells how many rows and features there are: rows of one vector do for that
    counted = data.withColumn(gbt.getFeaturesCol(), array_to_vector(F.array(*[F.lit(0.0)] * features)))
    metadata = impl.buildMetadata(instances(counted), strategy, 1, gbt.getFeatureSubsetStrategy())
    found = getattr(ml.tree.impl, "RandomForest$").__getattr__("MODULE$").findSplits(instances(data), metadata, gbt.getSeed())
    thresholds = [np.array([s.threshold() for s in found[f]]) if metadata.isContinuous(f) else None for f in range(len(found))]
    sizes = [len(t) + 1 if t is not None else metadata.numBins()[f] for f, t in enumerate(thresholds)]
    return Bins(thresholds, sizes), metadata


def packed_rows(data: DataFrame, label: str, columns: list[str], bins: Bins, rows: int) -> tuple[RDD, RDD, str]:
    """Blocks of bins and of labels as two RDDs whose elements correspond; each partition ends with a None.

    The blocks are written once to the shared folder: a lost part is read again from there, in the same order."""
    spark = data.sparkSession
    path = scratch_path(spark, "packed-rows")
    (data.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate([label, *columns])])
     .mapInArrow(_pack(bins), "codes binary, labels binary")
     .write.option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 4).parquet(path))
    groups = len(bins.groups)
    stored = spark.read.parquet(path)
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-rows * (2 * groups + 8) // TASK_BYTES))

    def blocks(column, of):
        def run(items):
            for r in items:
                yield of(bytes(r[0]))
            yield None
        rdd = stored.select(column).rdd
        return _one_by_one((rdd.coalesce(tasks) if rdd.getNumPartitions() > tasks else rdd).mapPartitions(run))
    return (blocks("codes", lambda b: np.frombuffer(b, np.uint16).reshape(groups, -1)),
            blocks("labels", lambda b: np.frombuffer(b)), path)


def grow(codes: RDD, left: RDD, bins: Bins, root: tuple, depth: int, min_rows: int, min_gain: float, scale: float) -> dict[int, Node]:
    """One tree, level by level: node number (children of k: 2k, 2k + 1) -> node. Labels are ``scale`` times ``left``."""
    def by(sums, squares):
        return sums * np.array([1.0, scale])[:, None], squares * scale * scale
    sums, squares = by(*root)
    count, total = sums[0, :, :bins.sizes[0]].sum(axis=1)
    tree = {1: Node(count, total, squares[0])}
    known = {1: sums[0]}
    for level in range(depth):
        parents = []
        for k, s in known.items():
            node = tree[k]
            best = None if level and abs(node.impurity) < EPSILON else best_split(bins, s, min_rows, min_gain)
            if best is None:
                continue
            node.gain, f, goes_left, place, nl, sl = best
            node.split = (f, goes_left, place)
            tree[2 * k], tree[2 * k + 1] = Node(nl, sl), Node(node.rows - nl, node.total - sl)
            parents.append(k)
        if not parents or level + 1 == depth:
            break
        smaller = [2 * k + (tree[2 * k + 1].rows < tree[2 * k].rows) for k in parents]
        pairs = codes.zip(left)
        counted, squares = by(*_added(pairs.mapPartitions(_count(bins, tables(bins, tree), smaller))))
        above, known = known, {}
        for k, one, s, q in zip(parents, smaller, counted, squares):
            rest = above[k] - s
            rest[1, rest[0] == 0] = 0.0
            known[one], known[one ^ 1] = s, rest
            tree[one].squares, tree[one ^ 1].squares = q, tree[k].squares - q
        known = dict(sorted(known.items()))
    return tree


def tables(bins: Bins, tree: dict[int, Node]) -> dict:
    return {k: bins.goes_right(n.split[0], n.split[1]) for k, n in tree.items() if n.split}


def fit(gbt: GBTRegressor, data: DataFrame, columns: list[str]) -> GBTRegressionModel:
    """Fit ``gbt`` to ``data``, whose features column was assembled from ``columns``."""
    if gbt.getSubsamplingRate() != 1.0 or gbt.getFeatureSubsetStrategy() != "all" or gbt.getLossType() != "squared" \
            or gbt.getMinWeightFractionPerNode() or gbt.isDefined("weightCol") or gbt.isDefined("validationIndicatorCol"):
        raise ValueError("squared loss over all rows and features is fitted, without weights")
    spark = data.sparkSession
    label = gbt.getLabelCol()
    data = data.withColumn(label, F.col(label).cast("double"))
    bins, metadata = candidates(gbt, data, len(columns))
    limits = gbt.getMaxDepth(), metadata.minInstancesPerNode(), metadata.minInfoGain()
    codes, left, path = packed_rows(data, label, columns, bins, metadata.numExamples())
    codes.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    trees: list[dict[int, Node]] = []
    checkpoints: list[str] = []
    root = _added(codes.zip(left).mapPartitions(_count(bins, {}, [1])))
    try:
        for m in range(gbt.getMaxIter()):
            weight, scale = (gbt.getStepSize(), 2.0) if m else (1.0, 1.0)
            tree = grow(codes, left, bins, root, *limits, scale)
            leaves = {k: weight * n.mean for k, n in tree.items() if not n.split}
            after = _one_by_one(codes.zip(left).mapPartitions(_next(bins, tables(bins, tree), leaves)))
            after.persist(StorageLevel.MEMORY_AND_DISK_DESER)
            every = gbt.getCheckpointInterval()
            if every > 0 and (m + 1) % every == 0 and m + 1 < gbt.getMaxIter():
                after.checkpoint()
            sums, squares, of_leaves = _added(after.mapPartitions(_last))
            root = sums, squares
            _finish(tree, dict(zip(leaves, of_leaves * scale * scale)))
            trees.append(tree)
            if m:
                left.unpersist()
            left = after
            if after.isCheckpointed():
                checkpoints.append(after.getCheckpointFile())
                _remove(spark, checkpoints[:-1])
                checkpoints = checkpoints[-1:]
    finally:
        left.unpersist()
        codes.unpersist()
        _remove(spark, [path, *checkpoints])
    return _model(gbt, bins, trees, spark, len(columns))


def _remove(spark, paths: list[str]) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _finish(tree: dict[int, Node], squares: dict[int, float]) -> None:
    """Sums of squares of the leaves, and of inner nodes by their children."""
    for k in sorted(tree, reverse=True):
        tree[k].squares = tree[2 * k].squares + tree[2 * k + 1].squares if tree[k].split else squares[k]


def _model(gbt: GBTRegressor, bins: Bins, trees: list[dict[int, Node]], spark, features: int) -> GBTRegressionModel:
    """The trees as MLlib's model; sibling leaves of one prediction become one, as there."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    threshold_split, category_split = ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
    inner, leaf, variance = ml.tree.InternalNode, ml.tree.LeafNode, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    cut = jvm.java.util.Arrays.copyOfRange

    def doubles(values):
        return _py2java(spark.sparkContext, DenseVector(values)).values()

    def node(tree, sums, k):
        """The JVM's node and, if it is a leaf, its prediction."""
        n = tree[k]
        at = 3 * list(tree).index(k)
        stats = variance(cut(sums, at, at + 3), int(n.rows))
        if n.split:
            (a, left), (b, right) = node(tree, sums, 2 * k), node(tree, sums, 2 * k + 1)
            if left is None or left != right:
                f, _, place = n.split
                split = threshold_split(f, float(bins.thresholds[f][place])) if bins.thresholds[f] is not None \
                    else category_split(f, doubles(place), bins.sizes[f])
                return inner(float(n.mean), float(n.impurity), float(n.gain), a, b, split, stats), None
        return leaf(float(n.mean), float(n.impurity), stats), n.mean

    kind = ml.regression.DecisionTreeRegressionModel
    made = gateway.new_array(kind, len(trees))
    for i, tree in enumerate(trees):
        made[i] = kind(f"dtr_{gbt.uid}_{i}", node(tree, doubles([v for n in tree.values() for v in (n.rows, n.total, n.squares)]), 1)[0], features)
        gbt._java_obj.copyValues(made[i], ml.param.ParamMap.empty())
    weights = doubles([1.0] + [gbt.getStepSize()] * (len(trees) - 1))
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(gbt.uid, made, weights, features))
    model._resetUid(gbt.uid)
    return gbt._copyValues(model)
