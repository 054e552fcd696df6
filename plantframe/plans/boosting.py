"""MLlib's boosted trees, fitted over bundles of rows that share most of their features.

A frame of direct multi-horizon samples repeats each anchor's lags for every horizon, and MLlib looks at each feature of
each row at each level of each tree.  Here neighbouring rows that agree in the ``shared`` features are one *bundle*: the
bins of the shared features stand in it once, and each bin of the feature that is a row's ``own`` is a *slot* with the
row's target.  A node of a tree is then a set of bundles and a range of slots, and a bundle adds to the histograms of the
shared features once for each node that it has rows in, with the sum and the number of its targets there.

Trees are those of ``GBTRegressor``: the same bins (from the same sample of rows), squared error, gains, leaves and
weights, and the model is MLlib's.  Only the order of sums differs, by which splits of equal gain may be decided
otherwise.  Bundles follow from rows that stand together; where none do, each row is a bundle and only time is lost.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Sequence
from operator import add

import numpy as np
from pyspark import RDD, SparkContext, StorageLevel, TaskContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bundles and rows of a block (about); its arrays are to stay in a core's cache.
BLOCK_BUNDLES, BLOCK_ROWS = 4_096, 200_000
#: Rounds after which residuals are made from the targets anew, which ends the chain of kept residuals.
CHAIN = 25
#: Gains that differ by less than this share are equal: the split of the first feature and bin is taken, however rows lie in partitions.
EQUAL = 1e-9
#: Partitions whose histograms are summed on the driver; more are summed by tasks first.
DIRECT = 64


# -------------------------------------------------------------------- rows to blocks
def _numbers(column, what: str) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False) if not column.null_count else None
    if values is None or not np.isfinite(values).all():
        raise ValueError(f"{what} MUST NOT be Null, NaN or Infinity")
    return values


def _pack(batches):
    """Blocks of (shared values, rows of each bundle, own values, targets), in the order of the rows."""
    import pyarrow as pa

    part, made = TaskContext.get().partitionId(), 0
    held, bundles, rows = [], 0, 0

    def block():
        data = pickle.dumps([np.concatenate(x) for x in zip(*held)])
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | made]), pa.array([rows]), pa.array([data], pa.large_binary())], names=["id", "n", "data"])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lists = batch.column(0)
        shared = _numbers(lists.flatten(), "Vector values")
        sizes = np.diff(np.asarray(lists.offsets))
        if lists.null_count or (sizes != sizes[0]).any():
            raise ValueError("Vectors MUST have the same size")
        shared = shared.reshape(n, -1)
        starts = np.flatnonzero(np.concatenate([[True], (shared[1:] != shared[:-1]).any(axis=1)]))
        held.append((shared[starts], np.diff(np.append(starts, n)), _numbers(batch.column(1), "Vector values"), _numbers(batch.column(2), "Labels")))
        bundles, rows = bundles + len(starts), rows + n
        if bundles >= BLOCK_BUNDLES or rows >= BLOCK_ROWS:
            yield block()
            made, held, bundles, rows = made + 1, [], 0, 0
    if held:
        yield block()


# ----------------------------------------------------------------------------- bins
def _picked(places: dict[int, list[int]] | None):
    """The rows (shared and own values) at some places of each block, or all."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for i, data in zip(batch.column("id").to_pylist(), batch.column("data").to_pylist()):
                at = slice(None) if places is None else places.get(i)
                if at is None:
                    continue
                shared, sizes, own, _ = pickle.loads(data)
                bundle = np.repeat(np.arange(len(sizes)), sizes)[at]
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(np.column_stack([shared[bundle], own[at]]))], pa.large_binary())], names=["data"])

    return run


def limits(blocks: DataFrame, rows: int, bins: int, most: int, seed: int) -> list[np.ndarray]:
    """MLlib's thresholds of each feature, from the very rows that it would sample of blocks of this layout."""
    from plantframe.plans.forecast import split_points

    spark = blocks.sparkSession
    most = max(bins * bins, most)
    share = min(1.0, most / rows)
    places = None
    if share < 1.0:
        # Spark's own sample of an RDD with so many rows in each partition
        every = blocks.select("id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("at"))
        drawn = every._jdf.rdd().sample(False, share, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        places = {}
        for r in DataFrame(spark._jsparkSession.createDataFrame(drawn, every._jdf.schema()), spark).collect():
            places.setdefault(r["id"], []).append(r["at"])
    some = np.concatenate([pickle.loads(r["data"]) for r in blocks.mapInArrow(_picked(places), "data binary").collect()])
    expected = share * rows
    out = []
    for column in some.T:
        values, counts = np.unique(column[column != 0.0], return_counts=True)
        known = list(zip(values.tolist(), counts.tolist()))
        # MLlib doesn't look at zeros: what is missing from the expected number of rows counts as such
        if known and expected - counts.sum() > np.finfo(float).eps * counts.sum() * 100:
            known.append((0.0, expected - counts.sum()))
        out.append(np.array(split_points(known, bins, total=expected)))
    return out


def _binned(cuts: Sequence[np.ndarray]):
    """Blocks of (bins of the shared features; targets by slots, 0 where there is none; whether there is one; no sums of squares yet), all with a column for each bundle."""
    import pyarrow as pa

    *inner, own = cuts
    slots = len(own) + 1

    def run(batches):
        for batch in batches:
            for i, data in zip(batch.column("id").to_pylist(), batch.column("data").to_pylist()):
                shared, sizes, values, target = pickle.loads(data)
                bundle = np.repeat(np.arange(len(sizes)), sizes)
                key = bundle * slots + np.searchsorted(own, values)
                if (key[1:] <= key[:-1]).any():
                    # rows of the same bundle and slot: each further one is the row of a further bundle
                    order = np.argsort(key, kind="stable")
                    key, target = key[order], target[order]
                    at = np.arange(len(key))
                    rank = at - np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))
                    ranks = rank.max() + 1
                    which, bundle = np.unique(key // slots * ranks + rank, return_inverse=True)
                    shared = shared[which // ranks]
                rest, known = np.zeros((slots, len(shared))), np.zeros((slots, len(shared)), bool)
                rest[key % slots, bundle], known[key % slots, bundle] = target, True
                bins = np.array([np.searchsorted(c, v) for c, v in zip(inner, shared.T)], dtype=np.uint8).reshape(len(inner), len(shared))
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([pickle.dumps((bins, rest, known, {}))], pa.large_binary())], names=["id", "data"])

    return run


# ---------------------------------------------------------------------------- trees
def _reached(splits: dict[int, tuple[int, int]], bins: np.ndarray, slots: int, nodes: Sequence[int]):
    """Where these nodes of a tree of such splits (node: feature and last bin of its left child) lie in a block: node, bundles (None: all), range of slots."""
    on_the_way = {node >> up for node in nodes for up in range(node.bit_length())}
    todo = [(1, None, 0, slots)]
    while todo:
        node, at, lo, hi = todo.pop()
        if hi <= lo or at is not None and not len(at):
            continue
        if node in nodes:
            yield node, at, lo, hi
            continue
        feature, last = splits[node]
        if feature == len(bins):
            cut = min(max(last + 1, lo), hi)
            both = (at, lo, cut), (at, cut, hi)
        else:
            left = (bins[feature] if at is None else bins[feature].take(at)) <= last
            both = (((x.nonzero()[0] if at is None else at[x]), lo, hi) for x in (left, ~left))
        todo += [(child, *x) for child, x in zip((2 * node, 2 * node + 1), both) if child in on_the_way]


def _histogram(bins: np.ndarray, rest: np.ndarray, known: np.ndarray, splits: dict[int, tuple[int, int]], nodes: Sequence[int], width: int) -> np.ndarray:
    """Sum and number of the targets in each bin of each feature, for each of the nodes."""
    slots, n = rest.shape
    out = np.zeros((2, len(nodes), len(bins) + 1, width))
    line, ranges = {node: i for i, node in enumerate(nodes)}, {}
    where, base, sums, counts = [], [], [], []
    for node, at, lo, hi in _reached(splits, bins, slots, line):
        i = line[node]
        for j, x in enumerate((rest, known)):
            out[j, i, -1, lo:hi] = (x[lo:hi] if at is None else x[lo:hi].take(at, axis=1)).sum(axis=1)
        if (lo, hi) not in ranges:
            ranges[lo, hi] = rest[lo:hi].sum(axis=0), known[lo:hi].sum(axis=0, dtype=float)
        s, count = ranges[lo, hi]
        at = np.arange(n) if at is None else at
        count = count.take(at)
        some = count > 0
        if not some.all():
            at, count = at[some], count[some]
        where.append(at)
        base.append(np.full(len(at), i * width))
        sums.append(s.take(at))
        counts.append(count)
    if where:
        at, start, s, count = (np.concatenate(x) for x in (where, base, sums, counts))
        for f, b in enumerate(bins):
            key = b.take(at) + start
            for j, x in enumerate((s, count)):
                out[j, :, f] = np.bincount(key, x, len(nodes) * width).reshape(-1, width)
    return out


class Tree:
    """A tree that grows a level at a time; the children of node i are 2 i and 2 i + 1, the root is 1."""

    def __init__(self, weight: float, factor: float):
        self.weight, self.factor = weight, factor
        self.splits: dict[int, tuple[int, int]] = {}
        self.gains: dict[int, float] = {}
        #: Number and sum of the targets of a node, and the sum of their squares.
        self.stats: dict[int, tuple[float, float]] = {}
        self.squares: dict[int, float] = {}

    def grow(self, histograms: dict[int, np.ndarray]) -> list[int]:
        """The best split of each node (of equal ones that of the first feature and bin); the nodes that were split."""
        split = []
        for node, (value, number) in histograms.items():
            total, count = value.cumsum(axis=1) * self.factor, number.cumsum(axis=1)
            self.stats.setdefault(node, (float(count[0, -1]), float(total[0, -1])))
            n, s = self.stats[node]
            left, right = count[:, :-1], n - count[:, :-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                apart = total[:, :-1] / left - (s - total[:, :-1]) / right
                gain = np.where((left > 0) & (right > 0), left / n * (right / n) * apart * apart, -1.0)
            # gains that differ by the rounding of their sums are equal
            f, last = (int(x) for x in np.unravel_index(np.argmax(gain >= gain.max() * (1.0 - EQUAL)), gain.shape))
            if gain[f, last] <= 0:
                continue
            self.splits[node], self.gains[node] = (f, last), float(gain[f, last])
            a, b = float(count[f, last]), float(total[f, last])
            self.stats[2 * node], self.stats[2 * node + 1] = (a, b), (n - a, s - b)
            split.append(node)
        return split

    def leaves(self) -> dict[int, float]:
        return {node: s / n for node, (n, s) in self.stats.items() if node not in self.splits}

    def measure(self, squares: dict[int, float]) -> None:
        """Sums of squares of all nodes, from those of the leaves."""
        self.squares = {node: squares.get(node, 0.0) * self.factor * self.factor for node in self.leaves()}
        for node in sorted(self.splits, reverse=True):
            self.squares[node] = self.squares[2 * node] + self.squares[2 * node + 1]


def _fitted(steps: Sequence[tuple[dict, dict, float]]):
    """Residuals after some trees (splits, leaves, weight), and the sums of squares in the last one's leaves before it."""

    def run(block):
        bins, rest, known = block[0], block[1].copy(), block[2]
        for splits, leaves, weight in steps:
            squares, ranges = dict.fromkeys(leaves, 0.0), {}
            for node, at, lo, hi in _reached(splits, bins, len(rest), leaves):
                if (lo, hi) not in ranges:
                    ranges[lo, hi] = np.einsum("ij,ij->j", rest[lo:hi], rest[lo:hi]), np.zeros(rest.shape[1])
                square, less = ranges[lo, hi]
                at = slice(None) if at is None else at
                squares[node] += float(square[at].sum())
                less[at] = weight * leaves[node]
            for (lo, hi), (_, less) in ranges.items():
                rest[lo:hi] -= less * known[lo:hi]
        return bins, rest, known, squares

    return run


def _sum(parts: RDD, op=add):
    return parts.treeReduce(op) if parts.getNumPartitions() > DIRECT else parts.reduce(op)


def _both(a: dict[int, float], b: dict[int, float]) -> dict[int, float]:
    return {k: a[k] + b[k] for k in a}


def _count(blocks: RDD, splits: dict[int, tuple[int, int]], nodes: Sequence[int], width: int) -> tuple[list[np.ndarray], dict[int, float]]:
    """Histograms of the nodes (sums and numbers), and the blocks' sums of squares."""

    def run(part):
        total = None
        for bins, rest, known, squares in part:
            h = _histogram(bins, rest, known, splits, nodes, width)
            total = (h, squares) if total is None else (total[0] + h, _both(total[1], squares))
        return [] if total is None else [total]

    total, squares = _sum(blocks.mapPartitions(run), lambda a, b: (a[0] + b[0], _both(a[1], b[1])))
    return list(total.swapaxes(0, 1)), squares


def boost(blocks: RDD, rounds: int, depth: int, step: float, width: int) -> list[Tree]:
    """The trees of MLlib's boosting: the first one of the targets, each further one of twice the residuals (the gradient)."""
    trees, rest, done = [], blocks, None
    try:
        for m in range(rounds):
            tree = Tree(*((step, 2.0) if m else (1.0, 1.0)))
            (root,), squares = _count(rest, {}, [1], width)
            if trees:
                trees[-1].measure(squares)
                if done is not blocks:
                    done.unpersist()
            open_nodes = {1: root}
            for level in range(depth):
                split = tree.grow(open_nodes)
                if not split or level == depth - 1:
                    break
                # the smaller child is counted, the other one is the rest of its parent
                small = [min((2 * node, 2 * node + 1), key=lambda x: tree.stats[x][0]) for node in split]
                counted, _ = _count(rest, tree.splits, small, width)
                open_nodes = {x: h for node, h in zip(small, counted) for x, h in ((node, h), (node ^ 1, open_nodes[node >> 1] - h))}
            trees.append(tree)
            steps = [(t.splits, t.leaves(), t.weight) for t in trees]
            # a chain of kept residuals would make each task's plan longer by a round
            again = not (m + 1) % CHAIN
            done = rest
            rest = (blocks if again else rest).map(_fitted(steps if again else steps[-1:])).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        trees[-1].measure(_sum(rest.map(lambda b: b[3]), _both))
    finally:
        for x in (done, rest):
            if x not in (None, blocks):
                x.unpersist()
    return trees


def _model(trees: Sequence[Tree], cuts: Sequence[np.ndarray], gbt: GBTRegressor) -> GBTRegressionModel:
    """The trees as MLlib's model."""
    gateway = SparkContext._active_spark_context._gateway
    jvm = gateway.jvm
    regression = jvm.org.apache.spark.ml.regression
    # looked up once: each look-up is a round trip
    internal, leaf, split = (getattr(jvm.org.apache.spark.ml.tree, x) for x in ("InternalNode", "LeafNode", "ContinuousSplit"))
    variance, part, one = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange, regression.DecisionTreeRegressionModel
    parse = jvm.org.apache.spark.mllib.linalg.Vectors.parse
    some, weights = gateway.new_array(one, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, t in enumerate(trees):
        made, order = {}, sorted(t.stats, reverse=True)
        numbers = parse(str([x for node in order for x in (*t.stats[node], t.squares[node])])).toArray()
        for k, node in enumerate(order):
            (n, s), q = t.stats[node], t.squares[node]
            stats, impurity = variance(part(numbers, 3 * k, 3 * k + 3), int(n)), max(0.0, (q - s * s / n) / n)
            if node in t.splits:
                f, last = t.splits[node]
                made[node] = internal(s / n, impurity, t.gains[node], made.pop(2 * node), made.pop(2 * node + 1), split(f, float(cuts[f][last])), stats)
            else:
                made[node] = leaf(s / n, impurity, stats)
        some[i], weights[i] = one(f"dtr_{uuid.uuid4().hex[:12]}", made[1], len(cuts)), t.weight
    java = gbt._to_java()
    model = regression.GBTRegressionModel(gbt.uid, some, weights, len(cuts)).setParent(java)
    java.copyValues(model, jvm.org.apache.spark.ml.param.ParamMap.empty())
    return gbt._copyValues(GBTRegressionModel(model))


def fit_bundles(gbt: GBTRegressor, df: DataFrame, shared: str, own: str, partitions, limit_rows: int) -> GBTRegressionModel:
    """``gbt.fit`` of rows whose features are the array ``shared`` ++ the number ``own``.

    ``partitions``: how many partitions a fit over so many rows has.
    """
    rows = df.select(shared, F.col(own).cast("double"), F.col(gbt.getLabelCol()).cast("double"))
    held = rows.mapInArrow(_pack, "id long, n long, data binary").persist(StorageLevel.MEMORY_AND_DISK_DESER)
    blocks = None
    try:
        n = held.agg(F.sum("n")).first()[0]
        if not n:
            return gbt.fit(df)  # MLlib's refusal
        parts = partitions(n)
        packed = held.coalesce(parts)
        cuts = limits(packed, n, gbt.getMaxBins(), limit_rows, gbt.getSeed())
        # blocks are dealt out by their number, as partitions may have more or less of them
        dealt = packed.mapInArrow(_binned(cuts), "id long, data binary").repartitionByRange(parts, "id").select("data")
        blocks = dealt.rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        blocks.count()
        held.unpersist()
        trees = boost(blocks, gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), max(1, *map(len, cuts)) + 1)
    finally:
        held.unpersist()
        if blocks is not None:
            blocks.unpersist()
    return _model(trees, cuts, gbt)
