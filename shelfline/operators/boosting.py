"""Gradient-boosted trees for a yes/no label, trained over the whole table.

Second-order boosting of the logistic loss on binned features. The rows stay where they are: per level
of a tree every task sums gradient and hessian by (node, feature, bin) and returns one cell whose size depends on
the model only; the driver adds up a bounded number of cells, more are added by tasks first. A split needs `min_child_weight` of hessian on both sides
and is kept when it, or a split below it, saves at least `min_gain` of loss; missing values go to the side that
saves more. A leaf is worth -rate * G / (H + ridge).

Gradients are summed as whole multiples of 2^-26, so the sums, hence the model, do not depend on the
order or the partitioning of the rows. Which rows a tree sees is a hash of the row and the tree's number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.ordered import cut_lineage

BINS = 256
UNIT = 1 << 26
# Trees after which the sums of the rows are written down, so no pass evaluates more trees than that.
WRITTEN_EVERY = 10
MISSING = -1
# Rows of a block, and sums of tasks that one place adds up.
BLOCK = 10_000
MERGED = 64


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2i + 1 and 2i + 2; feature -1 is a leaf."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    missing_left: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 ** (self.depth + 1) - 1
        self.feature, self.cut = np.full(n, -1), np.zeros(n, np.int64)
        self.missing_left = np.zeros(n, bool)
        self.gain, self.value, self.weight = np.zeros(n), np.zeros(n), np.zeros(n)

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends in; `bins` (features, rows) are of two bytes."""
        kind = np.min_scalar_type(len(self.feature)).type
        last = bins.view(np.uint16)  # here missing values lie above every cut, with a sign below

        def end(node: int):
            f = self.feature[node]
            if f < 0:
                return kind(node)
            left = bins[f] <= np.int16(self.cut[node]) if self.missing_left[node] else last[f] <= np.uint16(self.cut[node])
            one, other = end(2 * node + 1), end(2 * node + 2)
            return other ^ ((one ^ other) & np.negative(left.astype(kind)))  # a choice, several times faster than by where()

        return np.broadcast_to(end(0), bins.shape[1:])


@dataclass(frozen=True)
class BoostedTrees:
    """`cuts[f]` are the rising cut points of feature f; a row is in bin b when b of them are smaller than its value."""

    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]
    trees: tuple[Tree, ...]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.cuts)

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = np.ascontiguousarray(self.binned(x).T, np.int16)
        return sum((t.value[t.node_of(bins)] for t in self.trees), np.zeros(len(x)))


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    out = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1) if len(cuts) else np.zeros((len(x), 0), int)
    out[np.isnan(x)] = MISSING
    return out


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def cut_points(df: DataFrame, features: Sequence[str], bins: int = BINS) -> tuple[np.ndarray, ...]:
    """At most `bins` - 1 values per feature, about equally many rows apart: all distinct values of a short table."""
    shares = [i / bins for i in range(1, bins)] + [1.0]
    picks = [F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None)), shares, 10_000).alias(f"_{i}") for i, f in enumerate(features)]
    row = df.agg(*picks).first()
    # the largest value cuts nothing off
    return tuple(np.unique(np.array(row[i] or [], float))[:-1] for i in range(len(features)))


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _packed(bins: np.ndarray) -> pa.Array:
    """The bins of each row of a matrix as one binary cell of two bytes each, which Spark hands over without a look at its elements."""
    n, width = bins.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(2 * width)
    data = np.ascontiguousarray(bins, "<i2").tobytes()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    if not len(column) or not width:
        return np.zeros((len(column), width), np.int16)
    start = int(np.frombuffer(offsets, np.int32)[column.offset])
    return np.frombuffer(data, "<i2", len(column) * width, start).reshape(len(column), width)


def _values(df: DataFrame, features: Sequence[str]):
    return F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])


def _drawn(keys: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """Whether a row is in the sample of a tree: a hash of its key, the tree and the seed."""
    x = keys.view(np.uint64) ^ np.uint64((number * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(share * 2**64), 2**64 - 1))


def _cell(values: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())


def _block_rows(train: DataFrame, features: Sequence[str], label: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """The rows with a label, written once in blocks of at most `BLOCK`: keys, labels, bins (feature by feature) and margins, a cell each."""
    width = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                bins = binned(_matrix(part.column(2), width, float), cuts).astype(np.int16)
                cells = [_cell(part.column(0).to_numpy()), _cell(part.column(1).to_numpy()), _packed(bins.T.reshape(1, -1)), _cell(np.zeros(len(bins)))]
                yield pa.RecordBatch.from_arrays(cells, ["keys", "y", "bins", "margin"])

    rows = train.where(F.col(label).isNotNull()).select(
        F.xxhash64(*[F.col(f"`{c}`") for c in train.columns if not isinstance(train.schema[c].dataType, T.MapType)]),
        F.col(label).cast("double"), _values(train, features))
    return cut_lineage(rows.mapInArrow(run, "keys binary, y binary, bins binary, margin binary"))


def _blocks(batches: Iterator[pa.RecordBatch], width: int, since: Sequence[Tree]):
    """(block as written, keys, labels, bins, margins after the trees `since`)."""
    for batch in batches:
        for i in range(batch.num_rows):
            keys, y, margin = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((0, np.int64), (1, float), (3, float)))
            bins = _unpacked(batch.column(2).slice(i, 1), width * len(keys)).reshape(width, len(keys))
            for tree in since:
                margin = margin + tree.value[tree.node_of(bins)]
            yield batch.slice(i, 1), keys, y, bins, margin


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One cell with the sum of the cells of whole numbers."""
    total = None
    for batch in batches:
        for cell in batch.column(0):
            sums = np.frombuffer(cell.as_buffer(), np.int64)
            total = sums.copy() if total is None else total + sums
    if total is not None:
        yield pa.RecordBatch.from_arrays([_cell(total)], ["sums"])


def _level_sums(rows: DataFrame, tasks: int, width: int, wide: int, since: Sequence[Tree], tree: Tree, number: int, open_nodes: Sequence[int], seed: int, share: float):
    """Gradient and hessian (open nodes, features, bins) of the rows that the tree sees; the last bin is for missing values.

    Every task returns one cell of the model's size. The driver adds up `MERGED` cells at most: more are first added by tasks.
    """
    slot_of = np.full(len(tree.feature), -1)
    slot_of[list(open_nodes)] = np.arange(len(open_nodes))
    nodes = len(open_nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, nodes, width, wide), np.int64)
        for _, keys, y, bins, margin in _blocks(batches, width, since):
            p = sigmoid(margin)
            slot = slot_of[tree.node_of(bins)]
            seen = (slot >= 0) & _drawn(keys, number, seed, share)
            # whole numbers below 2^27 each: a float sum of a block is exact up to 2^26 rows
            parts = np.rint((p - y) * UNIT) * seen, np.rint(p * (1 - p) * UNIT) * seen
            first = np.maximum(slot, 0) * wide + 1
            for f in range(width):
                at = first + bins[f]
                for k, x in enumerate(parts):
                    sums[k, :, f] += np.bincount(at, x, minlength=nodes * wide).astype(np.int64).reshape(nodes, wide)
        yield pa.RecordBatch.from_arrays([_cell(np.roll(sums, -1, axis=3))], ["sums"])

    cells = rows.mapInArrow(run, "sums binary")
    while tasks > MERGED:
        tasks = -(-tasks // MERGED)
        cells = cells.repartition(tasks).mapInArrow(_added, "sums binary")
    out = np.zeros((2, nodes, width, wide))
    for total in _added(cells.toArrow().to_batches()):
        out += np.frombuffer(total.column(0)[0].as_buffer(), np.int64).reshape(out.shape) / UNIT
    return out


def best_split(g: np.ndarray, h: np.ndarray, cuts: Sequence[np.ndarray], ridge: float, min_child_weight: float):
    """(gain, feature, cut, missing left, G and H of the left side) of one node, or None.

    `g`, `h`: sums per (feature, bin), missing values last. On a tie the first feature, the smaller cut, missing right.
    """
    all_g, all_h = g[0].sum(), h[0].sum()
    below_g, below_h = g[:, :-1].cumsum(axis=1), h[:, :-1].cumsum(axis=1)
    lg = np.stack([below_g, below_g + g[:, -1:]], axis=2)
    lh = np.stack([below_h, below_h + h[:, -1:]], axis=2)
    rg, rh = all_g - lg, all_h - lh
    gain = lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - all_g**2 / (all_h + ridge)
    real = np.arange(gain.shape[1])[None, :] < np.array([len(c) for c in cuts])[:, None]
    gain[(lh < min_child_weight) | (rh < min_child_weight) | ~real[:, :, None]] = -np.inf
    top = gain.max(initial=-np.inf)
    if not top > 1e-6:
        return None
    f, c, missing_left = (int(x[0]) for x in np.nonzero(gain >= top - 1e-9))
    return float(gain[f, c, missing_left]), f, c, bool(missing_left), float(lg[f, c, missing_left]), float(lh[f, c, missing_left])


def prune(tree: Tree, min_gain: float) -> None:
    """From below: a split between two leaves that saves less than `min_gain` becomes a leaf."""
    for node in range(len(tree.feature) // 2 - 1, -1, -1):
        children = (2 * node + 1, 2 * node + 2)
        if tree.feature[node] >= 0 and all(tree.feature[c] < 0 for c in children) and tree.gain[node] < min_gain:
            tree.feature[node], tree.gain[node] = -1, 0.0
            for c in children:
                tree.value[c] = tree.weight[c] = 0.0


def train(
    df: DataFrame, features: Sequence[str], label: str, seed: int = 1729, rounds: int = 50, depth: int = 5, rate: float = 0.2,
    share: float = 0.7, min_child_weight: float = 6.0, min_gain: float = 4.0, ridge: float = 1.0, bins: int = BINS,
) -> BoostedTrees:
    """Rows without a label are left out; a null or NaN feature is a missing value. Without rows all odds are even."""
    cuts = cut_points(df.where(F.col(label).isNotNull()), features, bins)
    rows = _block_rows(df, features, label, cuts)
    tasks = rows.rdd.getNumPartitions()
    width, wide = len(features), max([len(c) for c in cuts], default=0) + 2
    trees: list[Tree] = []
    since: list[Tree] = []
    for number in range(rounds):
        tree = Tree(depth)
        open_nodes = [0]
        for level in range(depth):
            if not open_nodes:
                break
            g, h = _level_sums(rows, tasks, width, wide, since, tree, number, open_nodes, seed, share)
            coming = []
            for slot, node in enumerate(open_nodes):
                node_g, node_h = g[slot, 0].sum(), h[slot, 0].sum()
                tree.value[node], tree.weight[node] = -rate * node_g / (node_h + ridge), node_h
                found = best_split(g[slot], h[slot], cuts, ridge, min_child_weight)
                if found is None:
                    continue
                tree.gain[node], tree.feature[node], tree.cut[node], tree.missing_left[node], left_g, left_h = found
                sides = ((2 * node + 1, left_g, left_h), (2 * node + 2, node_g - left_g, node_h - left_h))
                for child, child_g, child_h in sides:
                    tree.value[child], tree.weight[child] = -rate * child_g / (child_h + ridge), child_h
                # a side too light to be split again is a leaf already
                coming += [child for child, _, child_h in sides if child_h >= 2 * min_child_weight]
            open_nodes = coming
        prune(tree, min_gain)
        trees.append(tree)
        since.append(tree)
        if len(since) == WRITTEN_EVERY and number + 1 < rounds:
            rows, since = _with_margins(rows, width, since), []
            tasks = rows.rdd.getNumPartitions()
    return BoostedTrees(tuple(features), cuts, tuple(trees))


def _with_margins(rows: DataFrame, width: int, since: Sequence[Tree]) -> DataFrame:
    since = list(since)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, margin in _blocks(batches, width, since):
            yield pa.RecordBatch.from_arrays([*block.columns[:3], _cell(margin)], block.schema.names)

    return cut_lineage(rows.mapInArrow(run, rows.schema))


def score(model: BoostedTrees, df: DataFrame, out: str = "p") -> DataFrame:
    """Every row with its probability."""
    width = len(model.features)

    @F.arrow_udf(T.DoubleType())
    def probability(values: pa.Array) -> pa.Array:
        return pa.array(sigmoid(model.raw(_matrix(values, width, float))))

    return df.withColumn(out, probability(_values(df, model.features)))


NODES = "tree int, node int, feature string, cut double, missing_left boolean, gain double, weight double, value double"


def nodes(model: BoostedTrees, spark: SparkSession) -> DataFrame:
    """One row per node: inner nodes with feature, cut (values up to it go left), side of missing values and gain; leaves with their value."""
    rows = []
    for number, tree in enumerate(model.trees):
        for node in np.flatnonzero((tree.feature >= 0) | (np.arange(len(tree.feature)) == 0) | _has_parent(tree)).tolist():
            f = int(tree.feature[node])
            split = (model.features[f], float(model.cuts[f][tree.cut[node]]), bool(tree.missing_left[node]), float(tree.gain[node])) if f >= 0 else (None,) * 4
            rows.append((number, node, *split, float(tree.weight[node]), None if f >= 0 else float(tree.value[node])))
    return spark.createDataFrame(rows, NODES)


def _has_parent(tree: Tree) -> np.ndarray:
    node = np.arange(len(tree.feature))
    return (node > 0) & (tree.feature[np.maximum(node - 1, 0) // 2] >= 0)


def importance(model: BoostedTrees) -> list[tuple[str, float]]:
    """Share of each feature in the loss saved by all splits; zeros where nothing was split."""
    total = np.zeros(len(model.features))
    for tree in model.trees:
        inner = tree.feature >= 0
        np.add.at(total, tree.feature[inner], tree.gain[inner])
    return [(f, float(x)) for f, x in zip(model.features, total / (total.sum() or 1.0))]
