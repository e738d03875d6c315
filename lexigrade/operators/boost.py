"""Second-order boosted trees with exact greedy splits, one booster per class.

Trees of all classes grow together, level by level. One level is one pass over the packed rows: a task routes its
rows through the trees known so far and adds up gradient, hessian and rows per feature value, one column per node of
each class. These histograms are combined over buckets of features and kept for one level: of two children only the
smaller one is built from the rows, its sibling is the parent's histogram without it, and the sums of the root come
from the same pass. The best split of every node is searched where its histogram lies. Only chosen splits (classes x nodes)
reach the driver. Rows carry no per-round state: the margins of finished rounds are written out every few rounds, so
a lost executor costs at most those few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrade.functions.numeric import sigmoid
from lexigrade.functions.packed import list_column, list_parts
from lexigrade.operators.linear import argmax_class, row_normalised
from lexigrade.session import write_stage

# Gains are compared with nine digits, so that equal splits tie and the order decides.
GAIN_SCALE = 1e9
# Distinct values of one feature that a single histogram row may hold.
WINDOW_VALUES = 2_000
# Ranges into which the values of a feature with more of them are cut: at least, and at most.
VALUE_RANGES, MOST_RANGES = 64, 4096
# Groups of features per shuffle partition, at least; distinct values that a group of ranges may hold.
BUCKETS_PER_PARTITION, BUCKET_VALUES = 2, 16_000
# Numbers of a block of rows with its sums, and of the sums that a task holds before it passes them on.
BLOCK_CELLS, HELD_CELLS = 500_000, 1_000_000

SUMS = ("g", "h", "n")


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    min_samples_split: int = 2
    min_impurity_decrease: float = 1e-7
    reg_lambda: float = 1.0
    gamma: float = 0.0
    base_score: float = 0.5
    # Rounds between two written copies of the margins.
    write_every: int = 10

    @property
    def init_logit(self) -> float:
        return float(np.log(self.base_score / (1.0 - self.base_score)))


@dataclass(frozen=True)
class Node:
    """Heap node: children of ``i`` are ``2i+1`` (value below the threshold) and ``2i+2``."""

    target: int
    round: int
    node_id: int
    feature_id: int | None
    threshold: float | None
    value: float | None


@dataclass(frozen=True)
class Totals:
    """Gradient, hessian and row count of a node."""

    g: float
    h: float
    n: int


@dataclass(frozen=True)
class BoostModel:
    classes: tuple[int, ...]
    params: BoostParams
    nodes: tuple[Node, ...]

    def tree_table(self, spark: SparkSession) -> DataFrame:
        rows = [(n.target, n.round, n.node_id, n.feature_id, n.threshold, n.value) for n in self.nodes]
        return spark.createDataFrame(rows, TREE_SCHEMA)

    @classmethod
    def from_table(cls, trees: DataFrame, classes: tuple[int, ...], params: BoostParams) -> BoostModel:
        return cls(classes, params, tuple(Node(*r) for r in trees.select(*TREE_COLUMNS).collect()))


TREE_SCHEMA = "class int, round int, node_id int, feature_id int, threshold double, value double"
TREE_COLUMNS = ("class", "round", "node_id", "feature_id", "threshold", "value")


# -- formulas ---------------------------------------------------------------------------------------


def init_logit(base_score: Column) -> Column:
    return F.ln(base_score / (1.0 - base_score))


def grad_hess(p: Column, target: Column) -> tuple[Column, Column]:
    return p - target, p * (1.0 - p)


def split_gain(g: Column, h: Column, g_left: Column, h_left: Column, reg_lambda: float, gamma: float) -> Column:
    def score(gs: Column, hs: Column) -> Column:
        return gs * gs / (hs + reg_lambda)

    return 0.5 * (score(g_left, h_left) + score(g - g_left, h - h_left) - score(g, h)) - gamma


def leaf_value(g: Column, h: Column, reg_lambda: float) -> Column:
    return -g / (h + reg_lambda)


# -- routing ----------------------------------------------------------------------------------------


def _columns_of(part: pa.RecordBatch, features: np.ndarray) -> np.ndarray:
    """Dense values of the given, sorted, features; one extra zero column stands for all others."""
    lengths, ids = list_parts(part.column("ids"))
    _, vals = list_parts(part.column("vals"))
    dense = np.zeros((part.num_rows, len(features) + 1))
    if len(features) and len(ids):
        at = np.minimum(np.searchsorted(features, ids), len(features) - 1)
        used = features[at] == ids
        dense[np.repeat(np.arange(part.num_rows), lengths)[used], at[used]] = vals[used]
    return dense


def _route(dense: np.ndarray, features: np.ndarray, tree: dict[int, Node], depth: int) -> np.ndarray:
    """Heap node of every row after at most ``depth`` tests; a leaf keeps its rows."""
    at = np.zeros(len(dense), dtype=np.int64)
    for _ in range(depth):
        for node_id in np.unique(at):
            node = tree.get(int(node_id))
            if node is not None and node.feature_id is not None:
                here = np.flatnonzero(at == node_id)
                left = dense[here, np.searchsorted(features, node.feature_id)] < node.threshold
                at[here] = 2 * node_id + np.where(left, 1, 2)
    return at


def _by_tree(nodes: Iterable[Node]) -> dict[tuple[int, int], dict[int, Node]]:
    trees: dict[tuple[int, int], dict[int, Node]] = {}
    for n in nodes:
        trees.setdefault((n.round, n.target), {})[n.node_id] = n
    return trees


def _used_features(nodes: Iterable[Node]) -> np.ndarray:
    return np.array(sorted({n.feature_id for n in nodes if n.feature_id is not None}), dtype=np.int64)


def _leaf_values(dense: np.ndarray, features: np.ndarray, tree: dict[int, Node]) -> np.ndarray:
    """Leaf value of every row in one tree."""
    value = np.zeros(max(tree) + 1)
    for node_id, node in tree.items():
        value[node_id] = node.value if node.value is not None else 0.0
    return value[_route(dense, features, tree, max(tree).bit_length())]


def _add_trees(logits: np.ndarray, part: pa.RecordBatch, classes: Sequence[int], nodes: Sequence[Node], rate: float) -> np.ndarray:
    """Logits plus the damped outputs of whole trees, in round order."""
    features = _used_features(nodes)
    dense = _columns_of(part, features)
    column = {c: i for i, c in enumerate(classes)}
    for (_, target), tree in sorted(_by_tree(nodes).items()):
        logits[:, column[target]] += rate * _leaf_values(dense, features, tree)
    return logits


def _slices(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, BLOCK_CELLS // max(1, width))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def boost_logits(vectors: DataFrame, model: BoostModel, keep: tuple[str, ...], base: str | None = None) -> DataFrame:
    """``(keep..., scores)``: initial logit plus all trees, per class. Map-only.

    ``base`` names a column with logits to start from.
    """
    classes, nodes, params = model.classes, model.nodes, model.params
    width = len(_used_features(nodes)) + len(classes)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, width):
            if base:
                logits = list_parts(part.column(base))[1].reshape(part.num_rows, len(classes)).copy()
            else:
                logits = np.full((part.num_rows, len(classes)), params.init_logit)
            logits = _add_trees(logits, part, classes, nodes, params.learning_rate)
            columns = [part.column(name) for name in keep] + [list_column(logits)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "scores"])

    wanted = list(dict.fromkeys((*keep, "ids", "vals", *([base] if base else []))))
    fields = [vectors.schema[name] for name in keep] + [T.StructField("scores", T.ArrayType(T.DoubleType()))]
    return vectors.select(*wanted).mapInArrow(score, T.StructType(fields))


def apply_trees(vectors: DataFrame, trees: DataFrame) -> DataFrame:
    """``(doc_id, class, round, value)``: the leaf value of every row in every tree of the table, in one pass."""
    nodes = [Node(*r) for r in trees.select(*TREE_COLUMNS).collect()]
    by_tree = sorted(_by_tree(nodes).items())
    features = _used_features(nodes)

    def values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, len(features) + len(by_tree)):
            dense = _columns_of(part, features)
            out = np.stack([_leaf_values(dense, features, tree) for _, tree in by_tree], axis=1)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), list_column(out)], names=["doc_id", "values"])

    fields = [vectors.schema["doc_id"], T.StructField("values", T.ArrayType(T.DoubleType()))]
    applied = vectors.select("doc_id", "ids", "vals").mapInArrow(values, T.StructType(fields))
    names = F.array(*[F.struct(F.lit(target).alias("class"), F.lit(round_id).alias("round")) for (round_id, target), _ in by_tree])
    cells = applied.select("doc_id", F.posexplode("values").alias("tree", "value")).withColumn("of", F.get(names, F.col("tree")))
    return cells.select("doc_id", "of.class", "of.round", "value")


# -- growing ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ValueStats:
    """What the split search must know about the values: ``cuts`` is None while every feature has few of them, about ``distinct`` at most."""

    has_negative: bool
    cuts: dict[int, np.ndarray] | None
    distinct: int = 0

    @property
    def ranges(self) -> int:
        """Ranges of a feature, at most."""
        return 1 + max(map(len, self.cuts.values()), default=0) if self.cuts else 1

    def buckets(self, partitions: int) -> int:
        """Groups into which features and ranges are dealt: their number grows with the values, their size does not."""
        fewest = BUCKETS_PER_PARTITION * partitions
        if not self.cuts:
            return fewest
        together = max(1, BUCKET_VALUES // (1 + self.distinct // self.ranges))
        return max(fewest, -(-len(self.cuts) * self.ranges // together))


def value_stats(rows: DataFrame) -> ValueStats:
    """One row per feature reaches the driver. The estimate of distinct values only sets the number of ranges."""
    long = rows.select(F.inline(F.arrays_zip("ids", "vals")))
    per_feature = long.groupBy("ids").agg(F.approx_count_distinct("vals").alias("distinct"), F.min("vals").alias("low"))
    overall = per_feature.agg(F.max("distinct").alias("distinct"), F.min("low").alias("low")).first()
    has_negative = (overall["low"] or 0.0) < 0
    distinct = overall["distinct"] or 0
    if distinct <= WINDOW_VALUES:
        return ValueStats(has_negative, None, distinct)
    ranges = min(MOST_RANGES, max(VALUE_RANGES, -(-distinct // max(1, WINDOW_VALUES))))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = long.groupBy("ids").agg(F.percentile_approx("vals", probabilities, max(1000, 10 * ranges)).alias("cuts"))
    return ValueStats(has_negative, {r["ids"]: np.array(sorted({0.0, *r["cuts"]})) for r in cuts.collect()}, distinct)


def _gradients(part: pa.RecordBatch, classes: tuple[int, ...], done: Sequence[Node], params: BoostParams) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the logistic loss, rows x classes."""
    logits = list_parts(part.column("logits"))[1].reshape(part.num_rows, len(classes)).copy()
    logits = _add_trees(logits, part, classes, done, params.learning_rate)
    with np.errstate(over="ignore"):  # a very negative logit is a plain 0 probability
        p = 1.0 / (1.0 + np.exp(-logits))
    return p - (part.column("y").to_numpy()[:, None] == np.array(classes)[None, :]), p * (1.0 - p)


# -- histograms -------------------------------------------------------------------------------------
#
# A histogram row holds the cells of one feature, or of one range of its values: the distinct values in order, and for each of them
# the sums of all slots. A slot is a node of a class; feature -1 holds the sums over all rows of the slots.

TOTALS = -1
_HIST = "bucket int, feature_id int, vrange int, vals array<double>, g array<double>, h array<double>, n array<double>"
_HIST_NAMES = ("bucket", "feature_id", "vrange", "vals", *SUMS)

Slot = tuple[int, int]


class _Cells:
    """Sums by (feature, range, value), one column per slot; what is added is combined before it leaves a task."""

    def __init__(self, width: int) -> None:
        self.width, self.parts, self.size = width, [], 0

    def add(self, feature: np.ndarray, vrange: np.ndarray, value: np.ndarray, sums: Sequence[np.ndarray]) -> None:
        if len(feature):
            self.parts.append((feature, vrange, value, *sums))
            self.size += len(feature)

    def add_table(self, table: pa.Table, first: int, width: int) -> None:
        """Histogram rows whose slots become the columns from ``first`` on."""
        if not table.num_rows:
            return
        lengths, vals = list_parts(table.column("vals").combine_chunks())
        feature, vrange = (np.repeat(table.column(c).to_numpy(), lengths) for c in ("feature_id", "vrange"))
        sums = []
        for name in SUMS:
            matrix = np.zeros((len(vals), self.width))
            matrix[:, first : first + width] = list_parts(table.column(name).combine_chunks())[1].reshape(len(vals), width)
            sums.append(matrix)
        self.add(feature, vrange, vals, sums)

    def combined(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            none = np.zeros(0, dtype=np.int64)
            return (none, none, np.zeros(0), *[np.zeros((0, self.width))] * 3)
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        order = np.lexsort((columns[2], columns[1], columns[0]))
        feature, vrange, value = (c[order] for c in columns[:3])
        fresh = np.ones(len(order), bool)
        fresh[1:] = (feature[1:] != feature[:-1]) | (vrange[1:] != vrange[:-1]) | (value[1:] != value[:-1])
        starts = np.flatnonzero(fresh)
        out = (feature[starts], vrange[starts], value[starts], *[np.add.reduceat(c[order], starts, axis=0) for c in columns[3:]])
        self.parts, self.size = [out], len(starts)
        return out


def _packed(cells: tuple[np.ndarray, ...], buckets: int, ranges: int = 1) -> pa.RecordBatch:
    feature, vrange, value, *sums = cells
    width = sums[0].shape[1]
    fresh = np.ones(len(feature), bool)
    fresh[1:] = (feature[1:] != feature[:-1]) | (vrange[1:] != vrange[:-1])
    starts = np.flatnonzero(fresh)
    offsets = np.append(starts, len(feature))
    lists = lambda flat, step: pa.ListArray.from_arrays(pa.array(offsets * step, pa.int32()), pa.array(flat))
    bucket = (feature[starts] * ranges + vrange[starts]) % buckets
    columns = [pa.array(c.astype(np.int32)) for c in (bucket, feature[starts], vrange[starts])]
    columns += [lists(value, 1), *[lists(np.ascontiguousarray(m).ravel(), width) for m in sums]]
    return pa.RecordBatch.from_arrays(columns, names=list(_HIST_NAMES))


def _partial_histograms(
    rows: DataFrame,
    classes: tuple[int, ...],
    depth: int,
    slots: Sequence[Slot],
    done: Sequence[Node],
    growing: Sequence[Node],
    stats: ValueStats,
    params: BoostParams,
) -> DataFrame:
    """Histogram rows of each task. ``done`` are the trees since ``logits`` was written, ``growing`` those of this round."""
    grown, growing_features = _by_tree(growing), _used_features(growing)
    round_id = max((n.round for n in growing), default=0)
    cuts, width = stats.cuts, len(slots)
    of_class = {c: [(i, node) for i, (target, node) in enumerate(slots) if target == c] for c in classes}
    buckets, n_ranges = stats.buckets(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), stats.ranges

    def ranges(ids: np.ndarray, vals: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), dtype=np.int64)
        if cuts is not None:
            starts = np.flatnonzero(np.diff(ids, prepend=-1))
            for start, end in zip(starts, [*starts[1:], len(ids)]):
                out[start:end] = np.searchsorted(cuts[ids[start]], vals[start:end], side="right")
        return out

    def sums_of(part: pa.RecordBatch, held: _Cells) -> None:
        g, h = _gradients(part, classes, done, params)
        dense = _columns_of(part, growing_features)
        lengths, ids = list_parts(part.column("ids"))
        _, vals = list_parts(part.column("vals"))
        row = np.repeat(np.arange(part.num_rows), lengths)
        filled = vals != 0
        ids, vals, row = ids[filled], vals[filled], row[filled]
        # One code per distinct (feature, value) of this batch; the last code stands for all rows.
        order = np.lexsort((vals, ids))
        ids, vals, row = ids[order], vals[order], row[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (vals[1:] != vals[:-1])
        n_cells = int(fresh.sum())
        code = np.concatenate([np.cumsum(fresh) - 1, np.full(part.num_rows, n_cells)])
        row = np.concatenate([row, np.arange(part.num_rows)])
        sums = [np.zeros((n_cells + 1, width)) for _ in SUMS]
        for k, target in enumerate(classes):
            mine = of_class[target]
            if not mine:
                continue
            place = np.full(2 ** (depth + 1), -1, dtype=np.int64)
            place[[node for _, node in mine]] = np.arange(len(mine))
            where = place[_route(dense, growing_features, grown.get((round_id, target), {}), depth)]
            live = where[row] >= 0
            key, at = code[live] * len(mine) + where[row[live]], row[live]
            columns = [i for i, _ in mine]
            for matrix, weight in zip(sums, (g[at, k], h[at, k], None)):
                matrix[:, columns] = np.bincount(key, weight, (n_cells + 1) * len(mine)).reshape(n_cells + 1, len(mine))
        used = np.flatnonzero(sums[2].any(axis=1))
        feature = np.append(ids[fresh], TOTALS)[used]
        value = np.append(vals[fresh], 0.0)[used]
        vrange = np.append(ranges(ids[fresh], vals[fresh]), 0)[used]
        held.add(feature.astype(np.int64), vrange, value, [m[used] for m in sums])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, most = _Cells(width), max(1, HELD_CELLS // max(1, width))
        for batch in batches:
            cells = max(1, int(batch.column("ids").flatten().__len__()) // max(1, batch.num_rows))
            # A row adds at most its cells, each with all slots.
            for part in _slices([batch], len(_used_features(done)) + len(growing_features) + 4 * len(classes) + cells * width):
                sums_of(part, held)
                if held.size > most:
                    cells_now = held.combined()
                    if held.size > most // 2:
                        yield _packed(cells_now, buckets, n_ranges)
                        held = _Cells(width)
        if held.parts:
            yield _packed(held.combined(), buckets, n_ranges)

    return rows.select("y", "ids", "vals", "logits").mapInArrow(partial, _HIST)


def node_histograms(
    rows: DataFrame,
    classes: tuple[int, ...],
    depth: int,
    open_nodes: dict[int, list[int]],
    done: Sequence[Node],
    growing: Sequence[Node],
    stats: ValueStats,
    params: BoostParams,
) -> DataFrame:
    """Histograms of the given nodes, straight from the rows; their slots are the sorted (class, node) pairs."""
    slots = sorted((c, node) for c, nodes in open_nodes.items() for node in nodes)
    parts = _partial_histograms(rows, classes, depth, slots, done, growing, stats, params)
    width = len(slots)

    def merge(table: pa.Table) -> pa.Table:
        cells = _Cells(width)
        cells.add_table(table, 0, width)
        return pa.Table.from_batches([_packed_in(cells.combined(), table)])

    return parts.groupBy("bucket").applyInArrow(merge, _HIST)


def _packed_in(cells: tuple[np.ndarray, ...], table: pa.Table) -> pa.RecordBatch:
    """Histogram rows of one bucket."""
    batch = _packed(cells, 1)
    bucket = pa.array(np.full(batch.num_rows, table.column("bucket")[0].as_py(), np.int32))
    return pa.RecordBatch.from_arrays([bucket, *batch.columns[1:]], names=list(_HIST_NAMES))


@dataclass(frozen=True)
class Level:
    """Slots of a level: those built from the rows and, by the place of parent and sibling, those that are the rest of the parent."""

    slots: list[Slot]
    built: list[Slot]
    derived: dict[Slot, tuple[int, int]]


def child_histograms(
    rows: DataFrame,
    parents: DataFrame,
    n_parents: int,
    classes: tuple[int, ...],
    depth: int,
    level: Level,
    done: Sequence[Node],
    growing: Sequence[Node],
    stats: ValueStats,
    params: BoostParams,
) -> DataFrame:
    """Histograms of the next level: only the smaller child of a node is built, its sibling is the parent without it."""
    parts = _partial_histograms(rows, classes, depth, level.built, done, growing, stats, params)
    place = {slot: i for i, slot in enumerate(level.built)}
    n_built, width = len(level.built), len(level.slots)

    def subtract(small: pa.Table, parent: pa.Table) -> pa.Table:
        cells = _Cells(n_parents + n_built)
        cells.add_table(parent, 0, n_parents)
        cells.add_table(small, n_parents, n_built)
        feature, vrange, value, *both = cells.combined()
        out = [np.zeros((len(feature), width)) for _ in SUMS]
        for at, slot in enumerate(level.slots):
            for matrix, given in zip(out, both):
                if slot in place:
                    matrix[:, at] = given[:, n_parents + place[slot]]
                else:
                    above, sibling = level.derived[slot]
                    matrix[:, at] = given[:, above] - given[:, n_parents + sibling]
        # Cells without rows are exactly empty, whatever rounding left of their sums.
        out[0][out[2] == 0] = out[1][out[2] == 0] = 0.0
        used = out[2].any(axis=1)
        table = parent if parent.num_rows else small
        return pa.Table.from_batches([_packed_in((feature[used], vrange[used], value[used], *[m[used] for m in out]), table)])

    return parts.groupBy("bucket").cogroup(parents.groupBy("bucket")).applyInArrow(subtract, _HIST)


def root_totals(hist: DataFrame, classes: tuple[int, ...]) -> dict[Slot, Totals]:
    """Gradient, hessian and row count of every class over all rows, token-free ones included, from the histograms of the roots."""
    row = hist.where(F.col("feature_id") == TOTALS).select(*SUMS).first()
    if row is None:
        return {(c, 0): Totals(0.0, 0.0, 0) for c in classes}
    return {(c, 0): Totals(row["g"][i], row["h"][i], int(row["n"][i])) for i, c in enumerate(sorted(classes))}


# -- split search -----------------------------------------------------------------------------------

_BEFORE = tuple(f"{c}_before" for c in SUMS)
_ZERO = (*[f"{c}_below" for c in SUMS], "filled")


def _with_offsets(hist: DataFrame, width: int) -> DataFrame:
    """Histogram rows of value ranges with the sums of the ranges farther from zero; the lowest range also has the feature's negative sums."""
    sides = "feature_id int, vrange int, positive boolean, g array<double>, h array<double>, n array<double>"

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, vals = list_parts(batch.column("vals"))
            starts = np.cumsum(lengths) - lengths
            sums = [np.add.reduceat(list_parts(batch.column(c))[1].reshape(len(vals), width), starts, axis=0) for c in SUMS]
            columns = [batch.column("feature_id"), batch.column("vrange"), pa.array(vals[starts] > 0), *[list_column(m) for m in sums]]
            yield pa.RecordBatch.from_arrays(columns, names=["feature_id", "vrange", "positive", *SUMS])

    def offsets(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vrange")
        positive = table.column("positive").to_numpy()
        sums = [list_parts(table.column(c).combine_chunks())[1].reshape(len(positive), width) for c in SUMS]
        before = []
        for m in sums:
            low, high = np.cumsum(np.where(positive[:, None], 0, m), axis=0) - np.where(positive[:, None], 0, m), m[::-1]
            high = np.cumsum(np.where(positive[::-1, None], high, 0), axis=0)[::-1] - np.where(positive[:, None], m, 0)
            before.append(np.where(positive[:, None], high, low))
        zero = [m[~positive].sum(axis=0) for m in sums] + [sums[2].sum(axis=0)]
        lists = [pa.array([z.tolist()] + [None] * (len(positive) - 1), pa.list_(pa.float64())) for z in zero]
        columns = {"f": table.column("feature_id"), "r": table.column("vrange")}
        columns |= {name: list_column(m) for name, m in zip(_BEFORE, before)} | dict(zip(_ZERO, lists))
        return pa.table(columns)

    schema = "f int, r int, " + ", ".join(f"{c} array<double>" for c in (*_BEFORE, *_ZERO))
    cells = hist.where(F.col("feature_id") != TOTALS)
    ahead = cells.mapInArrow(lambda batches: totals(b for b in batches if b.num_rows), sides).groupBy("feature_id").applyInArrow(offsets, schema)
    return cells.join(ahead, (F.col("feature_id") == F.col("f")) & (F.col("vrange") == F.col("r"))).drop("f", "r")


@dataclass
class _Thresholds:
    """Candidates of one histogram row in ascending order: thresholds x slots."""

    feature: int
    value: np.ndarray
    left: list[np.ndarray]
    gain: np.ndarray
    valid: np.ndarray


def _thresholds(batch: pa.RecordBatch, total: np.ndarray, ranged: bool, params: BoostParams) -> Iterator[_Thresholds]:
    """Zero cells are implicit: above zero the left side is the node total minus the cells from the threshold upwards, below zero the
    sum of the cells under it. Zero itself is a threshold where a feature has negative cells and empty ones."""
    width = total.shape[1]
    lengths, vals = list_parts(batch.column("vals"))
    ends = np.cumsum(lengths)
    sums = [list_parts(batch.column(c))[1].reshape(-1, width) for c in SUMS]
    extra = {c: batch.column(c).to_pylist() for c in (*_BEFORE, *_ZERO)} if ranged else {}
    score = lambda gs, hs: gs * gs / (hs + params.reg_lambda)
    for i, feature in enumerate(batch.column("feature_id").to_pylist()):
        if feature == TOTALS:
            continue
        value = vals[ends[i] - lengths[i] : ends[i]]
        own = [m[ends[i] - lengths[i] : ends[i]] for m in sums]
        split = int(np.searchsorted(value, 0.0))
        left = []
        for c, m in enumerate(own):
            before = np.array(extra[_BEFORE[c]][i]) if ranged else 0.0
            low = before + np.cumsum(m[:split], axis=0) - m[:split]
            high = total[c] - (before + np.cumsum(m[split:][::-1], axis=0)[::-1])
            left.append(np.vstack([low, high]))
        valid = (own[2] > 0) & (left[2] > 0)
        below, filled = None, None
        if ranged:
            if extra["filled"][i] is not None:
                below, filled = [np.array(extra[c][i]) for c in _ZERO[:3]], np.array(extra["filled"][i])
        elif split:
            below, filled = [m[:split].sum(axis=0) for m in own], own[2].sum(axis=0)
        if below is not None:
            value = np.insert(value, split, 0.0)
            left = [np.insert(m, split, z, axis=0) for m, z in zip(left, below)]
            valid = np.insert(valid, split, (below[2] > 0) & (filled < total[2]), axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):  # slots that are not searched have no totals
            gain = 0.5 * (score(left[0], left[1]) + score(total[0] - left[0], total[1] - left[1]) - score(total[0], total[1])) - params.gamma
        yield _Thresholds(feature, value, left, gain, valid)


_CANDIDATE = "class int, node int, feature_id int, threshold double, gain double, g_left double, h_left double, n_left long"


def _candidate_batch(slots: np.ndarray, at: np.ndarray, feature: np.ndarray, value: np.ndarray, gain: np.ndarray, left: Sequence[np.ndarray]) -> pa.RecordBatch:
    columns = [slots[at, 0].astype(np.int32), slots[at, 1].astype(np.int32), feature.astype(np.int32), value, gain, left[0], left[1], left[2].astype(np.int64)]
    names = [field.split(" ")[0] for field in _CANDIDATE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _search(hist: DataFrame, totals: dict[Slot, Totals], stats: ValueStats, params: BoostParams, slots: Sequence[Slot], best_only: bool) -> DataFrame:
    """Candidates of the slots in ``totals``: all of them, or the best of each slot and task."""
    ranged, width = stats.cuts is not None, len(slots)
    total = np.array([[getattr(totals.get(s, Totals(0.0, 0.0, 0)), c) for s in slots] for c in SUMS], dtype=float).reshape(len(SUMS), width)
    wanted = np.array([s in totals for s in slots], dtype=bool)
    named = np.array(slots, dtype=np.int64).reshape(width, 2)
    source = _with_offsets(hist, width) if ranged else hist

    def every(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in _thresholds(batch, total, ranged, params):
                cell, slot = np.nonzero(t.valid & wanted)
                yield _candidate_batch(named, slot, np.full(len(cell), t.feature), t.value[cell], t.gain[cell, slot], [m[cell, slot] for m in t.left])

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every_slot = np.arange(width)
        # Loss, feature, threshold: compared in this order; then gain and the left sums.
        found = np.full((7, width), np.inf)
        for batch in batches:
            for t in _thresholds(batch, total, ranged, params):
                loss = np.where(t.valid & wanted, -np.rint(t.gain * GAIN_SCALE), np.inf)
                first = np.argmin(loss, axis=0)
                now = np.vstack([loss[first, every_slot], np.full(width, t.feature), t.value[first], t.gain[first, every_slot], *[m[first, every_slot] for m in t.left]])
                tie = now[0] == found[0]
                better = (now[0] < found[0]) | (tie & (now[1] < found[1])) | (tie & (now[1] == found[1]) & (now[2] < found[2]))
                found = np.where(better, now, found)
        at = np.flatnonzero(np.isfinite(found[0]))
        yield _candidate_batch(named, at, *found[1:4, at], found[4:, at])

    return source.select(*_HIST_NAMES[1:], *((*_BEFORE, *_ZERO) if ranged else ())).mapInArrow(best if best_only else every, _CANDIDATE)


def split_candidates(hist: DataFrame, totals: dict[Slot, Totals], stats: ValueStats, params: BoostParams) -> DataFrame:
    """``(class, node, feature_id, threshold, gain, g_left, h_left, n_left)`` of every non-empty split ``value < threshold``.

    ``totals`` are those of all slots of the histograms.
    """
    return _search(hist, totals, stats, params, sorted(totals), False)


def best_splits(candidates: DataFrame) -> DataFrame:
    """The candidate of every node with the largest gain, then the lowest feature, then the lowest threshold.

    A plain minimum over an ordering struct: it combines before the shuffle, whatever the number of candidates.
    """
    rest = ("feature_id", "threshold", "gain", "g_left", "h_left", "n_left")
    order = F.struct((-F.rint(F.col("gain") * GAIN_SCALE)).alias("loss"), *rest)
    best = candidates.groupBy("class", "node").agg(F.min(order).alias("best"))
    return best.select("class", "node", *[f"best.{c}" for c in rest])


def _next_level(splits: dict[Slot, Row], level: dict[Slot, Totals], slots: Sequence[Slot], searched: Callable[[Totals], bool]) -> tuple[dict[Slot, Totals], Level]:
    """Totals of the children, and which of their histograms are built: the smaller child of a node, unless neither is searched."""
    following: dict[Slot, Totals] = {}
    above = {slot: i for i, slot in enumerate(slots)}
    built: list[Slot] = []
    derived: dict[Slot, tuple[int, int]] = {}
    for (target, node), split in sorted(splits.items()):
        t = level[target, node]
        left = Totals(split["g_left"], split["h_left"], split["n_left"])
        right = Totals(t.g - left.g, t.h - left.h, t.n - left.n)
        pair = [((target, 2 * node + 1), left), ((target, 2 * node + 2), right)]
        following |= dict(pair)
        if searched(left) or searched(right):
            (small, _), (large, rest) = sorted(pair, key=lambda p: p[1].n)
            if searched(rest):
                derived[large] = (above[target, node], len(built))
            built.append(small)
    return following, Level(sorted([*built, *derived]), built, derived)


def _grow_round(
    rows: DataFrame, classes: tuple[int, ...], round_id: int, done: Sequence[Node], stats: ValueStats, params: BoostParams
) -> list[Node]:
    """One tree per class, all of them level by level. The histograms of a level are kept until those of the next one are made from them."""
    nodes: list[Node] = []
    hist = node_histograms(rows, classes, 0, {c: [0] for c in classes}, done, (), stats, params).persist()
    kept = [hist]
    try:
        slots: Sequence[Slot] = sorted((c, 0) for c in classes)
        level = root_totals(hist, classes)
        for depth in range(params.max_depth + 1):
            open_ = lambda t, at=depth: at < params.max_depth and t.n >= params.min_samples_split
            wanted = {s: t for s, t in level.items() if open_(t)}
            splits = {}
            if wanted:
                best = best_splits(_search(hist, wanted, stats, params, slots, True))
                splits = {(r["class"], r["node"]): r for r in best.collect() if r["gain"] > params.min_impurity_decrease}
            for slot, t in sorted(level.items()):
                split, leaf = splits.get(slot), -t.g / (t.h + params.reg_lambda)
                tested = (None, None, leaf) if split is None else (split["feature_id"], split["threshold"], None)
                nodes.append(Node(slot[0], round_id, slot[1], *tested))
            level, children = _next_level(splits, level, slots, lambda t, at=depth + 1: at < params.max_depth and t.n >= params.min_samples_split)
            if children.built:
                hist = child_histograms(rows, hist, len(slots), classes, depth + 1, children, done, nodes, stats, params)
                if depth + 2 < params.max_depth:
                    kept.append(hist.persist())
                slots = children.slots
            if len(kept) > 2:
                kept.pop(0).unpersist()
            if not level:
                break
    finally:
        for used in kept:
            used.unpersist()
    return nodes


def with_logits(rows: DataFrame, classes: tuple[int, ...], params: BoostParams) -> DataFrame:
    start = F.array_repeat(F.lit(params.init_logit), len(classes))
    return rows.withColumn("logits", start)


def build_trees(rows: DataFrame, classes: tuple[int, ...], params: BoostParams) -> BoostModel:
    """The first tree of every class from rows ``(y, ids, vals)``."""
    return boost_ovr_fit(rows, classes, replace(params, n_estimators=1))


def boost_ovr_fit(rows: DataFrame, classes: tuple[int, ...], params: BoostParams = BoostParams()) -> BoostModel:
    """One booster per class from rows ``(y, ids, vals)``."""
    stats = value_stats(rows) if params.n_estimators else ValueStats(False, None)
    # Every level reads the rows once; a lost block is computed again from the stored rows.
    state = with_logits(rows.select("y", "ids", "vals"), classes, params).persist()
    nodes: list[Node] = []
    pending: list[Node] = []
    try:
        for round_id in range(params.n_estimators):
            grown = _grow_round(state, classes, round_id, pending, stats, params)
            nodes += grown
            pending += grown
            if (round_id + 1) % params.write_every == 0 and round_id + 1 < params.n_estimators:
                model = BoostModel(classes, params, tuple(pending))
                moved = boost_logits(state, model, ("y", "ids", "vals"), base="logits")
                stored = write_stage(moved.withColumnRenamed("scores", "logits"), "logits")
                state.unpersist()
                state, pending = stored.persist(), []
    finally:
        state.unpersist()
    return BoostModel(tuple(classes), params, tuple(nodes))


def boost_fit(rows: DataFrame, params: BoostParams = BoostParams()) -> BoostModel:
    """A single booster for 0/1 targets ``y``."""
    return boost_ovr_fit(rows, (1,), params)


# -- prediction -------------------------------------------------------------------------------------


def boost_proba(vectors: DataFrame, model: BoostModel, keep: tuple[str, ...]) -> DataFrame:
    """``(keep..., scores)``: probability of every class against the rest; the base score without trees."""
    if not model.nodes:
        base = F.array_repeat(F.lit(float(model.params.base_score)), len(model.classes))
        return vectors.select(*keep, base.alias("scores"))
    return boost_logits(vectors, model, keep).withColumn("scores", F.transform("scores", sigmoid))


def boost_predict(p: Column, threshold: float = 0.5) -> Column:
    """1 from the threshold upwards."""
    return (p >= threshold).cast("int")


def boost_ovr_proba(vectors: DataFrame, model: BoostModel, keep: tuple[str, ...]) -> DataFrame:
    return boost_proba(vectors, model, keep).withColumn("scores", row_normalised(F.col("scores")))


def boost_ovr_predict(vectors: DataFrame, model: BoostModel, keep: tuple[str, ...]) -> DataFrame:
    """Class of the largest probability, compared with twelve digits: classes with the same leaves tie, and the lowest wins."""
    scored = boost_proba(vectors, model, keep)
    return scored.select(*keep, argmax_class(F.transform("scores", lambda s: F.round(s, 12)), model.classes).alias("prediction"))
