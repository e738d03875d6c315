"""L1 logistic regression, one class against the rest.

Three ways to take the same gradient steps:

* all rows, or batches larger than a block: every batch is one distributed gradient over its rows and all classes;
* smaller mini-batches in row order: their steps follow each other, so a job takes a block of many batches, reads only the files with
  its positions, and hands the weights to the next block; rows that fit one block take all their iterations in one job;
* single random rows: the drawn rows (``n_iter`` per class) are fetched by one join and replayed per class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrade.functions.numeric import LOGIT_CLIP, counter_draw
from lexigrade.functions.packed import BUFFERS_SCHEMA, DENSE_WIDTH, PackedRows, buffer_blocks, list_column, list_parts, row_blocks, to_buffers
from lexigrade.operators.evaluate import binary_scores
from lexigrade.operators.linear import LinearModel, argmax_class, linear_scores, probabilities, row_normalised
from lexigrade.session import lookup_side

# Gradient norms averaged by the stopping rule, iterations between two points of the curve.
STOP_WINDOW = 100
CURVE_EVERY = 100
# Cells of the rows that one job of the chain of mini-batches takes.
BLOCK_CELLS = 4_000_000

CELLS = ("tp", "fp", "fn", "tn")
# Arrays per class that Spark leaves of the tasks' partial gradients; numbers up to which the driver adds them as they are.
GRADIENT_PARTS = 32
GRADIENT_CELLS = 4_000_000


@dataclass(frozen=True)
class LogRegParams:
    lr: float = 0.01
    n_iter: int = 1000
    tolerance: float = 1e-6
    alpha: float = 0.01
    # Rows of a mini-batch in row order; None takes all rows at once.
    batch_size: int | None = 256
    # 'auto': single random rows for more than two classes, mini-batches otherwise.
    mode: str = "auto"
    # Seed of the random draws.
    seed: int = 0


@dataclass(frozen=True)
class Snapshot:
    """Weights of one class after ``iteration`` iterations."""

    target: int
    iteration: int
    w: np.ndarray
    b: float


@dataclass
class LogRegFit:
    model: LinearModel
    snapshots: list[Snapshot] = field(default_factory=list)
    iterations: dict[int, int] = field(default_factory=dict)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -LOGIT_CLIP, LOGIT_CLIP)))


def _targets(y: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return (y[:, None] == classes[None, :]).astype(float)


def gradient_parts(rows: DataFrame, model: LinearModel, buffered: bool = False) -> DataFrame:
    """``(class, g)``: the gradient of each task's rows, one array per class with the bias at its end.

    A task adds its rows into one classes x features matrix and emits that once, so what moves is tasks x
    model size, not rows. ``buffered`` rows are those of ``_buffered``.
    """
    weights, bias, classes = np.ascontiguousarray(model.weights.T), model.bias, np.array(model.classes)
    width, blocks = model.n_features, buffer_blocks if buffered else row_blocks

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(classes), width + 1))
        for block in blocks(batches, width):
            error = _logistic(block.dot(weights) + bias) - _targets(block.part.column("y").to_numpy(), classes)
            total[:, :width] += block.weighted_sums(error)
            total[:, width] += error.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int32()), list_column(total)], names=["class", "g"])

    taken = rows if buffered else rows.select("y", "ids", "vals")
    return taken.mapInArrow(partial, "class int, g array<double>")


def _buffered(rows: DataFrame, width: int) -> DataFrame:
    """Blocks of rows as buffers: rows that every step reads again are handed to Python without a conversion."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, width):
            yield to_buffers(block)

    return rows.select("y", "ids", "vals").mapInArrow(pack, BUFFERS_SCHEMA)


def gradient(rows: DataFrame, model: LinearModel) -> DataFrame:
    """``(class, feature_id, g)``: summed gradient of all rows; ``feature_id = -1`` is the bias."""
    cells = gradient_parts(rows, model).select("class", F.posexplode("g").alias("feature_id", "g"))
    summed = cells.groupBy("class", "feature_id").agg(F.sum("g").alias("g"))
    return summed.withColumn("feature_id", F.when(F.col("feature_id") == model.n_features, -1).otherwise(F.col("feature_id")))


def _added(parts: DataFrame) -> DataFrame:
    """``parts`` with the arrays of each class added up to ``GRADIENT_PARTS`` arrays."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for g in batch.column("g"):
                values = g.values.to_numpy()
                total = values.copy() if total is None else total + values
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), list_column(total[None, :])], names=["class", "g"])

    dealt = parts.withColumn("part", F.spark_partition_id() % GRADIENT_PARTS)
    return dealt.groupBy("class", "part").applyInArrow(add, "class int, g array<double>")


def _gradient_matrix(rows: DataFrame, model: LinearModel, tasks: int, buffered: bool = False) -> np.ndarray:
    """The summed gradient, model sized; the last column is the bias.

    Spark adds the arrays of the tasks, so that at most ``GRADIENT_PARTS`` per class reach the driver, unless all have at most
    ``GRADIENT_CELLS`` numbers.
    """
    out = np.zeros((len(model.classes), model.n_features + 1))
    at = {c: i for i, c in enumerate(model.classes)}
    parts = gradient_parts(rows, model, buffered)
    for r in (parts if tasks * out.size <= GRADIENT_CELLS else _added(parts)).collect():
        out[at[r["class"]]] += r["g"]
    return out


@dataclass
class _Progress:
    """Weights of all classes, who still trains, and what the curve has recorded."""

    classes: np.ndarray
    w: np.ndarray
    b: np.ndarray
    active: np.ndarray
    snapshots: list[Snapshot] = field(default_factory=list)
    iterations: dict[int, int] = field(default_factory=dict)

    def step(self, dw: np.ndarray, db: np.ndarray, lr: float) -> None:
        """Move the classes that still train; a stopped class keeps its weights."""
        self.w[self.active] -= lr * dw[self.active]
        self.b[self.active] -= lr * db[self.active]

    def close_iteration(self, iteration: int, dw_sum: np.ndarray, db_sum: np.ndarray, tolerance: float) -> None:
        stop = self.active & (dw_sum < tolerance) & (db_sum < tolerance)
        for i in np.flatnonzero(self.active):
            self.iterations[int(self.classes[i])] = iteration
            if iteration % CURVE_EVERY == 0 or stop[i]:
                self.snapshots.append(Snapshot(int(self.classes[i]), iteration, self.w[i].copy(), float(self.b[i])))
        self.active = self.active & ~stop

    def result(self) -> LogRegFit:
        model = LinearModel(tuple(int(c) for c in self.classes), self.w, self.b)
        return LogRegFit(model, self.snapshots, self.iterations)


def _start(classes: tuple[int, ...], n_features: int) -> _Progress:
    k = len(classes)
    return _Progress(np.array(classes), np.zeros((k, n_features)), np.zeros(k), np.ones(k, bool))


def lr_fit_batch(rows: DataFrame, n_rows: int, n_features: int, classes: tuple[int, ...], params: LogRegParams) -> LogRegFit:
    """Mini-batches in row order from rows ``(pos, y, ids, vals)``."""
    size = min(params.batch_size or n_rows, max(1, n_rows))
    block = BLOCK_CELLS // max(1, min(n_features, DENSE_WIDTH)) // size * size
    if block < size or size == n_rows:
        return _fit_large_batches(rows, n_rows, n_features, classes, params, size)
    return _fit_blocks(rows, n_rows, n_features, classes, params, size, block)


def _fit_large_batches(rows: DataFrame, n_rows: int, n_features: int, classes: tuple[int, ...], params: LogRegParams, size: int) -> LogRegFit:
    """The gradient of each batch is one job over all its rows."""
    run, whole = _start(classes, n_features), size >= n_rows
    rows = (_buffered(rows, n_features) if whole else rows.select("pos", "y", "ids", "vals")).persist()
    try:
        tasks = rows.rdd.getNumPartitions()
        for iteration in range(1, params.n_iter + 1):
            if not run.active.any():
                break
            dw_sum, db_sum = np.zeros(len(classes)), np.zeros(len(classes))
            for start in range(0, n_rows, size):
                end = min(start + size, n_rows)
                batch = rows if whole else rows.where(F.col("pos").between(start, end - 1))
                g = _gradient_matrix(batch, LinearModel(classes, run.w, run.b), tasks, whole) / (end - start)
                dw, db = g[:, :-1] + params.alpha / n_rows * np.sign(run.w), g[:, -1]
                run.step(dw, db, params.lr)
                dw_sum += np.linalg.norm(dw, axis=1)
                db_sum += np.abs(db)
            run.close_iteration(iteration, dw_sum, db_sum, params.tolerance)
    finally:
        rows.unpersist()
    return run.result()


def block_of(rows: DataFrame, start: int, end: int) -> DataFrame:
    """Rows of some positions. Stored rows lie in runs of positions, so the filter leaves out the files of other blocks."""
    return rows.select("pos", "y", "ids", "vals").where(F.col("pos").between(start, end - 1))


_BLOCK_SCHEMA = "class int, iteration int, last boolean, w array<double>, b double, dw double, db double, active boolean"


def _fit_blocks(
    rows: DataFrame, n_rows: int, n_features: int, classes: tuple[int, ...], params: LogRegParams, size: int, block: int
) -> LogRegFit:
    """A chain of bounded blocks of whole batches; the weights, and what the iteration has added up so far, go from block to block."""
    run, listed, whole = _start(classes, n_features), np.array(classes), n_rows <= block
    dw_sum, db_sum = np.zeros(len(classes)), np.zeros(len(classes))

    def replay_from(state: _Progress, dw_sum: np.ndarray, db_sum: np.ndarray, iterations: range) -> Callable[[pa.Table], pa.Table]:
        return lambda table: replay(table, state, dw_sum, db_sum, iterations)

    def replay(table: pa.Table, state: _Progress, dw_sum: np.ndarray, db_sum: np.ndarray, iterations: range) -> pa.Table:
        part = table.combine_chunks().sort_by("pos").to_batches()[0]
        batches = [PackedRows(part.slice(i, size), n_features) for i in range(0, part.num_rows, size)]
        targets = [_targets(b.part.column("y").to_numpy(), listed) for b in batches]
        for iteration in iterations:
            for batch, target in zip(batches, targets):
                error = _logistic(batch.dot(np.ascontiguousarray(state.w.T)) + state.b) - target
                dw = batch.weighted_sums(error) / batch.n + params.alpha / n_rows * np.sign(state.w)
                db = error.sum(axis=0) / batch.n
                state.step(dw, db, params.lr)
                dw_sum, db_sum = dw_sum + np.linalg.norm(dw, axis=1), db_sum + np.abs(db)
            if whole:
                state.close_iteration(iteration, dw_sum, db_sum, params.tolerance)
                dw_sum, db_sum = np.zeros(len(listed)), np.zeros(len(listed))
                if not state.active.any():
                    break
        points = [(s.target, s.iteration, False, s.w, s.b, 0.0, 0.0, False) for s in state.snapshots]
        points += [(int(c), state.iterations.get(int(c), 0), True, state.w[i], float(state.b[i]), float(dw_sum[i]), float(db_sum[i]), bool(state.active[i])) for i, c in enumerate(listed)]
        target, iteration, last, w, b, dws, dbs, active = zip(*points)
        out = _points(list(target), list(iteration), list(last), np.vstack(w), list(b))
        return out.append_column("dw", pa.array(dws)).append_column("db", pa.array(dbs)).append_column("active", pa.array(active))

    for iteration in range(1, params.n_iter + 1):
        if not run.active.any():
            break
        for start in range(0, n_rows, block):
            span = range(1, params.n_iter + 1) if whole else range(iteration, iteration + 1)
            taken = block_of(rows, start, min(start + block, n_rows)).withColumn("block", F.lit(start)).groupBy("block")
            found = taken.applyInArrow(replay_from(run, dw_sum, db_sum, span), _BLOCK_SCHEMA).collect()
            ended = {r["class"]: r for r in found if r["last"]}
            run.w = np.array([ended[c]["w"] for c in classes]).reshape(len(classes), n_features)
            run.b = np.array([ended[c]["b"] for c in classes])
            dw_sum, db_sum = (np.array([ended[c][name] for c in classes]) for name in ("dw", "db"))
            if whole:
                run.snapshots = [Snapshot(r["class"], r["iteration"], np.array(r["w"]), r["b"]) for r in found if not r["last"]]
                run.iterations = {c: r["iteration"] for c, r in ended.items() if r["iteration"]}
                return run.result()
        run.close_iteration(iteration, dw_sum, db_sum, params.tolerance)
        dw_sum, db_sum = np.zeros(len(classes)), np.zeros(len(classes))
    return run.result()


_CLASS_SCHEMA = "class int, iteration int, last boolean, w array<double>, b double"


def _points(target: list[int], iteration: list[int], last: list[bool], w: np.ndarray, b: list[float]) -> pa.Table:
    """Weights along a training as rows of ``_CLASS_SCHEMA``."""
    kinds = {"class": pa.array(target, pa.int32()), "iteration": pa.array(iteration, pa.int32()), "last": pa.array(last, pa.bool_())}
    return pa.table({**kinds, "w": list_column(w), "b": pa.array(b, pa.float64())})


def _trained(points: DataFrame, n_features: int, classes: tuple[int, ...]) -> LogRegFit:
    """Collect the final weights, the curve points and the iteration counts: classes x features each."""
    out = points.collect()
    final = {r["class"]: r for r in out if r["last"]}
    zero = np.zeros(n_features)
    weights = np.vstack([np.array(final[c]["w"]) if c in final else zero for c in classes])
    bias = np.array([final[c]["b"] if c in final else 0.0 for c in classes])
    snapshots = [Snapshot(r["class"], r["iteration"], np.array(r["w"]), r["b"]) for r in out if not r["last"]]
    return LogRegFit(LinearModel(tuple(classes), weights, bias), snapshots, {c: r["iteration"] for c, r in final.items()})


def draw_rows(rows: DataFrame, n_rows: int, classes: tuple[int, ...], params: LogRegParams) -> DataFrame:
    """``(class, step, pos)``: one uniformly drawn row position per class and step, reproducible from the seed."""
    spark = rows.sparkSession
    k = len(classes)
    listed = F.array(*[F.lit(c) for c in classes])
    steps = spark.range(params.n_iter * k).select(
        F.get(listed, (F.col("id") % k).cast("int")).cast("int").alias("class"),
        F.floor(F.col("id") / k).cast("int").alias("step"),
    )
    return steps.withColumn("pos", counter_draw(n_rows, F.lit(params.seed), F.col("class"), F.col("step")))


class RunningMean:
    """Mean of the last ``STOP_WINDOW`` numbers, from their running sum."""

    def __init__(self) -> None:
        self.ring, self.seen, self.total = np.zeros(STOP_WINDOW), 0, 0.0

    def add(self, x: float) -> None:
        at = self.seen % STOP_WINDOW
        self.total += x - self.ring[at]
        self.ring[at] = x
        self.seen += 1
        if at == STOP_WINDOW - 1:
            # Once around: what rounding left in the sum goes.
            self.total = float(self.ring.sum())

    def below(self, tolerance: float) -> bool:
        return self.seen >= STOP_WINDOW and self.total / STOP_WINDOW < tolerance


def lr_fit_stochastic(
    rows: DataFrame,
    n_rows: int,
    n_features: int,
    classes: tuple[int, ...],
    params: LogRegParams,
    draws: DataFrame | None = None,
) -> LogRegFit:
    """Single-row steps; ``draws`` replaces the seeded ``(class, step, pos)`` table."""
    draws = draw_rows(rows, n_rows, classes, params) if draws is None else draws
    bound = params.n_iter * len(classes)
    drawn = rows.select("pos", "y", "ids", "vals").join(lookup_side(draws, bound), "pos")

    def replay(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("step")
        target = table.column("class")[0].as_py()
        y = (table.column("y").to_numpy() == target).astype(float)
        lengths, ids = list_parts(table.column("ids").combine_chunks())
        _, vals = list_parts(table.column("vals").combine_chunks())
        ends = np.cumsum(lengths)
        w, b, norms, points = np.zeros(n_features), 0.0, RunningMean(), []
        for i in range(len(y)):
            at, x = ids[ends[i] - lengths[i] : ends[i]], vals[ends[i] - lengths[i] : ends[i]]
            error = float(_logistic(np.array(x @ w[at] + b)) - y[i])
            dw = params.alpha * np.sign(w)
            dw[at] += error * x
            w -= params.lr * dw
            b -= params.lr * error
            norms.add(float(np.linalg.norm(dw)) + abs(error))
            if (i + 1) % CURVE_EVERY == 0:
                points.append((i + 1, False, w.copy(), b))
            if norms.below(params.tolerance):
                points.append((i + 1, False, w.copy(), b))
                break
        points.append((norms.seen, True, w, b))
        steps, last, weights, biases = zip(*points)
        return _points([target] * len(points), list(steps), list(last), np.vstack(weights), list(biases))

    return _trained(drawn.groupBy("class").applyInArrow(replay, _CLASS_SCHEMA), n_features, classes)


def lr_ovr_fit(rows: DataFrame, n_rows: int, n_features: int, classes: tuple[int, ...], params: LogRegParams = LogRegParams()) -> LogRegFit:
    """One model per class; the way of stepping follows ``params.mode``."""
    if params.mode not in ("auto", "batch", "stochastic"):
        raise ValueError("mode must be 'auto', 'batch' or 'stochastic'")
    stochastic = params.mode == "stochastic" or (params.mode == "auto" and len(classes) > 2)
    fit = lr_fit_stochastic if stochastic else lr_fit_batch
    return fit(rows, n_rows, n_features, tuple(classes), params)


def lr_curve(vectors: DataFrame, snapshots: list[Snapshot], n_features: int) -> DataFrame:
    """``(class, iteration, split, n, accuracy, precision/recall/f1 ...)`` of every snapshot, in one pass.

    ``vectors`` holds ``(split, y, ids, vals)``. Each task counts its own confusion cells, so rows are never
    multiplied by the snapshots.
    """
    spark = vectors.sparkSession
    points = sorted({(s.target, s.iteration): s for s in snapshots}.values(), key=lambda s: (s.target, s.iteration))
    targets = np.array([s.target for s in points], dtype=np.int32)
    weights = np.array([s.w for s in points]).reshape(len(points), n_features).T
    bias = np.array([s.b for s in points])
    schema = "split string, point int, tp long, fp long, fn long, tn long"
    if not points:
        counts = spark.createDataFrame([], schema)
    else:

        def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[str, np.ndarray] = {}
            for block in row_blocks(batches, n_features):
                predicted = _logistic(block.dot(weights) + bias) > 0.5
                true = _targets(block.part.column("y").to_numpy(), targets).astype(bool)
                splits = np.array(block.part.column("split").to_pylist(), dtype=object)
                for split in set(splits):
                    p, t = predicted[splits == split], true[splits == split]
                    cells = np.stack([(p & t).sum(0), (p & ~t).sum(0), (~p & t).sum(0), (~p & ~t).sum(0)])
                    totals[split] = totals.get(split, 0) + cells
            for split, cells in totals.items():
                columns = [pa.array([split] * len(points)), pa.array(range(len(points)), pa.int32())]
                columns += [pa.array(row.astype(np.int64)) for row in cells]
                yield pa.RecordBatch.from_arrays(columns, names=["split", "point", *CELLS])

        counts = vectors.select("split", "y", "ids", "vals").mapInArrow(count, schema)
    sums = counts.groupBy("split", "point").agg(*[F.sum(c).alias(c) for c in CELLS])
    names = F.array(*[F.struct(F.lit(s.target).alias("class"), F.lit(s.iteration).alias("iteration")) for s in points])
    keyed = sums.withColumn("key", F.get(names, F.col("point"))) if points else sums.withColumn(
        "key", F.lit(None).cast("struct<class:int,iteration:int>")
    )
    return keyed.select("key.class", "key.iteration", "split", *binary_scores())


def lr_predict(p: Column) -> Column:
    """0 up to and including one half."""
    return F.when(p <= 0.5, 0).otherwise(1)


def lr_ovr_scores(vectors: DataFrame, model: LinearModel, keep: tuple[str, ...]) -> DataFrame:
    """``(keep..., scores)`` with the probability of every class against the rest."""
    return linear_scores(vectors, model, 1, keep).withColumn("scores", probabilities(F.col("scores")))


def lr_ovr_predict(vectors: DataFrame, model: LinearModel, keep: tuple[str, ...]) -> DataFrame:
    scored = lr_ovr_scores(vectors, model, keep)
    return scored.select(*keep, argmax_class(F.col("scores"), model.classes).alias("prediction"))


def lr_ovr_proba(vectors: DataFrame, model: LinearModel, keep: tuple[str, ...]) -> DataFrame:
    return lr_ovr_scores(vectors, model, keep).withColumn("scores", row_normalised(F.col("scores")))
