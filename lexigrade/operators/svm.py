"""Linear SVM by sequential hinge-loss steps, one class against the rest with 0/1 targets.

A row of another class never satisfies the margin test and its update is a plain decay, so a class meets
only its own rows; the rows in between count as decays. That sends every document to one class instead of
all of them. Every class is trained alike: one distributed pass finds its next margin miss (between misses the
weights only decay, so every row can tell when it would first miss), then a block of at most ``block_rows`` rows from
there is replayed, over the epochs to come if it holds the whole class. No class is gathered beyond that bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrade.functions.packed import list_column, list_parts
from lexigrade.operators.linear import LinearModel, argmax_class, linear_scores, signs
from lexigrade.session import lookup_side

# Scale of the weights below which they are written out, far from the smallest doubles.
SMALLEST_SCALE = 1e-100


@dataclass(frozen=True)
class SvmParams:
    learning_rate: float = 0.01
    lambda_param: float = 0.01
    n_iters: int = 1000
    # Rows of one class that one task may hold.
    block_rows: int = 50_000

    @property
    def decay(self) -> float:
        return 1.0 - 2.0 * self.learning_rate * self.lambda_param


@dataclass
class _State:
    """Weights and bias of a class before step ``step`` (a step is one row of one epoch)."""

    w: np.ndarray
    b: float
    step: int


_STATE_SCHEMA = "y int, w array<double>, b double, step long"


def _replay(state: _State, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: range, n_rows: int, params: SvmParams) -> _State:
    """Run the steps of one class's rows, given as ``(pos, ids, vals)`` in row order, from the state's step on.

    The weights are a sparse sum times one scale, so a decay costs one product and a miss only the row's own cells.
    """
    v, scale, b, step, decay, rate = state.w.copy(), 1.0, state.b, state.step, params.decay, params.learning_rate
    nonnegative = bool((v >= 0).all()) and all((vals >= 0).all() for _, _, vals in rows)
    for epoch in epochs:
        if nonnegative and b <= -1.0:
            break  # every margin stays at or above 1: only decays are left
        for pos, ids, vals in rows:
            at = epoch * n_rows + pos
            if at < step:
                continue
            scale *= decay ** (at - step)
            if scale < SMALLEST_SCALE:
                v, scale = v * scale, 1.0
            hit = scale * (vals @ v[ids]) - b >= 1.0
            scale *= decay
            if not hit:
                v[ids] += rate * vals / scale
                b -= rate
            step = at + 1
    return _State(v * scale, b, step)


def _replay_blocks(rows: DataFrame, states: dict[int, _State], epochs: dict[int, range], n_rows: int, params: SvmParams) -> dict[int, _State]:
    """One task per class over the given, bounded, rows."""

    def replay(table: pa.Table) -> pa.Table:
        y = table.column("y")[0].as_py()
        pos = table.column("pos").to_numpy()
        lengths, ids = list_parts(table.column("ids").combine_chunks())
        _, vals = list_parts(table.column("vals").combine_chunks())
        ends = np.cumsum(lengths)
        items = [(int(pos[i]), ids[ends[i] - lengths[i] : ends[i]], vals[ends[i] - lengths[i] : ends[i]]) for i in np.argsort(pos)]
        end = _replay(states[y], items, epochs[y], n_rows, params)
        return pa.table(
            {"y": pa.array([y], pa.int32()), "w": list_column(end.w[None, :]), "b": [float(end.b)], "step": pa.array([end.step], pa.int64())}
        )

    done = rows.select("y", "pos", "ids", "vals").groupBy("y").applyInArrow(replay, _STATE_SCHEMA).collect()
    return {r["y"]: _State(np.array(r["w"]), r["b"], r["step"]) for r in done}


def _first_miss(margin: np.ndarray, pos: np.ndarray, step: np.ndarray, b: np.ndarray, n_rows: int, last: int, decay: float) -> np.ndarray:
    """Step at which each row would first miss, if no other row does before; ``last`` where it never does.

    ``margin`` is ``x.w`` before step ``step`` of the row's class and ``b`` its bias.
    """
    first = pos + np.maximum(0, -((pos - step) // n_rows)) * n_rows
    wait = (first - step).astype(float)
    need = 1.0 + b
    now = decay**wait * margin < need
    found = np.where(now, first, last)
    later = ~now & (margin > 0) & (need > 0)
    if decay < 1.0 and later.any():
        rounds = np.ones(len(pos), dtype=np.int64)
        exact = (np.log(need[later] / margin[later]) / np.log(decay) - wait[later]) / n_rows
        rounds[later] = np.maximum(1, np.ceil(exact))
        # The logarithm may be off by one visit on either side.
        for shift in (-1, 0, 1):
            visit = np.maximum(1, rounds + shift)
            miss = later & (decay ** (wait + visit * n_rows) * margin < need)
            found = np.where(miss, np.minimum(found, first + visit * n_rows), found)
    return np.minimum(found, last)


def _next_misses(rows: DataFrame, states: dict[int, _State], n_rows: int, last: int, params: SvmParams) -> dict[int, int]:
    """First missing step of every class: a minimum per class and batch, then one aggregate."""
    decay, classes = params.decay, np.array(sorted(states))
    weights = np.vstack([states[c].w for c in classes])
    biases = np.array([states[c].b for c in classes])
    steps_done = np.array([states[c].step for c in classes])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.searchsorted(classes, batch.column("y").to_numpy())
            lengths, ids = list_parts(batch.column("ids"))
            _, vals = list_parts(batch.column("vals"))
            row = np.repeat(np.arange(len(of)), lengths)
            margin = np.bincount(row, vals * weights[of[row], ids], len(of))
            miss = _first_miss(margin, batch.column("pos").to_numpy(), steps_done[of], biases[of], n_rows, last, decay)
            lowest = np.full(len(classes), last)
            np.minimum.at(lowest, of, miss)
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int32()), pa.array(lowest, pa.int64())], names=["y", "step"])

    found = rows.select("y", "pos", "ids", "vals").mapInArrow(scan, "y int, step long")
    return {r["y"]: r["step"] for r in found.groupBy("y").agg(F.min("step").alias("step")).collect()}


def svm_ovr_fit(
    rows: DataFrame, n_rows: int, n_features: int, n_classes: int, params: SvmParams = SvmParams(), classes: Sequence[int] | None = None
) -> LinearModel:
    """One model per class from rows ``(pos, y, ids, vals)`` with positions ``0..n_rows-1``: all of ``0..n_classes-1``, or the given ones."""
    wanted = tuple(range(n_classes)) if classes is None else tuple(classes)
    last = n_rows * params.n_iters
    states = {c: _State(np.zeros(n_features), 0.0, 0) for c in wanted}
    own = rows if classes is None else rows.where(F.col("y").between(min(wanted), max(wanted)) & F.col("y").isin(list(wanted)))
    sizes = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    pending = {c for c in states if sizes.get(c, 0)}
    while pending:
        open_states = {c: states[c] for c in pending}
        misses = _next_misses(own.where(F.col("y").isin(list(pending))), open_states, n_rows, last, params)
        pending = {c for c in pending if misses[c] < last}
        windows, epochs, ahead = [], {}, {}
        for c in pending:
            at = misses[c]
            epoch, start = at // n_rows, at % n_rows
            ahead[c] = _State(states[c].w * params.decay ** (at - states[c].step), states[c].b, at)
            # A block that holds all rows of its class may go on through the epochs.
            whole = sizes[c] <= params.block_rows
            epochs[c] = range(epoch, params.n_iters if whole else epoch + 1)
            windows.append((c, 0, n_rows) if whole else (c, start, start + params.block_rows))
        if pending:
            # One row per class that still trains.
            side = lookup_side(rows.sparkSession.createDataFrame(windows, "y int, low long, high long"), len(windows))
            states |= _replay_blocks(own.join(side, "y").where("pos >= low AND pos < high"), ahead, epochs, n_rows, params)

    for state in states.values():
        state.w = state.w * params.decay ** (last - state.step)
    weights = np.vstack([states[c].w for c in wanted]) if wanted else np.zeros((0, n_features))
    return LinearModel(wanted, weights, np.array([states[c].b for c in wanted]))


def svm_fit(rows: DataFrame, n_rows: int, n_features: int, params: SvmParams = SvmParams()) -> LinearModel:
    """A single model for 0/1 targets ``y``."""
    return svm_ovr_fit(rows, n_rows, n_features, 2, params, (1,))


def svm_margins(vectors: DataFrame, model: LinearModel, keep: tuple[str, ...]) -> DataFrame:
    """``(keep..., scores)`` with ``x.w - b``."""
    return linear_scores(vectors, model, -1, keep)


def svm_sign(margin: Column) -> Column:
    return F.signum(margin)


def svm_ovr_predict(vectors: DataFrame, model: LinearModel, keep: tuple[str, ...], decision: str = "sign") -> DataFrame:
    """``(keep..., prediction)``: the first class with the largest sign; ``decision='margin'`` compares the margins."""
    if decision not in ("sign", "margin"):
        raise ValueError("decision must be 'sign' or 'margin'")
    scored = svm_margins(vectors, model, keep)
    scores = signs(F.col("scores")) if decision == "sign" else F.col("scores")
    return scored.select(*keep, argmax_class(scores, model.classes).alias("prediction"))
