"""Numpy views of packed rows (``ids array<int>``, ``vals array<double>``) inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

# Cells of one dense block: bounds the memory of a task whatever the batch size and width are.
BLOCK_CELLS = 500_000
# Up to this width products run on dense blocks, beyond it on the stored cells.
DENSE_WIDTH = 20_000
# Partial sums that a task holds before it combines them.
HELD_ROWS = 2_000_000


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row lengths and flat values of a list column."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


class PackedRows:
    """Packed rows of a record batch as a matrix of ``width`` columns."""

    def __init__(self, part: pa.RecordBatch, width: int) -> None:
        self.part, self.width, self.n = part, width, part.num_rows
        lengths, self.ids = list_parts(part.column("ids"))
        _, self.vals = list_parts(part.column("vals"))
        self.row = np.repeat(np.arange(self.n), lengths)
        self._dense: np.ndarray | None = None

    def dense(self) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros((self.n, self.width))
            self._dense[self.row, self.ids] = self.vals
        return self._dense

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Rows times a ``width x k`` matrix."""
        if self.width <= DENSE_WIDTH:
            return self.dense() @ weights
        columns = [np.bincount(self.row, self.vals * weights[self.ids, k], self.n) for k in range(weights.shape[1])]
        return np.stack(columns, axis=1)

    def weighted_sums(self, factors: np.ndarray) -> np.ndarray:
        """Transposed ``rows x k`` factors times the rows: ``k x width``."""
        if self.width <= DENSE_WIDTH:
            return factors.T @ self.dense()
        return np.stack([np.bincount(self.ids, self.vals * factors[self.row, k], self.width) for k in range(factors.shape[1])])


def row_blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[PackedRows]:
    """The batches as blocks of rows of bounded size."""
    step = max(1, BLOCK_CELLS // max(1, min(width, DENSE_WIDTH)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield PackedRows(batch.slice(start, step), width)


# Labels, row lengths, ids and values of a block of rows, each as one buffer.
BUFFERS = {"y": np.int64, "lengths": np.int32, "ids": np.int32, "vals": np.float64}
BUFFERS_SCHEMA = ", ".join(f"{name} binary" for name in BUFFERS)


def to_buffers(block: PackedRows) -> pa.RecordBatch:
    """A block of rows ``(y, ids, vals)`` as one row of buffers."""
    parts = block.part.column("y").to_numpy(), np.bincount(block.row, minlength=block.n), block.ids, block.vals
    columns = [pa.array([np.ascontiguousarray(part, kind).tobytes()], pa.binary()) for part, kind in zip(parts, BUFFERS.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(BUFFERS))


def buffer_blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[PackedRows]:
    """The blocks of rows that ``to_buffers`` has made."""
    for batch in batches:
        for i in range(batch.num_rows):
            y, lengths, ids, vals = (np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in BUFFERS.items())
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(flat)) for flat in (ids, vals)]
            yield PackedRows(pa.RecordBatch.from_arrays([pa.array(y), *lists], names=["y", "ids", "vals"]), width)


def list_column(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column of doubles."""
    n, width = rows.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel(), pa.float64()))


def combine_sums(batches: Iterable[pa.RecordBatch], keys: Sequence[str], sums: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Add up the partial sums of a whole task by key, so that it emits each key once.

    What does not shrink is passed on: the memory stays bounded however many keys there are.
    """

    def merged(held: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(held)
        total = table.group_by(list(keys), use_threads=False).aggregate([(name, "sum") for name in sums])
        return total.select([*keys, *[f"{name}_sum" for name in sums]]).rename_columns([*keys, *sums])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) > HELD_ROWS:
            total = merged(held)
            held = total.combine_chunks().to_batches()
            if total.num_rows > HELD_ROWS // 2:
                yield from held
                held = []
    if held:
        yield from merged(held).combine_chunks().to_batches()
