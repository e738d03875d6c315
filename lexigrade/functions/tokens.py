"""Counting and looking up tokens inside Arrow tasks: a document is one row, so neither needs an exchange."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Tokens of one block: bounds what counting and looking up hold beside the batch, however many rows it has.
BLOCK_CELLS = 100_000


def token_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], np.ndarray, pa.Array]]:
    """Other columns, the row of every token and the tokens; the last column holds the token lists.

    A block has at most ``BLOCK_CELLS`` tokens or one row."""
    for batch in batches:
        ends = np.cumsum(batch.column(batch.num_columns - 1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        low, before = 0, 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, before + BLOCK_CELLS, side="right")))
            part = batch.slice(low, high - low)
            lists = part.column(part.num_columns - 1)
            rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            yield part.columns[:-1], rows, lists.flatten()
            low, before = high, int(ends[high - 1])


def lists_of(rows: np.ndarray, n_rows: int, values: pa.Array) -> pa.Array:
    """List column of ``values``, which lie in the order of their rows."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def count_pairs(rows: np.ndarray, keys: np.ndarray, n_keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs in ascending order and how often each occurs."""
    pairs, counts = np.unique(rows * max(1, n_keys) + keys, return_counts=True)
    return pairs // max(1, n_keys), pairs % max(1, n_keys), counts


def count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns with ``term`` (ascending) and ``tf`` lists in place of the token lists."""
    for batch in batches:
        yield from _counted(batch)


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    names = [*batch.schema.names[:-1], "term", "tf"]
    for others, rows, tokens in token_blocks([batch]):
        coded = tokens.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        rank = np.argsort(order.to_numpy())
        n_rows = len(others[0])
        rows, keys, counts = count_pairs(rows, rank[coded.indices.to_numpy()], len(rank))
        lists = lists_of(rows, n_rows, coded.dictionary.take(order).take(pa.array(keys))), lists_of(rows, n_rows, pa.array(counts))
        yield pa.RecordBatch.from_arrays([*others, *lists], names)


def find_terms(tokens: pa.Array, terms: pa.Array) -> np.ndarray:
    """Position of every token in ``terms``, -1 where there is none; every distinct token is looked up once."""
    coded = tokens.dictionary_encode()
    at = pc.index_in(coded.dictionary, value_set=terms).fill_null(-1).to_numpy()
    return at[coded.indices.to_numpy()].astype(np.int64) if len(at) else np.empty(0, np.int64)
