"""Bulk-synchronous best-fit packing of token sequences.

Tokenising tasks write one row per piece, with the piece's rank among the pieces of its length in that task. Ranks
over all tasks follow from the counts per (task, length): a distributed counting sort of documents by length, in
which no group is gathered. Gaps are sorted the same way: sequences with equal free space are runs of consecutive
numbers. In each superstep the pieces of one length, longest first, meet the smallest gaps that hold them; the i-th
piece in rank order takes the i-th gap of the run, so no two pieces want the same place; gaps shrink, and the step
repeats for what is left. A sweep sees lengths and runs, of which there are at most as many as the capacity admits,
never documents; every document then finds its place from its own length and rank.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrade.session import write_stage

#: White space at which a text can't be cut into words of their own for the tokenizer.
UNEVEN = re.compile(r"\s | \s")
CACHE_WORDS = 600_000


class PackParams(NamedTuple):
    capacity: int = 1024
    end_id: int = 2
    vocabulary: str = "byte_bpe_50k"


class ByteBpe:
    """Ids of a byte-level BPE vocabulary, with a cache of words.

    A single space opens the pre-token of the word after it, so such words are encoded alone. Texts with other white
    space next to a space are encoded whole, and texts with a special token by ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.words: dict[str, bytes] = {}
        self.full = None

    def whole(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def special(self, text: str) -> bytes:
        if self.full is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(public_tokenizers.path(f"{self.vocabulary}.json"))
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if "<|endoftext|>" in text:
            return self.special(text)
        if UNEVEN.search(text):
            return self.whole(text)
        head, *rest = text.split(" ")
        words, out = self.words, [self.whole(head)]
        if len(words) > CACHE_WORDS:
            words.clear()
        for word in rest:
            ids = words.get(word)
            if ids is None:
                ids = words[word] = self.whole(" " + word)
            out.append(ids)
        return b"".join(out)


def pieces(docs: DataFrame, params: PackParams) -> DataFrame:
    """Pieces of every document: (doc_id, piece, start, length, ids_crc32, task, place).

    ``place`` is the rank among the pieces of this length in the task that wrote it.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, seen = ByteBpe(params.vocabulary), TaskContext.get().partitionId(), defaultdict(int)
        end, size = np.array([params.end_id], "<u4").tobytes(), params.capacity
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.ids(text.as_py() or "") + end
                count = len(ids) // 4
                start, length = 0, count % size or size
                for piece in range(-(-count // size)):
                    rows.append((doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
                    start, length = start + length, size
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


class Move(NamedTuple):
    """Pieces of ``length`` with ranks from ``rank`` on go into sequences from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def sweep(counts: dict[int, int], capacity: int) -> list[Move]:
    """Best fit, longest first, over counts per length and runs of sequences with equal gaps."""
    moves, runs, gaps, fresh = [], defaultdict(list), [], 0

    def add(gap: int, first: int, count: int) -> None:
        if gap and count:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # No gap holds this length: open what the rest needs.
                gap, first, count = capacity, fresh, -(-left // (capacity // length))
                fresh += count
            else:
                gap = gaps[at]
                first, count = runs[gap].pop()
                if not runs[gap]:
                    gaps.pop(at)
            taken = min(count, left)
            moves.append(Move(length, rank, taken, first, capacity - gap))
            add(gap - length, first, taken)
            add(gap, first + taken, count - taken)
            rank, left = rank + taken, left - taken
    return moves


def pack(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids followed by ``end_id``; a null or empty text is the end alone. Longer documents are cut into
    pieces of ``capacity`` ids, the first one shorter. Sequences have no gaps before or between their pieces. Repeated rows
    are packed each; an empty table gives no rows; other columns are ignored.
    """
    rows = write_stage(pieces(docs, params), "pack-pieces")
    held = rows.groupBy("task", "length").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = write_stage(held.select("task", "length", "held", F.coalesce(before, F.lit(0)).alias("before")), "pack-counts")
    counts = {r.length: r.n for r in starts.groupBy("length").agg(F.sum("held").alias("n")).collect()}  # at most `capacity` rows
    moves = sweep(counts, params.capacity)
    table = np.array(moves, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    top = int(table[:, 1].max(initial=0)) + int(table[:, 2].max(initial=0)) + 1
    # Length and rank as one ascending number; ranks stay far below 2**52.
    firsts = table[:, 0] * top + table[:, 1]

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = (x.to_numpy(zero_copy_only=False) for x in (lengths, ranks))
        at = np.searchsorted(firsts, length * top + rank, side="right") - 1
        fields = [table[at, 3] + rank - table[at, 1], table[at, 4]]
        return pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["sequence_id", "offset"])

    placed = rows.join(starts.select("task", "length", "before"), ["task", "length"])
    out = placed.withColumn("at", place("length", F.col("before") + F.col("place")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
