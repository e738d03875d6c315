"""Line deduplication against levelled sorted runs of line hashes.

A run is a table of line keys, range-sorted, with the number of documents that hold the line and the largest of
their ids. A new batch of documents is merge-joined with the runs: keys that no run holds (the anti-join) start an
entry, known keys add what the batch changes, and both form a new run of level 0. When a level has ``fanout`` runs
they are merged into one run of the next level, so n batches leave about ``fanout * log(n)`` runs and every key is
rewritten about ``log(n)`` times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrade.session import write_stage

WHITE = b" \t\n\x0b\x0c\r"


class LineParams(NamedTuple):
    min_chars: int = 20
    min_docs: int = 3
    batches: int = 4
    fanout: int = 2


def line_key(line: str, min_chars: int) -> bytes | None:
    """Hash of the stripped line with A-Z lower-cased; None for shorter lines."""
    norm = line.encode("utf-8").strip(WHITE).lower()
    if len(norm) < min_chars or len(norm.decode("utf-8")) < min_chars:
        return None
    return hashlib.md5(norm).digest()


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Distinct line keys of every document row: (doc_id, key)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                {k for line in (text or "").split("\n") if len(line) >= min_chars and (k := line_key(line, min_chars))}
                for text in batch.column(1).to_pylist()
            ]
            at = pa.array([i for i, ks in enumerate(found) for _ in ks], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([k for ks in found for k in ks], pa.binary())], ["doc_id", "key"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(keys, "doc_id long, key binary")


class LineRuns:
    """The runs of one corpus, by level. A document must be handed in once, its rows in one batch."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, entries: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels[level].append(write_stage(entries.repartitionByRange(parts, "key").sortWithinPartitions("key"), f"lines-run-{level}"))

    def entries(self) -> DataFrame:
        """All keys with their totals over the runs: (key, docs, last_id)."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], "key binary, docs long, last_id long")
        return merged(reduce(DataFrame.unionByName, runs))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, key) rows, each key once per document at most."""
        fresh = lines.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last_id"))
        if self._runs():
            fresh = write_stage(fresh, "lines-batch")
            held = self.entries()
            new = fresh.join(held, "key", "left_anti")
            known = fresh.join(held.select("key", F.col("last_id").alias("was")), "key").select(
                "key", "docs", F.greatest("last_id", "was").alias("last_id")
            )
            fresh = new.unionByName(known)
        self._write(fresh, 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                full, self.levels[level] = self.levels[level], []
                self._write(merged(reduce(DataFrame.unionByName, full)), level + 1)


def merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last_id").alias("last_id"))


def dropped_keys(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """Keys that each document loses: (doc_id, keys). Null ids count as one document, smaller than all others."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(params.batches)).alias("batch")
    lines = write_stage(line_keys(docs, params.min_chars).groupBy("doc_id", "key").count().select("doc_id", "key", batch), "lines-keys")
    runs = LineRuns(spark, params.fanout)
    for i in range(params.batches):
        runs.add(lines.filter(F.col("batch") == i).select("doc_id", "key"))
    common = write_stage(runs.entries().filter(F.col("docs") >= params.min_docs).select("key", "last_id"), "lines-common")
    lost = lines.join(common, "key").filter(~F.col("doc_id").eqNullSafe(F.col("last_id"))).select("doc_id", "key")
    return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def line_filter(min_chars: int):
    """Column function: (text, lost keys) -> (lines before, lines dropped, text of the other lines)."""

    @F.arrow_udf("struct<lines:bigint,dropped:bigint,text:string>")
    def keep(texts: pa.Array, lost: pa.Array) -> pa.Array:
        out = []
        for text, keys in zip(texts.to_pylist(), lost.to_pylist()):
            lines = (text or "").split("\n")
            gone = set(keys or ())
            kept = [x for x in lines if len(x) < min_chars or line_key(x, min_chars) not in gone] if gone else lines
            out.append((len(lines), len(lines) - len(kept), (text or "") if len(kept) == len(lines) else "\n".join(kept)))
        fields = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(f, t) for f, t in zip(fields, (pa.int64(), pa.int64(), pa.string()))], ["lines", "dropped", "text"])

    return keep


def drop_common_lines(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """``docs`` with a column ``__lines``: (lines, dropped, text), the text without the lines that others keep.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. Keys of at least ``min_chars`` code
    points in at least ``min_docs`` documents stay only in the document of largest id, in all its rows. A null or
    empty text is one empty line (the new text is empty). A column of that name is replaced. Repeated rows of an id are one document; an empty table stays
    empty; other columns pass through.
    """
    lost = dropped_keys(docs, params).select(F.col("doc_id").alias("__lines_id"), F.col("keys").alias("__lines_lost"))
    joined = docs.join(lost, docs["doc_id"].cast("long").eqNullSafe(F.col("__lines_id")), "left")
    return joined.withColumn("__lines", line_filter(params.min_chars)("text", "__lines_lost")).drop("__lines_id", "__lines_lost")
