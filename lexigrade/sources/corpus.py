"""Corpus sources and the report sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrade.functions.lookup import constant_array
from lexigrade.session import BROADCAST_ROWS, count_up_to, lookup_side, write_stage

# The three splits of a level, in the order in which they are reported.
SPLITS = ("train", "validation", "test")

# Rows of one position bucket, at most and, unless cores would idle, at least.
POSITION_BUCKET_ROWS = 1_000_000
POSITION_BUCKET_MIN = 500


def level_files(base: str, level: str) -> dict[str, str]:
    """The files of one level as corpora are published: ``base/level/<split>-*.parquet``."""
    return {split: f"{base}/{level}/{split}-*.parquet" for split in SPLITS}


def read_corpus(spark: SparkSession, paths: Mapping[str, str], id_column: str | None = None) -> DataFrame:
    """``(doc_id, text, label, split)`` from one parquet path per split; a path may hold any number of files.

    The files need no id: a document's id is the position of its row over all files, in the order of the splits, then of the file names,
    then of the rows. It follows from Spark's file metadata, so it is the same however the files are cut into tasks, and no row moves.
    ``id_column`` takes ids from the files instead; they must differ between the splits.
    """
    unknown = set(paths) - set(SPLITS)
    if unknown:
        raise ValueError(f"unknown splits: {sorted(unknown)}")
    columns = ["text", "label"] if id_column is None else [F.col(id_column).alias("doc_id"), "text", "label"]
    if id_column is None:
        columns += [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    parts = [spark.read.parquet(paths[split]).select(*columns, F.lit(split).alias("split")) for split in SPLITS if split in paths]
    corpus = reduce(DataFrame.unionByName, parts)
    return corpus if id_column is not None else _with_file_ids(corpus)


def _with_file_ids(rows: DataFrame) -> DataFrame:
    """Replace file and row number by a dense id. Only one number per file is counted, and stored for the readers to come."""
    order = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split"))
    before = Window.orderBy(order, "_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("split", "_file").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select(F.col("split").alias("_of"), F.col("_file").alias("_name"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    firsts = write_stage(firsts, "files")
    # One file may serve two splits: both parts of the key count.
    same = (F.col("_file") == F.col("_name")) & (F.col("split") == F.col("_of"))
    joined = rows.join(lookup_side(firsts, count_up_to(firsts, BROADCAST_ROWS)), same)
    return joined.select((F.col("_first") + F.col("_row")).cast("long").alias("doc_id"), "text", "label", "split")


def read_level(spark: SparkSession, base: str, level: str) -> DataFrame:
    """A label level stored by ``write_level``; a filter on ``split`` reads only that folder."""
    return spark.read.parquet(f"{base}/{level}").select("doc_id", "text", "label", "split")


def select_level(docs: DataFrame, level: str) -> DataFrame:
    """The documents of one label level held as a column; rows without a label are not part of the level."""
    return docs.where(F.col(level).isNotNull()).withColumn("label", F.col(level))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Keep the first document of every text. Optional: copies are kept by default."""
    # The digest keeps the shuffled key small; min combines before the shuffle, so copies do not skew it.
    firsts = docs.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return docs.join(firsts, "doc_id", "left_semi")


def write_level(docs: DataFrame, base: str, level: str) -> None:
    """Store ``(doc_id, text, label)`` of one level as ``base/level/split=...``."""
    docs.select("doc_id", "text", "label", "split").write.mode("overwrite").partitionBy("split").parquet(f"{base}/{level}")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a metrics table."""
    report.write.mode(mode).parquet(path)


def ranked(rows: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Stored ``rows`` with their dense 0-based rank in ``order``, which should tell all rows apart.

    The rows are range-sorted, each task numbers its run, and only the number of rows of each run is added up: no task and no window
    sees all rows.
    """
    run = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = write_stage(run, "ranked")
    # The task stands in the upper bits, the row in the lower 33.
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the sort.
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    placed = stored.join(F.broadcast(before), part == F.col("_part"))
    return placed.withColumn(name, F.col("_before") + at).drop("_at", "_part", "_before")


def with_positions(rows: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """Add the dense 0-based position ``pos`` of each of the ``n`` rows in ``key`` order.

    Rows are ranked inside range buckets and shifted by the sizes of the buckets before, so no task sees all
    rows. The keys are unique and the bucket bounds are their quantiles, so the buckets are even. The result is
    partitioned by bucket: stored, its files hold runs of positions.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    buckets = max(2, -(-n // POSITION_BUCKET_ROWS), min(4 * cores, -(-n // POSITION_BUCKET_MIN)))
    probabilities = [i / buckets for i in range(1, buckets)]
    bounds = rows.agg(F.percentile_approx(key, probabilities, 10_000)).first()[0] or [0]
    edges = [float("-inf"), *sorted({float(b) for b in bounds}), float("inf")]
    bucketed = Bucketizer(splits=edges, inputCol=key, outputCol="_bucket").transform(rows)
    bucketed = bucketed.withColumn("_bucket", F.col("_bucket").cast("int"))
    sizes = dict(bucketed.groupBy("_bucket").count().collect())
    offsets, total = [], 0
    for bucket in range(len(edges) - 1):
        offsets.append(total)
        total += sizes.get(bucket, 0)
    bucketed = bucketed.repartition(buckets, "_bucket")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    pos = F.get(constant_array(offsets, "bigint"), F.col("_bucket")) + rank
    return bucketed.withColumn("pos", pos.cast("long")).drop("_bucket")
