"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import lexigrade  # noqa: E402
from lexigrade.llm import decontaminate, jaccard_join, line_runs, packing, toxicity  # noqa: E402
from lexigrade.session import write_stage  # noqa: E402

# Functions travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(lexigrade)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half; it learns from all labels but the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.drop_toxic(docs, toxicity.learnable(labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of larger id keeps; ``n_chars`` follows the text."""
    kept = line_runs.drop_common_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("__lines.text"))
    values = {"text": text, "n_chars": F.when(F.col("__lines.dropped") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return kept.select(*[values[c].alias(c) if c in values else c for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every class of near copies."""
    return jaccard_join.keep_one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Learning, similarity search and packing have no counterpart in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
