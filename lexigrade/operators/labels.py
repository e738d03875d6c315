"""Label codes and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrade.session import lookup_side
from lexigrade.sources.corpus import ranked

UNSEEN = -1


def label_index(train: DataFrame) -> DataFrame:
    """``(label, y, n_class)``: codes in order of first appearance, and the rows of each.

    Labels are combined before the shuffle and ranked in ranges of their first documents, so any number of them has a code.
    """
    firsts = train.groupBy("label").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_class"))
    return ranked(firsts, ["first_doc", "label"], "y").select("label", F.col("y").cast("int").alias("y"), "n_class")


def encode_train(train: DataFrame, index: DataFrame, index_rows: int) -> DataFrame:
    return train.join(lookup_side(index.select("label", "y"), index_rows), "label")


def encode_heldout(docs: DataFrame, index: DataFrame, index_rows: int) -> DataFrame:
    """Codes for any split; a label that train does not have becomes -1."""
    coded = docs.join(lookup_side(index.select("label", "y"), index_rows), "label", "left")
    return coded.withColumn("y", F.coalesce("y", F.lit(UNSEEN)))


def drop_unseen(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("y") != UNSEEN)


def distinct_classes(labels: DataFrame) -> DataFrame:
    return labels.select("y").distinct().orderBy("y")


def one_vs_rest(labels: DataFrame, classes: list[int]) -> DataFrame:
    """``(doc_id, class, target)``: the 0/1 target of every class, without a join.

    For inspection; the trainers keep these targets implicit.
    """
    listed = F.array(*[F.lit(c).cast("int") for c in classes])
    return labels.select("doc_id", "y", F.explode(listed).alias("class")).select(
        "doc_id", "class", (F.col("y") == F.col("class")).cast("int").alias("target")
    )


def decode_signed(prediction: Column) -> Column:
    return F.when(prediction == -1, 0).otherwise(1)
