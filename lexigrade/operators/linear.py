"""Linear models as small tables, and their scores over packed or long vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrade.functions.numeric import sigmoid_clipped
from lexigrade.functions.packed import list_column, row_blocks
from lexigrade.operators.vectorize import unpack
from lexigrade.session import lookup_side


@dataclass(frozen=True)
class LinearModel:
    """One weight row and one bias per class; the size is classes x features, never documents."""

    classes: tuple[int, ...]
    weights: np.ndarray
    bias: np.ndarray

    @property
    def n_features(self) -> int:
        return self.weights.shape[1]

    def weight_table(self, spark: SparkSession) -> DataFrame:
        """``(class, feature_id, w)`` without the zero weights."""
        rows = [(int(c), int(f), float(self.weights[i, f])) for i, c in enumerate(self.classes) for f in np.flatnonzero(self.weights[i])]
        return spark.createDataFrame(rows, "class int, feature_id int, w double")

    def bias_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(int(c), float(b)) for c, b in zip(self.classes, self.bias)], "class int, b double")

    @classmethod
    def from_tables(cls, weights: DataFrame, bias: DataFrame, n_features: int) -> LinearModel:
        biases = {r["class"]: r["b"] for r in bias.collect()}
        classes = tuple(sorted(biases))
        at = {c: i for i, c in enumerate(classes)}
        matrix = np.zeros((len(classes), n_features))
        for r in weights.collect():
            matrix[at[r["class"]], r["feature_id"]] = r["w"]
        return cls(classes, matrix, np.array([biases[c] for c in classes]))


def linear_scores(vectors: DataFrame, model: LinearModel, bias_sign: int, keep: tuple[str, ...]) -> DataFrame:
    """``(keep..., scores)`` with ``x.w + bias_sign * b`` per class, in class order.

    Map-only: each Arrow batch is one matrix product, so no non-zero is multiplied by the classes in a
    shuffle, and the same call works on a stream.
    """
    weights, shift = np.ascontiguousarray(model.weights.T), bias_sign * model.bias
    width = model.n_features

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_blocks(batches, width):
            columns = [rows.part.column(name) for name in keep] + [list_column(rows.dot(weights) + shift)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "scores"])

    fields = [vectors.schema[name] for name in keep] + [T.StructField("scores", T.ArrayType(T.DoubleType()))]
    return vectors.select(*dict.fromkeys((*keep, "ids", "vals"))).mapInArrow(score, T.StructType(fields))


def linear_scores_long(vectors: DataFrame, weights: DataFrame, bias: DataFrame, model_rows: int, n_classes: int, bias_sign: int) -> DataFrame:
    """``(doc_id, class, score)`` from the model tables by joins, for few classes.

    A document without any weighted feature scores the bias of every class.
    """
    sums = (
        unpack(vectors, "feature_id")
        .join(lookup_side(weights, model_rows), "feature_id")
        .groupBy("doc_id", "class")
        .agg(F.sum(F.col("value") * F.col("w")).alias("s"))
    )
    biases = F.array_sort(F.collect_list(F.struct("class", "b")))
    listed = bias.agg(biases.alias("biases")).first()["biases"]
    every = F.array(*[F.struct(F.lit(r["class"]).alias("class"), F.lit(r["b"]).alias("b")) for r in listed])
    spine = vectors.select("doc_id", F.inline(every))
    score = F.coalesce("s", F.lit(0.0)) + bias_sign * F.col("b")
    return spine.join(sums, ["doc_id", "class"], "left").select("doc_id", "class", score.alias("score"))


def per_class(scored: DataFrame, keep: tuple[str, ...], classes: tuple[int, ...], name: str = "score") -> DataFrame:
    """``(keep..., class, name)``: one row per document and class from the ``scores`` array."""
    rows = scored.select(*keep, F.posexplode("scores").alias("class", name))
    if tuple(classes) == tuple(range(len(classes))):
        return rows
    listed = F.array(*[F.lit(c) for c in classes])
    return rows.withColumn("class", F.get(listed, F.col("class")))


def argmax_class(scores: Column, classes: tuple[int, ...]) -> Column:
    """Class of the largest score; the lowest class wins a tie."""
    position = F.array_position(scores, F.array_max(scores)).cast("int") - 1
    if tuple(classes) == tuple(range(len(classes))):
        return position
    return F.get(F.array(*[F.lit(int(c)) for c in classes]), position)


def signs(scores: Column) -> Column:
    return F.transform(scores, F.signum)


def probabilities(scores: Column) -> Column:
    return F.transform(scores, sigmoid_clipped)


def row_normalised(scores: Column) -> Column:
    """Scores divided by their sum."""
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s)
    return F.transform(scores, lambda s: s / total)
