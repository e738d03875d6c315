"""Scoring a stream of documents with a fitted model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lexigrade.operators.select import project
from lexigrade.plans.features import FeatureSpace, LevelData


def score_stream(
    docs: DataFrame,
    space: FeatureSpace,
    data: LevelData,
    predict: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append predictions for every arriving batch of ``(doc_id, text)`` to the parquet folder ``out``.

    The fitted vocabulary and feature map are small fixed tables, so a batch is scored by the same plan as
    a stored corpus. The batch id names the folder of a batch: a batch that is tried again replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        vectors = space.vectors(batch, ())
        rows = project(vectors, data.features, space.n_terms, data.n_features, ("doc_id",))
        predict(rows).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
