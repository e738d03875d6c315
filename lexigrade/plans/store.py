"""Versioned models of the runs, with their predictions and curves, as tables of one folder.

``base/models/<name>/v<number>/`` holds the model tables of one version, ``base/predictions`` and ``base/curves`` what it predicted and how it
learnt. A version exists once its row stands in the manifest, which is written last: what a failed run leaves behind is never read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrade.operators import boost, logreg, svm
from lexigrade.operators.boost import BoostModel, BoostParams
from lexigrade.operators.linear import LinearModel

MANIFEST = "name string, version int, kind string, block int, classes array<int>, n_features int, params string"
KINDS = ("svm", "logreg", "boost")

Model = LinearModel | BoostModel


@dataclass(frozen=True)
class ModelStore:
    """Models by name and version. A model of very many classes is kept, trained and scored in blocks of classes."""

    spark: SparkSession
    base: str

    # -- writing --

    def next_version(self, name: str) -> int:
        return max((r["version"] for r in self._rows(name)), default=0) + 1

    def write_block(self, name: str, version: int, block: int, kind: str, model: Model) -> None:
        """The tables of one block of classes."""
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}: choose one of {KINDS}")
        path = self._path("models", name, version, block)
        if kind == "boost":
            model.tree_table(self.spark).write.mode("overwrite").parquet(f"{path}/trees")
        else:
            model.weight_table(self.spark).write.mode("overwrite").parquet(f"{path}/weights")
            model.bias_table(self.spark).write.mode("overwrite").parquet(f"{path}/bias")

    def write_table(self, what: str, name: str, version: int, table: DataFrame) -> DataFrame:
        """Store predictions or a curve and read them back."""
        path = self._path(what, name, version)
        table.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def commit(self, name: str, version: int, kind: str, blocks: Sequence[Sequence[int]], n_features: int, params: object) -> None:
        """Make the version visible."""
        given = json.dumps({k: v for k, v in asdict(params).items()}, sort_keys=True)
        rows = [(name, version, kind, i, [int(c) for c in block], n_features, given) for i, block in enumerate(blocks)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.base}/manifest")

    def save(self, name: str, kind: str, model: Model, n_features: int, params: object) -> int:
        """Store a whole model as a new version."""
        version = self.next_version(name)
        self.write_block(name, version, 0, kind, model)
        self.commit(name, version, kind, [model.classes], n_features, params)
        return version

    # -- reading --

    def manifest(self) -> DataFrame:
        """One row per committed block; no rows before the first commit."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest")

    def _rows(self, name: str, version: int | None = None) -> list:
        rows = self.manifest().where(F.col("name") == name)
        found = rows.collect() if version is None else rows.where(F.col("version") == version).collect()
        return sorted(found, key=lambda r: (r["version"], r["block"]))

    def _path(self, what: str, name: str, version: int, block: int | None = None) -> str:
        return f"{self.base}/{what}/{name}/v{version}" + ("" if block is None else f"/block={block}")

    def entry(self, name: str, version: int | None = None) -> list:
        """The manifest rows of a version, the newest by default."""
        rows = self._rows(name, version)
        if not rows:
            raise KeyError(f"no model {name!r}" + ("" if version is None else f" of version {version}"))
        newest = max(r["version"] for r in rows)
        return [r for r in rows if r["version"] == newest]

    def block(self, row) -> Model:
        path = self._path("models", row["name"], row["version"], row["block"])
        classes = tuple(row["classes"])
        if row["kind"] == "boost":
            trees = self.spark.read.schema(boost.TREE_SCHEMA).parquet(f"{path}/trees")
            return BoostModel.from_table(trees, classes, BoostParams(**json.loads(row["params"])))
        weights = self.spark.read.schema("class int, feature_id int, w double").parquet(f"{path}/weights")
        bias = self.spark.read.schema("class int, b double").parquet(f"{path}/bias")
        return LinearModel.from_tables(weights, bias, row["n_features"])

    def load(self, name: str, version: int | None = None) -> Model:
        """The model of a version that has one block."""
        rows = self.entry(name, version)
        if len(rows) > 1:
            raise ValueError(f"{name!r} has {len(rows)} blocks of classes: score it with predict()")
        return self.block(rows[0])

    def predict(self, rows: DataFrame, name: str, keep: tuple[str, ...], version: int | None = None) -> DataFrame:
        """``(keep..., prediction)`` by a stored version, batch or stream, one block of classes after the other.

        Map-only: a block passes its best class so far on to the next one. Earlier blocks hold the lower classes and win ties.
        """
        entries = self.entry(name, version)
        best = rows.select(*keep, "ids", "vals", F.lit(None).cast("double").alias("_score"), F.lit(None).cast("int").alias("prediction"))
        for row in entries:
            scored = SCORES[row["kind"]](best, self.block(row), (*keep, "ids", "vals", "_score", "prediction"))
            top = F.array_max("scores")
            names = F.array(*[F.lit(int(c)) for c in row["classes"]])
            found = F.get(names, F.array_position("scores", top).cast("int") - 1)
            better = F.col("_score").isNull() | (top > F.col("_score"))
            best = scored.select(
                *keep, "ids", "vals", F.when(better, top).otherwise(F.col("_score")).alias("_score"), F.when(better, found).otherwise(F.col("prediction")).alias("prediction")
            )
        return best.select(*keep, "prediction")

    def predictions(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._path("predictions", name, self.entry(name, version)[0]["version"]))

    def curve(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._path("curves", name, self.entry(name, version)[0]["version"]))


@dataclass(frozen=True)
class StoredModel:
    """A version in a store: everything is read from there when it is asked for."""

    store: ModelStore
    name: str
    version: int | None = None

    def load(self) -> Model:
        return self.store.load(self.name, self.version)

    def predict(self, rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        return self.store.predict(rows, self.name, keep, self.version)

    def predictions(self) -> DataFrame:
        return self.store.predictions(self.name, self.version)

    def curve(self) -> DataFrame:
        return self.store.curve(self.name, self.version)


def _svm_scores(rows: DataFrame, model: LinearModel, keep: tuple[str, ...]) -> DataFrame:
    return svm.svm_margins(rows, model, keep).withColumn("scores", F.transform("scores", F.signum))


def _boost_scores(rows: DataFrame, model: BoostModel, keep: tuple[str, ...]) -> DataFrame:
    return boost.boost_proba(rows, model, keep).withColumn("scores", F.transform("scores", lambda s: F.round(s, 12)))


#: What the classes of a kind are compared by.
SCORES: dict[str, Callable[[DataFrame, Model, tuple[str, ...]], DataFrame]] = {
    "svm": _svm_scores,
    "logreg": logreg.lr_ovr_scores,
    "boost": _boost_scores,
}
