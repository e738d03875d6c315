"""Fit on train, predict all splits, report: for one level or for several."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.operators import boost, evaluate, logreg, svm
from lexigrade.operators.labels import decode_signed
from lexigrade.operators.linear import LinearModel
from lexigrade.plans.features import FeatureParams, LevelData, fit_vectors, preprocess
from lexigrade.plans.store import ModelStore, StoredModel
from lexigrade.session import shared_dir, write_stage

KEYS = ("doc_id", "split", "y")
# Weights of one block of classes: what a driver and a task hold of a model at once.
MODEL_CELLS = 4_000_000

# The parameters of the three published runs.
RUN_FEATURES = FeatureParams(top_words=10_000, skip_top_words=30, skip_least_frequent=20)
SVM_RUN = svm.SvmParams(learning_rate=0.01, lambda_param=0.01, n_iters=100)
LOGREG_RUN = logreg.LogRegParams(lr=0.01, n_iter=300, tolerance=1e-6, alpha=0.01)
BOOST_RUN = boost.BoostParams(
    n_estimators=3, learning_rate=0.1, max_depth=3, reg_lambda=1.0, gamma=0.1, min_samples_split=5, min_impurity_decrease=0.01
)


def fit_predict_splits(data: LevelData, fit: Callable, predict: Callable, signed: bool = False) -> tuple[object, DataFrame]:
    """The fitted model and ``(doc_id, split, y, prediction)`` of all splits, scored in one job.

    ``fit(data)`` gives a model and ``predict(rows, model, keys)`` a ``prediction``; ``signed`` maps
    predictions of -1 to 0 and all others to 1.
    """
    model = fit(data)
    predictions = predict(data.rows, model, KEYS)
    if signed:
        predictions = predictions.withColumn("prediction", decode_signed(F.col("prediction")))
    return model, predictions


def fit_svm(data: LevelData, params: svm.SvmParams = SVM_RUN):
    return svm.svm_ovr_fit(data.train, data.n_train, data.n_features, len(data.classes), params)


def fit_logreg(data: LevelData, params: logreg.LogRegParams = LOGREG_RUN):
    return logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, params)


def fit_boost(data: LevelData, params: boost.BoostParams = BOOST_RUN):
    return boost.boost_ovr_fit(data.train, data.classes, params)


def class_blocks(classes: Sequence[int], n_features: int, cells: int = MODEL_CELLS) -> list[tuple[int, ...]]:
    """The classes in order, cut into blocks whose weights have at most ``cells`` numbers."""
    size = max(1, cells // max(1, n_features))
    return [tuple(classes[i : i + size]) for i in range(0, len(classes), size)]


def _fit_block(data: LevelData, kind: str, params, block: tuple[int, ...]) -> tuple[LinearModel | boost.BoostModel, list[logreg.Snapshot]]:
    """The model of some classes of a level; each class is trained against all other rows, so blocks do not change it."""
    if kind == "svm":
        return svm.svm_ovr_fit(data.train, data.n_train, data.n_features, len(data.classes), params, block), []
    if kind == "boost":
        return boost.boost_ovr_fit(data.train, block, params), []
    mode = params.mode
    if mode == "auto":
        mode = "stochastic" if len(data.classes) > 2 else "batch"
    fit = logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, block, replace(params, mode=mode))
    return fit.model, fit.snapshots


def run_level(data: LevelData, kind: str, params, store: ModelStore, name: str, cells: int = MODEL_CELLS) -> DataFrame:
    """Train a level block by block into the store, predict all splits with what was stored, keep predictions and curve; the stored predictions."""
    version, blocks = store.next_version(name), class_blocks(data.classes, data.n_features, cells)
    curves = []
    for i, block in enumerate(blocks):
        model, snapshots = _fit_block(data, kind, params, block)
        store.write_block(name, version, i, kind, model)
        if kind == "logreg":
            seen = data.rows.where(F.col("split").isin("train", "validation"))
            curves.append(write_stage(logreg.lr_curve(seen, snapshots, data.n_features), "curve"))
    if curves:
        store.write_table("curves", name, version, reduce(DataFrame.unionByName, curves))
    store.commit(name, version, kind, blocks, data.n_features, params)
    return store.write_table("predictions", name, version, store.predict(data.rows, name, KEYS, version))


def report(predictions: DataFrame, model: str) -> DataFrame:
    return evaluate.summary(evaluate.confusion(predictions, ("split",)), model)


@dataclass(frozen=True)
class LogRegRun:
    fit: logreg.LogRegFit
    predictions: DataFrame
    summary: DataFrame
    curve: DataFrame


def lr_run(data: LevelData, params: logreg.LogRegParams = LOGREG_RUN) -> LogRegRun:
    """Fit, predict the three splits, report them, and keep the learning curve of every class."""
    fit, predictions = fit_predict_splits(
        data, lambda d: fit_logreg(d, params), lambda rows, m, keep: logreg.lr_ovr_predict(rows, m.model, keep)
    )
    seen = data.rows.where(F.col("split").isin("train", "validation"))
    curve = write_stage(logreg.lr_curve(seen, fit.snapshots, data.n_features), "curve")
    return LogRegRun(fit, predictions, report(predictions, "logistic regression"), curve)


def default_store(docs: DataFrame) -> ModelStore:
    """A store of its own in the shared folder."""
    return ModelStore(docs.sparkSession, f"{shared_dir(docs.sparkSession)}/models-{uuid.uuid4().hex}")


def _levels(docs: DataFrame, levels: Sequence[str], params: FeatureParams, run: Callable[[LevelData, str], DataFrame]) -> DataFrame:
    # Vocabulary and vectors are shared by all levels of one representation.
    space, vectors = fit_vectors(docs, params, ("split", *levels))
    parts = []
    for level in levels:
        data = preprocess(space, vectors, level)
        parts.append(run(data, level).select(F.lit(level).alias("level"), F.lit(params.representation).alias("representation"), "*"))
    return reduce(DataFrame.unionByName, parts)


def svm_levels(
    docs: DataFrame,
    levels: Sequence[str],
    representations: Sequence[str] = ("bow", "tfidf"),
    features: FeatureParams = RUN_FEATURES,
    params: svm.SvmParams = SVM_RUN,
    store: ModelStore | None = None,
) -> DataFrame:
    """Summary of every level and representation; models and predictions stay in ``store`` as ``svm/<level>/<representation>``."""
    store = store or default_store(docs)
    parts = []
    for representation in representations:
        chosen = FeatureParams(features.top_words, features.skip_top_words, features.skip_least_frequent, representation)
        run = lambda data, level, r=representation: report(run_level(data, "svm", params, store, f"svm/{level}/{r}"), "linear SVM")
        parts.append(_levels(docs, levels, chosen, run))
    return reduce(DataFrame.unionByName, parts)


def lr_levels(
    docs: DataFrame,
    levels: Sequence[str],
    features: FeatureParams = RUN_FEATURES,
    params: logreg.LogRegParams = LOGREG_RUN,
    store: ModelStore | None = None,
) -> tuple[DataFrame, dict[str, StoredModel]]:
    """Summary of every level, and the stored models ``logreg/<level>`` with their predictions and curves."""
    store = store or default_store(docs)
    run = lambda data, level: report(run_level(data, "logreg", params, store, f"logreg/{level}"), "logistic regression")
    return _levels(docs, levels, features, run), {level: StoredModel(store, f"logreg/{level}") for level in levels}


def boost_levels(
    docs: DataFrame,
    levels: Sequence[str],
    features: FeatureParams = RUN_FEATURES,
    params: boost.BoostParams = BOOST_RUN,
    store: ModelStore | None = None,
) -> DataFrame:
    """Summary of every level; models and predictions stay in ``store`` as ``boost/<level>``."""
    store = store or default_store(docs)
    run = lambda data, level: report(run_level(data, "boost", params, store, f"boost/{level}"), "boosted trees")
    return _levels(docs, levels, features, run)
