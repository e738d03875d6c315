"""Many classes, blocks of classes, and stored models."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import entry_queries
from lexigrade.operators import boost, labels, logreg, svm
from lexigrade.plans import runs
from lexigrade.plans.features import LevelData, encode_level
from lexigrade.plans.store import ModelStore
from lexigrade.sources import corpus

PARAMS = {
    "svm": svm.SvmParams(n_iters=2, block_rows=40),
    "logreg": logreg.LogRegParams(n_iter=100, seed=3),
    "boost": boost.BoostParams(n_estimators=2, max_depth=2, min_samples_split=4),
}


def level(spark, n, width, k, seed=1):
    """A prepared level of ``k`` classes; every class occurs in train."""
    rng = np.random.default_rng(seed)
    y = np.concatenate([np.arange(k), rng.integers(0, k, n - k)])
    x = rng.poisson(0.5, (n, width)) + (rng.integers(0, width, n)[:, None] == np.arange(width))
    x[np.arange(n), y % width] += 1
    rows = [
        (i, "train" if i < n * 2 // 3 or i < k else ("validation", "test")[i % 2], int(y[i]), [int(f) for f in np.flatnonzero(r)], [float(v) for v in r[r > 0]])
        for i, r in enumerate(x)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, split string, y int, ids array<int>, vals array<double>").repartition(3).persist()
    train = docs.where("split = 'train'").drop("split").withColumn("pos", F.col("doc_id"))
    return LevelData(None, None, docs, train, train.count(), tuple(range(k)), width)


def test_ranks_are_dense_and_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("key"), F.col("id").alias("other")).repartition(3)
    placed = corpus.ranked(rows, ["key"]).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["key"] for r in sorted(placed, key=lambda r: r["rank"])] == sorted(r["key"] for r in placed)
    assert sorted(r["rank"] for r in placed) == list(range(5000))
    assert corpus.ranked(rows.limit(0), ["key"]).count() == 0
    # The window adds up one row per task, never the rows.
    text = corpus.ranked(rows, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert text.index("Window") < text.rindex("HashAggregate") and text.count("Window [") == 1


def test_five_thousand_labels(spark):
    """Codes in order of first appearance, no refusal, and a model of all classes."""
    k, n, width = 5000, 5400, 6
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"), F.concat(F.lit("label "), (F.col("id") * 4999 % k).cast("string")).alias("mark"))
    coded, index, n_classes = encode_level(docs, "mark")
    assert n_classes == k
    first: dict = {}
    for i in range(n):
        first.setdefault(f"label {i * 4999 % k}", len(first))
    assert {r["label"]: r["y"] for r in index.collect()} == first
    assert coded.count() == n and coded.agg(F.max("y")).first()[0] == k - 1
    data = level(spark, n, width, k)
    model = svm.svm_ovr_fit(data.train, data.n_train, width, k, svm.SvmParams(n_iters=1))
    assert model.weights.shape == (k, width) and np.count_nonzero(model.bias) == k


@pytest.mark.parametrize("kind", sorted(PARAMS))
def test_blocks_of_classes_equal_the_whole_model(spark, tmp_path, kind):
    data, params = level(spark, 120, 7, 11), PARAMS[kind]
    store = ModelStore(spark, str(tmp_path))
    whole = runs.run_level(data, kind, params, store, "whole")
    blocks = runs.run_level(data, kind, params, store, "blocks", cells=21)
    assert [len(r["classes"]) for r in store.entry("blocks")] == [3, 3, 3, 2] and len(store.entry("whole")) == 1
    got, want = ({r["doc_id"]: r["prediction"] for r in df.collect()} for df in (blocks, whole))
    assert got == want and len(got) == 120
    direct = {
        "svm": lambda: svm.svm_ovr_predict(data.rows, runs.fit_svm(data, params), runs.KEYS),
        "logreg": lambda: logreg.lr_ovr_predict(data.rows, runs.fit_logreg(data, params).model, runs.KEYS),
        "boost": lambda: boost.boost_ovr_predict(data.rows, runs.fit_boost(data, params), runs.KEYS),
    }[kind]()
    assert {r["doc_id"]: r["prediction"] for r in direct.collect()} == want
    with pytest.raises(ValueError, match="4 blocks"):
        store.load("blocks")


def test_versions_and_uncommitted_models(spark, tmp_path):
    """A newer version does not touch an older one; what was never committed is not there."""
    store, data = ModelStore(spark, str(tmp_path)), level(spark, 60, 5, 3)
    assert store.manifest().count() == 0
    with pytest.raises(KeyError):
        store.load("m")
    weak = runs.fit_svm(data, svm.SvmParams(n_iters=1, learning_rate=0.5))
    strong = runs.fit_svm(data, svm.SvmParams(n_iters=3))
    assert store.save("m", "svm", weak, 5, svm.SvmParams(n_iters=1)) == 1
    store.write_block("m", 2, 0, "svm", strong)
    assert np.array_equal(store.load("m").weights, weak.weights)
    assert store.save("m", "svm", strong, 5, svm.SvmParams(n_iters=3)) == 2
    assert np.array_equal(store.load("m").weights, strong.weights) and np.array_equal(store.load("m", 1).bias, weak.bias)
    trees = runs.fit_boost(data, PARAMS["boost"])
    store.save("t", "boost", trees, 5, PARAMS["boost"])
    back = store.load("t")
    assert set(back.nodes) == set(trees.nodes) and back.params == trees.params


def test_level_runs_keep_models_predictions_and_curves(spark, tmp_path):
    docs, store = entry_queries.levelled(spark, SF_SMALL), ModelStore(spark, str(tmp_path))
    features = runs.FeatureParams(600, 20, 0)
    summary, fits = runs.lr_levels(docs, ("lang", "toxic"), features, logreg.LogRegParams(n_iter=100), store)
    reported = {(r["level"], r["split"]): r["accuracy"] for r in summary.collect()}
    for name, fit in fits.items():
        kept = fit.predictions()
        hits = {r["split"]: r["hits"] for r in kept.groupBy("split").agg(F.avg((F.col("y") == F.col("prediction")).cast("int")).alias("hits")).collect()}
        assert all(np.isclose(hits[split], reported[name, split]) for split in hits)
        assert {r["iteration"] for r in fit.curve().collect()} == {100}
        assert fit.load().n_features == features.n_features


def test_stored_models_score_streams(spark, tmp_path):
    data, store = level(spark, 60, 5, 4), ModelStore(spark, str(tmp_path / "store"))
    want = runs.run_level(data, "boost", PARAMS["boost"], store, "m", cells=10)
    data.rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.rows.schema).parquet(str(tmp_path / "in"))
    query = store.predict(stream, "m", runs.KEYS).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
    query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 60 and got.exceptAll(want.select(got.columns)).count() == 0


def test_every_class_is_scanned_alike(spark, monkeypatch):
    """Classes below and above the block bound take the same steps: the jobs do not depend on which side a class is."""
    data, seen = level(spark, 200, 5, 3, seed=4), []
    kept = svm._next_misses
    monkeypatch.setattr(svm, "_next_misses", lambda rows, states, *rest: seen.append(sorted(states)) or kept(rows, states, *rest))
    models = [svm.svm_ovr_fit(data.train, data.n_train, 5, 3, svm.SvmParams(n_iters=4, block_rows=b)) for b in (10, 45, 100_000)]
    assert seen.count([0, 1, 2]) >= 3
    for m in models[1:]:
        assert np.allclose(m.weights, models[0].weights, atol=1e-12) and np.allclose(m.bias, models[0].bias)
