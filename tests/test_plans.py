import numpy as np
import pytest
from conftest import SF, SF_SMALL
from pyspark.sql import functions as F

import entry_queries
from lexigrade import session
from lexigrade.operators import boost, labels, logreg, select, svm, vectorize
from lexigrade.plans import runs
from lexigrade.plans.features import FeatureParams, fit_vectors, preprocess
from lexigrade.streaming.scoring import score_stream

FEATURES = FeatureParams(600, 20, 0)


def by_split(summary):
    return {r["split"]: r for r in summary.collect()}


def test_language_is_learnt(spark):
    """Far above the majority class (62 %) on held-out documents."""
    data = entry_queries.level_data(spark, SF)
    for fit, predict, floor in (
        (runs.fit_boost, boost.boost_ovr_predict, 0.9),
        (lambda d: runs.fit_logreg(d).model, logreg.lr_ovr_predict, 0.9),
    ):
        _, predictions = runs.fit_predict_splits(data, fit, predict)
        report = by_split(runs.report(predictions, "m"))
        assert set(report) == {"train", "validation", "test"}
        assert report["test"]["accuracy"] > floor and report["validation"]["accuracy"] > floor


def test_every_document_gets_one_prediction(spark):
    docs = entry_queries.levelled(spark, SF_SMALL)
    extra = docs.limit(2).withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("text", F.when(F.col("doc_id") % 2 == 0, "").otherwise(None))
    both = docs.unionByName(extra)
    space, vectors = fit_vectors(both, FEATURES, ("split", "lang"))
    data = preprocess(space, vectors, "lang", 40)
    model = runs.fit_svm(data, svm.SvmParams(n_iters=2))
    got = svm.svm_ovr_predict(data.rows, model, ("doc_id",)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in both.select("doc_id").collect())
    by_margin = svm.svm_ovr_predict(data.rows, model, ("doc_id",), decision="margin")
    assert by_margin.count() == len(got)


def test_runs_over_levels(spark):
    docs = entry_queries.levelled(spark, SF_SMALL)
    summary, fits = runs.lr_levels(docs, ("lang", "toxic"), FEATURES, logreg.LogRegParams(n_iter=100))
    assert set(fits) == {"lang", "toxic"}
    assert {(r["level"], r["split"]) for r in summary.collect()} == {(v, s) for v in ("lang", "toxic") for s in ("train", "validation", "test")}
    both = runs.svm_levels(docs, ("lang",), features=FEATURES, params=svm.SvmParams(n_iters=3)).collect()
    assert {r["representation"] for r in both} == {"bow", "tfidf"} and len(both) == 6
    assert len(runs.boost_levels(docs, ("lang",), FEATURES, boost.BoostParams(n_estimators=1, max_depth=1)).collect()) == 3


def test_curve_matches_the_final_model(spark):
    data = entry_queries.level_data(spark, SF_SMALL)
    done = runs.lr_run(data, logreg.LogRegParams(n_iter=200))
    points = {(r["class"], r["iteration"], r["split"]): r for r in done.curve.collect()}
    assert set(points) == {(c, i, s) for c in data.classes for i in (100, 200) for s in ("train", "validation")}
    scored = logreg.lr_ovr_scores(data.rows, done.fit.model, ("split", "y")).collect()
    for c in data.classes:
        hits = [(r["scores"][c] > 0.5) == (r["y"] == c) for r in scored if r["split"] == "train"]
        assert np.isclose(points[(c, 200, "train")]["accuracy"], np.mean(hits))
    assert logreg.lr_curve(data.rows, [], data.n_features).count() == 0


def test_signed_predictions(spark):
    data = entry_queries.level_data(spark, SF_SMALL)
    predict = lambda rows, model, keep: rows.select(*keep, F.when(F.col("doc_id") % 2 == 0, -1).otherwise(2).alias("prediction"))
    _, predictions = runs.fit_predict_splits(data, lambda d: None, predict, signed=True)
    assert {(r["doc_id"] % 2, r["prediction"]) for r in predictions.collect()} == {(0, 0), (1, 1)}


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    docs = entry_queries.documents(spark, SF_SMALL).select("doc_id", "text")
    space, data = entry_queries.space(spark, SF_SMALL, "bow"), entry_queries.level_data(spark, SF_SMALL)
    model = logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, entry_queries.STEP).model
    predict = lambda rows: logreg.lr_ovr_predict(rows, model, ("doc_id",))
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = score_stream(stream, space, data, predict, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch").distinct().count() == 3
    want = logreg.lr_ovr_predict(data.rows, model, ("doc_id",))
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


# -- physical plans ---------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vectors_and_counts_take_no_exchange(spark):
    space = entry_queries.space(spark, SF_SMALL, "tfidf")
    docs = entry_queries.documents(spark, SF_SMALL)
    for df in (space.vectors(docs, ("split",)), vectorize.term_counts(docs)):
        assert "Exchange" not in plan(df) and "lang:string" not in plan(df)


def test_cells_are_summed_before_the_exchange(spark):
    data = entry_queries.level_data(spark, SF_SMALL)
    params, rows = entry_queries.TREE, boost.with_logits(data.train, data.classes, entry_queries.TREE)
    stats = boost.value_stats(rows)
    hist = boost.node_histograms(rows, data.classes, 0, {c: [0] for c in data.classes}, [], [], stats, params)
    text = plan(boost.split_candidates(hist, boost.root_totals(hist, data.classes), stats, params))
    # One exchange, of histogram rows: every task sends a feature at most once, whatever the number of documents.
    assert text.count("Exchange") == 1 and "hashpartitioning(bucket" in text
    parts = boost._partial_histograms(rows, data.classes, 0, [(c, 0) for c in data.classes], [], [], stats, params)
    tasks = rows.withColumn("t", F.spark_partition_id()).select("t").distinct().count()
    assert parts.count() <= tasks * (data.n_features + 1)


def test_scoring_moves_no_rows(spark):
    data = entry_queries.level_data(spark, SF_SMALL)
    model = logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, entry_queries.STEP).model
    trees = boost.build_trees(data.train, data.classes, entry_queries.TREE)
    for df in (logreg.lr_ovr_proba(data.rows, model, ("doc_id",)), boost.boost_ovr_predict(data.rows, trees, ("doc_id",))):
        assert "Exchange" not in plan(df)
        assert "ids:array<int>" in plan(df) and "split" not in plan(df)


def test_no_cartesian_products(spark):
    for name in ("mutual_information", "contingency", "svm_margin", "split_gain", "metrics_matrix", "label_index"):
        text = plan(entry_queries.QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_large_lookup_sides_are_not_forced(spark, monkeypatch):
    side = spark.range(10)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 5)
    assert session.lookup_side(side, 6) is side
    assert session.count_up_to(side, 4) == 5


def test_heldout_rows_do_not_change_the_fit(spark):
    docs = entry_queries.documents(spark, SF_SMALL)
    train = docs.where("split = 'train'")
    assert vectorize.fit_vocab(train, 50).collect() == vectorize.fit_vocab(docs.where("split = 'train'"), 50).collect()
    index = labels.label_index(train.withColumn("label", F.col("lang")))
    rows = labels.encode_train(train.withColumn("label", F.col("lang")), index, 4)
    assert rows.count() == train.count()
    with pytest.raises(ValueError):
        select.top_k_features(spark.createDataFrame([(0, 0.1)], "term_id int, mi double"), -1)
