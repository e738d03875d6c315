"""The registered queries: every operator over the whole document tables.

Levels: ``lang`` (four classes), ``source`` (twenty), ``size`` (text length class, some only in held-out
splits), ``quality`` and ``toxic`` (two classes, a labelled part of the documents).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entry_sql import RUN_DEPTH, RUN_EPOCHS, RUN_LEVELS, RUN_ROUNDS, RUN_STEPS
from lexigrade.functions import numeric
from lexigrade.functions.text import word_tokens, ws_tokens
from lexigrade.operators import boost, evaluate, labels, linear, logreg, select, sequences, svm, vectorize
from lexigrade.plans import runs
from lexigrade.plans.features import FeatureParams, FeatureSpace, LevelData, fit_feature_space, fit_vocabulary, preprocess
from lexigrade.session import shared_dir, write_stage
from lexigrade.sources import corpus

TOP_WORDS, SKIP_TOP, SKIP_RARE = 2000, 30, 20
LEVELS = ("lang", "source", "size", "quality", "toxic")

# Step sizes and tree settings of the single training steps that SQL can follow.
STEP = logreg.LogRegParams(lr=0.01, alpha=0.01, n_iter=1, batch_size=None, mode="batch")
TREE = boost.BoostParams(n_estimators=1, learning_rate=0.1, max_depth=2, min_samples_split=5, min_impurity_decrease=0.01, reg_lambda=1.0, gamma=0.1)
# Whole trainings, short enough for SQL to follow.
SVM = svm.SvmParams(learning_rate=0.01, lambda_param=0.01, n_iters=RUN_EPOCHS)
LOGREG = logreg.LogRegParams(lr=0.01, alpha=0.01, n_iter=RUN_STEPS, batch_size=None, seed=7)
BOOST = boost.BoostParams(**{**vars(TREE), "n_estimators": RUN_ROUNDS, "max_depth": RUN_DEPTH})
# The published training of one level, here with all rows of train in every iteration.
LR_RUN = replace(runs.LOGREG_RUN, batch_size=None, mode="batch")

_fitted: dict[tuple, object] = {}


def _once(spark: SparkSession, key: tuple, make: Callable):
    """Fitted tables are written to the shared folder and reused by the queries of one application."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _fitted:
        _fitted[full] = make()
    return _fitted[full]


# -- inputs -----------------------------------------------------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a split: blocks of twenty ids go to train (three of five), validation and test."""
    block = F.floor(F.col("doc_id") / 20) % 5
    split = F.when(block < 3, "train").when(block == 3, "validation").otherwise("test")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", "text", "lang", "source", "n_chars", F.floor(F.col("n_chars") / 500).cast("int").alias("size"), split.alias("split"))


def levelled(spark: SparkSession, sf: str) -> DataFrame:
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    return documents(spark, sf).join(marks, "doc_id", "left")


def level_rows(spark: SparkSession, sf: str, level: str) -> DataFrame:
    return corpus.select_level(levelled(spark, sf), level).select("doc_id", "split", "label", "n_chars")


def space(spark: SparkSession, sf: str, representation: str) -> FeatureSpace:
    params = FeatureParams(TOP_WORDS, SKIP_TOP, SKIP_RARE, representation)
    counted = lambda: _once(spark, ("vocabulary", sf), lambda: fit_vocabulary(documents(spark, sf), params))
    return _once(spark, ("space", sf, representation), lambda: fit_feature_space(documents(spark, sf), params, counted()))


def vectors(spark: SparkSession, sf: str, representation: str) -> DataFrame:
    fitted = space(spark, sf, representation)
    make = lambda: write_stage(fitted.vectors(levelled(spark, sf), ("split", *LEVELS)), "vectors")
    return _once(spark, ("vectors", sf, representation), make)


def level_data(spark: SparkSession, sf: str, level: str = "lang", representation: str = "bow") -> LevelData:
    make = lambda: preprocess(space(spark, sf, representation), vectors(spark, sf, representation), level)
    return _once(spark, ("level", sf, level, representation), make)


def coded(spark: SparkSession, sf: str, level: str) -> DataFrame:
    rows = level_rows(spark, sf, level)
    index = labels.label_index(rows.where("split = 'train'"))
    return labels.encode_heldout(rows, index, index.count())


def r6(name: str, column=None):
    return F.round(F.col(name) if column is None else column, 6).alias(name)


def named(long: DataFrame, fitted: FeatureSpace, id_name: str = "term_id") -> DataFrame:
    """Replace term ids by terms."""
    return long.join(F.broadcast(fitted.vocabulary()), id_name).drop(id_name)


# -- sources and sequences --------------------------------------------------------------------------


def q_read_corpus(spark, sf):
    """Text and label files of three splits, several files each and without ids, as corpora are published."""
    base = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    paths = {split: f"{base}/{split}" for split in corpus.SPLITS}
    for split, path in paths.items():
        rows = documents(spark, sf).where(F.col("split") == split).orderBy("doc_id")
        rows.select("text", F.col("lang").alias("label")).write.option("maxRecordsPerFile", 1000).parquet(path)
    return corpus.read_corpus(spark, paths).select("doc_id", "split", "label", F.length("text").alias("chars"))


def q_select_level(spark, sf):
    parts = [level_rows(spark, sf, level).select(F.lit(level).alias("level"), "split", F.col("label").cast("string").alias("label")) for level in LEVELS]
    return reduce(DataFrame.unionByName, parts).groupBy("level", "split", "label").agg(F.count(F.lit(1)).alias("n_docs"))


def q_report_sink(spark, sf):
    path = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    corpus.write_report(evaluate.metrics_matrix(guess_cells(spark, sf), ("split",)), path)
    return spark.read.parquet(path)


def q_word_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", F.posexplode(word_tokens(F.col("text"))).alias("at", "token"))


def q_ws_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", F.posexplode(ws_tokens(F.col("text"))).alias("at", "token"))


def _sequences(spark, sf):
    """Sequences of all documents; a label that train does not have, or none, has code -1."""
    fitted = space(spark, sf, "bow")
    docs = documents(spark, sf)
    index = labels.label_index(docs.where("split = 'train' AND lang IS NOT NULL").withColumn("label", F.col("lang")))
    make = lambda: labels.encode_heldout(
        sequences.encode_sequences(docs, fitted.terms, fitted.n_terms, ("split", "lang")).withColumnRenamed("lang", "label"), index, index.count()
    )
    return _once(spark, ("seq", sf), lambda: write_stage(make(), "sequences"))


def q_pad_length(spark, sf):
    seqs = _sequences(spark, sf)
    size = F.size("seq")
    both = seqs.agg(F.floor(F.avg(size)).alias("average"), F.max(size).cast("long").alias("longest"))
    return both.select(F.inline(F.array(*[F.struct(F.lit(n).alias("padding"), F.col(n).alias("length")) for n in ("average", "longest")])))


def _padded_text(padded: DataFrame) -> DataFrame:
    return padded.withColumn("x", F.array_join("x", " "))


def q_pad_truncate(spark, sf):
    seqs = _sequences(spark, sf)
    length = sequences.pad_length(seqs, "average")
    return _padded_text(seqs.select("doc_id", sequences.pad_truncate(F.col("seq"), length).alias("x")))


def q_padded_dataset(spark, sf):
    """All splits, cut and filled to the average length of each."""
    every = _sequences(spark, sf)
    parts = [sequences.padded_dataset(every.where(F.col("split") == split), "average")[0].withColumn("split", F.lit(split)) for split in corpus.SPLITS]
    return _padded_text(reduce(DataFrame.unionByName, parts))


# -- vectorising ------------------------------------------------------------------------------------


def _train(spark, sf):
    return documents(spark, sf).where("split = 'train'")


def q_term_counts(spark, sf):
    return vectorize.term_counts(documents(spark, sf))


def q_fit_vocab(spark, sf):
    params = FeatureParams(TOP_WORDS, SKIP_TOP, SKIP_RARE)
    return vectorize.fit_vocab(_train(spark, sf), params.max_terms).select("term", "term_id", "tf")


def q_doc_freq(spark, sf):
    return vectorize.corpus_terms(_train(spark, sf)).select("term", "df")


def q_corpus_vocabulary(spark, sf):
    """Terms of the train split with counts and idf."""
    train = _train(spark, sf)
    terms = vectorize.corpus_terms(train)
    return terms.select("term", "tf", "df", r6("idf", vectorize.smooth_idf(F.col("df"), train.count())))


def q_smooth_idf(spark, sf):
    return space(spark, sf, "tfidf").terms.select("term", "df", r6("idf"))


def _whole_tfidf(spark, sf, docs):
    """Cells over the whole vocabulary, before any term is dropped."""
    fitted = space(spark, sf, "tfidf")
    packed = vectorize.pack_vectors(docs, fitted.terms.drop("kept"), fitted.n_terms, "tfidf", ("split",))
    return named(vectorize.unpack(packed, keep=("doc_id", "split")), fitted)


def q_tfidf_l2(spark, sf):
    return _whole_tfidf(spark, sf, documents(spark, sf)).select("doc_id", "split", "term", r6("value"))


def q_transform_heldout(spark, sf):
    heldout = documents(spark, sf).where("split <> 'train'")
    return _whole_tfidf(spark, sf, heldout).select("doc_id", "split", "term", r6("value"))


def _both(spark, sf, pick: Callable[[FeatureSpace], DataFrame]) -> DataFrame:
    parts = [pick(space(spark, sf, r)).select(F.lit(r).alias("representation"), "*") for r in vectorize.REPRESENTATIONS]
    return reduce(DataFrame.unionByName, parts)


def q_term_weight_rank(spark, sf):
    return _both(spark, sf, lambda s: s.terms.select("term", r6("weight"), "rank"))


def q_skip_top_words(spark, sf):
    return _both(spark, sf, lambda s: s.terms.select("term", "rank", "kept"))


def q_keep_columns(spark, sf):
    cells = vectorize.unpack(vectors(spark, sf, "bow"), keep=("doc_id", "split"))
    return named(cells, space(spark, sf, "bow"))


def q_vocabulary(spark, sf):
    return space(spark, sf, "bow").vocabulary()


# -- labels -----------------------------------------------------------------------------------------


def q_label_index(spark, sf):
    parts = [
        labels.label_index(level_rows(spark, sf, level).where("split = 'train'")).select(F.lit(level).alias("level"), F.col("label").cast("string").alias("label"), "y")
        for level in LEVELS
    ]
    return reduce(DataFrame.unionByName, parts)


def q_encode_train(spark, sf):
    train = level_rows(spark, sf, "source").where("split = 'train'")
    index = labels.label_index(train)
    return labels.encode_train(train, index, index.count()).select("doc_id", "label", "y")


def q_encode_heldout(spark, sf):
    return coded(spark, sf, "size").where("split <> 'train'").select("doc_id", "split", "label", "y")


def q_drop_unseen(spark, sf):
    return labels.drop_unseen(coded(spark, sf, "size")).select("doc_id", "split", "label", "y")


def q_distinct_classes(spark, sf):
    return labels.distinct_classes(coded(spark, sf, "source").where("split = 'train'"))


def q_one_vs_rest_labels(spark, sf):
    data = level_data(spark, sf)
    return labels.one_vs_rest(data.rows, list(data.classes))


def q_decode_signed(spark, sf):
    sign = svm.svm_sign(F.col("score"))
    return _margins(spark, sf).select("doc_id", "class", labels.decode_signed(sign).alias("decoded"))


# -- selection --------------------------------------------------------------------------------------


def _cells(spark, sf):
    fitted, data = space(spark, sf, "bow"), level_data(spark, sf)
    rows = labels.encode_train(vectors(spark, sf, "bow").where("split = 'train'").withColumn("label", F.col("lang")), data.index, len(data.classes))
    return fitted, select.contingency(rows), select.class_totals(rows)


def q_contingency(spark, sf):
    fitted, cells, totals = _cells(spark, sf)
    sizes = {r["y"]: r["n_class"] for r in totals.collect()}
    return named(select.with_zero_cells(cells, sizes), fitted)


def q_mutual_information(spark, sf):
    fitted, cells, totals = _cells(spark, sf)
    mi = select.mutual_information(cells, totals, len(level_data(spark, sf).classes), fitted.n_train)
    return named(mi, fitted).select("term", r6("mi"))


def q_top_k_features(spark, sf):
    return named(level_data(spark, sf).features, space(spark, sf, "bow")).select("term", "feature_id", r6("mi"))


def q_project_splits(spark, sf):
    return vectorize.unpack(level_data(spark, sf).rows, "feature_id", ("doc_id", "split"))


def q_preprocess(spark, sf):
    rows = level_data(spark, sf, "source", "tfidf").rows
    return vectorize.unpack(rows, "feature_id", ("doc_id", "split", "y")).withColumn("value", F.round("value", 6))


# -- linear models ----------------------------------------------------------------------------------


def _step_model(spark, sf, steps: int = 1) -> linear.LinearModel:
    """Weights after a few full-batch steps from zero."""
    data = level_data(spark, sf)
    params = logreg.LogRegParams(lr=STEP.lr, alpha=STEP.alpha, n_iter=steps, batch_size=None, mode="batch")
    make = lambda: logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, params).model
    return _once(spark, ("step", sf, steps), make)


def _long_scores(spark, sf, bias_sign: int) -> DataFrame:
    """``(doc_id, class, score)``, scored in one map."""
    model = _step_model(spark, sf)
    return linear.per_class(linear.linear_scores(level_data(spark, sf).rows, model, bias_sign, ("doc_id",)), ("doc_id",), model.classes)


def _margins(spark, sf):
    return _long_scores(spark, sf, -1)


def model_rows(spark: SparkSession, model: linear.LinearModel) -> DataFrame:
    """``(class, feature_id, w)`` with the bias under feature -1."""
    bias = model.bias_table(spark).select("class", F.lit(-1).alias("feature_id"), F.col("b").alias("w"))
    return model.weight_table(spark).unionByName(bias)


def q_svm_margin(spark, sf):
    return _margins(spark, sf).select("doc_id", "class", r6("score"))


def q_svm_sign(spark, sf):
    return _margins(spark, sf).select("doc_id", "class", svm.svm_sign(F.col("score")).cast("int").alias("sign"))


def q_svm_ovr_predict(spark, sf):
    return svm.svm_ovr_predict(level_data(spark, sf).rows, _step_model(spark, sf), ("doc_id",))


def q_svm_fit(spark, sf):
    """One class against the rest: the labelled documents of good quality."""
    data = level_data(spark, sf, "quality")
    return model_rows(spark, svm.svm_fit(data.train, data.n_train, data.n_features, SVM)).withColumn("w", F.round("w", 8))


def q_svm_ovr_fit(spark, sf):
    return model_rows(spark, runs.fit_svm(level_data(spark, sf), SVM)).withColumn("w", F.round("w", 8))


def q_sigmoid_clipped(spark, sf):
    """Scores far beyond the clip: the logarithm of the small side tells a clipped argument from an unclipped one."""
    z = F.col("score") * 5000.0
    low = F.ln(numeric.sigmoid_clipped(-F.abs(z)))
    return _long_scores(spark, sf, 1).select("doc_id", "class", r6("p", numeric.sigmoid_clipped(z)), r6("log_of_smaller", low))


def q_linear_score(spark, sf):
    return _long_scores(spark, sf, 1).select("doc_id", "class", r6("score"))


def q_lr_fit_batch(spark, sf):
    return model_rows(spark, _step_model(spark, sf, 2)).withColumn("w", F.round("w", 8))


def q_lr_fit_stochastic(spark, sf):
    data = level_data(spark, sf)
    params = logreg.LogRegParams(n_iter=300, mode="stochastic", seed=7)
    model = logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, params).model
    return model_rows(spark, model).withColumn("w", F.round("w", 8))


def _iterations(spark, fit: logreg.LogRegFit) -> DataFrame:
    return spark.createDataFrame(sorted(fit.iterations.items()), "class int, iterations int")


def q_lr_stop_batch(spark, sf):
    """Classes whose first gradient is small stop after one iteration, the others go on."""
    data = level_data(spark, sf)
    params = logreg.LogRegParams(lr=STEP.lr, alpha=STEP.alpha, n_iter=2, batch_size=None, mode="batch", tolerance=2.4)
    return _iterations(spark, logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, params))


def q_lr_stop_window(spark, sf):
    data = level_data(spark, sf)
    params = logreg.LogRegParams(n_iter=300, mode="stochastic", tolerance=5.0, seed=7)
    return _iterations(spark, logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, params))


def q_lr_curve(spark, sf):
    """The curve of a real training: what the trainer recorded of every class after each hundred steps."""
    data = level_data(spark, sf)
    params = logreg.LogRegParams(n_iter=200, mode="stochastic", seed=7)
    fit = logreg.lr_ovr_fit(data.train, data.n_train, data.n_features, data.classes, params)
    curve = logreg.lr_curve(data.rows.where("split <> 'test'"), fit.snapshots, data.n_features)
    return curve.withColumn("accuracy", F.round("accuracy", 6))


def _class_scores(scored: DataFrame, name: str, classes: tuple[int, ...]) -> DataFrame:
    return linear.per_class(scored, ("doc_id",), classes, name)


def q_lr_proba(spark, sf):
    scored = logreg.lr_ovr_scores(level_data(spark, sf).rows, _step_model(spark, sf), ("doc_id",))
    return _class_scores(scored, "p", _step_model(spark, sf).classes).withColumn("p", F.round("p", 6))


def q_lr_predict(spark, sf):
    scored = logreg.lr_ovr_scores(level_data(spark, sf).rows, _step_model(spark, sf), ("doc_id",))
    return _class_scores(scored, "p", _step_model(spark, sf).classes).select("doc_id", "class", logreg.lr_predict(F.col("p")).alias("prediction"))


def q_lr_ovr_fit(spark, sf):
    """Two classes: three steps over all rows."""
    data = level_data(spark, sf, "toxic")
    params = logreg.LogRegParams(lr=STEP.lr, alpha=STEP.alpha, n_iter=3, batch_size=None)
    return model_rows(spark, runs.fit_logreg(data, params).model).where("w <> 0 or feature_id = -1").withColumn("w", F.round("w", 8))


def q_lr_ovr_predict(spark, sf):
    return logreg.lr_ovr_predict(level_data(spark, sf).rows, _step_model(spark, sf), ("doc_id",))


def q_lr_ovr_proba(spark, sf):
    scored = logreg.lr_ovr_proba(level_data(spark, sf).rows, _step_model(spark, sf), ("doc_id",))
    return _class_scores(scored, "p", _step_model(spark, sf).classes).withColumn("p", F.round("p", 6))


def q_lr_run(spark, sf):
    """All iterations of the published run, the predictions of the three splits, and the curve."""
    summary = runs.lr_run(level_data(spark, sf), LR_RUN).summary
    return summary.withColumn("accuracy", F.round("accuracy", 6))


def q_binary_metrics(spark, sf):
    """A length rule as a prediction of good quality."""
    rows = coded(spark, sf, "quality").select("split", F.col("label").alias("y"), (F.col("n_chars") > 1500).cast("int").alias("prediction"))
    return evaluate.binary_metrics(rows, ("split",)).withColumn("accuracy", F.round("accuracy", 6))


# -- boosted trees ----------------------------------------------------------------------------------


def q_init_logit(spark, sf):
    """Initial logit with the share of each class as base score."""
    data = level_data(spark, sf)
    shares = data.train.groupBy("y").agg((F.count(F.lit(1)) / F.lit(data.n_train)).alias("share"))
    return shares.select(F.col("y").alias("class"), r6("share"), r6("logit", boost.init_logit(F.col("share"))))


def q_grad_hess(spark, sf):
    data = level_data(spark, sf)
    scored = linear.per_class(logreg.lr_ovr_scores(data.rows, _step_model(spark, sf), ("doc_id", "y")), ("doc_id", "y"), _step_model(spark, sf).classes, "p")
    g, h = boost.grad_hess(F.col("p"), (F.col("y") == F.col("class")).cast("double"))
    return scored.select("doc_id", "class", r6("g", g), r6("h", h))


def _root_candidates(spark, sf):
    data = level_data(spark, sf)
    stats = boost.value_stats(data.train)
    state = boost.with_logits(data.train, data.classes, TREE)
    hist = boost.node_histograms(state, data.classes, 0, {c: [0] for c in data.classes}, (), (), stats, TREE)
    totals = boost.root_totals(hist, data.classes)
    return boost.split_candidates(hist, totals, stats, TREE), totals


def q_split_gain(spark, sf):
    candidates, _ = _root_candidates(spark, sf)
    return candidates.select("class", "feature_id", "threshold", r6("gain"), "n_left")


def q_best_split(spark, sf):
    candidates, _ = _root_candidates(spark, sf)
    return boost.best_splits(candidates).select("class", "feature_id", "threshold", r6("gain"))


def q_leaf_value(spark, sf):
    """Leaf values that every root split would give."""
    candidates, totals = _root_candidates(spark, sf)
    roots = spark.createDataFrame([(c, t.g, t.h) for (c, _), t in totals.items()], "class int, g double, h double")
    known = candidates.join(F.broadcast(roots), "class")
    left = boost.leaf_value(F.col("g_left"), F.col("h_left"), TREE.reg_lambda)
    right = boost.leaf_value(F.col("g") - F.col("g_left"), F.col("h") - F.col("h_left"), TREE.reg_lambda)
    return known.select("class", "feature_id", "threshold", r6("left_value", left), r6("right_value", right))


def _tree_model(spark, sf) -> boost.BoostModel:
    data = level_data(spark, sf)
    return _once(spark, ("tree", sf), lambda: boost.build_trees(data.train, data.classes, TREE))


def q_build_tree(spark, sf):
    return _tree_model(spark, sf).tree_table(spark).select("class", "node_id", "feature_id", "threshold", r6("value"))


def q_apply_tree(spark, sf):
    model = _tree_model(spark, sf)
    applied = boost.apply_trees(level_data(spark, sf).rows, model.tree_table(spark))
    return applied.select("doc_id", "class", r6("value"))


def q_best_split_dense(spark, sf):
    """Root splits on the embedding table: dense features of any sign, all values distinct."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = vectors.select(
        F.col("label").alias("y"),
        F.sequence(F.lit(0), F.size("embedding") - 1).alias("ids"),
        F.col("embedding").cast("array<double>").alias("vals"),
    )
    classes = tuple(r["y"] for r in labels.distinct_classes(rows).collect())
    stats = boost.value_stats(rows)
    state = boost.with_logits(rows, classes, TREE)
    hist = boost.node_histograms(state, classes, 0, {c: [0] for c in classes}, (), (), stats, TREE)
    totals = boost.root_totals(hist, classes)
    best = boost.best_splits(boost.split_candidates(hist, totals, stats, TREE))
    return best.select("class", "feature_id", r6("threshold"), r6("gain"), "n_left")


def q_boost_fit(spark, sf):
    """One booster: the labelled documents of good quality against the rest."""
    data = level_data(spark, sf, "quality")
    return boost.boost_fit(data.train, BOOST).tree_table(spark).withColumn("value", F.round("value", 6))


def q_boost_ovr_fit(spark, sf):
    return runs.fit_boost(level_data(spark, sf), BOOST).tree_table(spark).withColumn("value", F.round("value", 6))


def q_boost_proba(spark, sf):
    scored = boost.boost_proba(level_data(spark, sf).rows, _tree_model(spark, sf), ("doc_id",))
    return _class_scores(scored, "p", _tree_model(spark, sf).classes).withColumn("p", F.round("p", 6))


def q_boost_predict(spark, sf):
    scored = boost.boost_proba(level_data(spark, sf).rows, _tree_model(spark, sf), ("doc_id",))
    return _class_scores(scored, "p", _tree_model(spark, sf).classes).select("doc_id", "class", boost.boost_predict(F.col("p")).alias("prediction"))


def q_boost_ovr_proba(spark, sf):
    scored = boost.boost_ovr_proba(level_data(spark, sf).rows, _tree_model(spark, sf), ("doc_id",))
    return _class_scores(scored, "p", _tree_model(spark, sf).classes).withColumn("p", F.round("p", 6))


def q_boost_ovr_predict(spark, sf):
    return boost.boost_ovr_predict(level_data(spark, sf).rows, _tree_model(spark, sf), ("doc_id",))


# -- evaluation -------------------------------------------------------------------------------------


def guess_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion of a fixed guess over five classes, of which only four occur as truth."""
    guess = ((F.col("doc_id") * 7 + F.col("n_chars")) % 5).cast("int")
    return evaluate.confusion(coded(spark, sf, "lang").withColumn("prediction", guess), ("split",))


def q_accuracy(spark, sf):
    return evaluate.accuracy(guess_cells(spark, sf), ("split",)).withColumn("accuracy", F.round("accuracy", 6))


def q_class_counts(spark, sf):
    return evaluate.class_counts(guess_cells(spark, sf), ("split",))


def q_per_class_prf(spark, sf):
    return evaluate.per_class_prf(evaluate.class_counts(guess_cells(spark, sf), ("split",)), ("split",))


def q_micro_avg(spark, sf):
    return evaluate.micro_avg(evaluate.class_counts(guess_cells(spark, sf), ("split",)), ("split",))


def q_macro_avg(spark, sf):
    per_class = evaluate.per_class_prf(evaluate.class_counts(guess_cells(spark, sf), ("split",)), ("split",))
    return evaluate.macro_avg(per_class, ("split",))


def q_metrics_matrix(spark, sf):
    return evaluate.metrics_matrix(guess_cells(spark, sf), ("split",))


def q_summary(spark, sf):
    return evaluate.summary(guess_cells(spark, sf), "guess").withColumn("accuracy", F.round("accuracy", 6))


# -- whole runs -------------------------------------------------------------------------------------

RUN_FEATURES = FeatureParams(TOP_WORDS, SKIP_TOP, SKIP_RARE)


def q_fit_predict_splits(spark, sf):
    """One full-batch step and the predictions of all splits."""
    fit = lambda d: logreg.lr_ovr_fit(d.train, d.n_train, d.n_features, d.classes, STEP).model
    _, predictions = runs.fit_predict_splits(level_data(spark, sf), fit, logreg.lr_ovr_predict)
    return predictions


def r6_accuracy(summary: DataFrame) -> DataFrame:
    return summary.withColumn("accuracy", F.round("accuracy", 6))


def q_svm_levels(spark, sf):
    return r6_accuracy(runs.svm_levels(levelled(spark, sf), RUN_LEVELS, features=RUN_FEATURES, params=SVM))


def q_lr_levels(spark, sf):
    return r6_accuracy(runs.lr_levels(levelled(spark, sf), RUN_LEVELS, RUN_FEATURES, LOGREG)[0])


def q_boost_levels(spark, sf):
    return r6_accuracy(runs.boost_levels(levelled(spark, sf), RUN_LEVELS, RUN_FEATURES, BOOST))


QUERIES = {name[2:]: query for name, query in list(globals().items()) if name.startswith("q_")}
