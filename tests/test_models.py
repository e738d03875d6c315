import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigrade.functions import packed
from lexigrade.operators import boost, linear, logreg, svm


def matrix(seed, n, width, kind="counts"):
    rng = np.random.default_rng(seed)
    if kind == "counts":
        x = rng.poisson(0.6, (n, width)).astype(float)
    elif kind == "weights":
        x = np.round(rng.random((n, width)) * (rng.random((n, width)) < 0.4), 3)
    else:
        x = np.round(rng.normal(0, 1, (n, width)) * (rng.random((n, width)) < 0.6), 1)
    x[n // 2] = 0.0  # a token-free document
    return x


def frame(spark, x, y, parts=3):
    rows = [(i, int(y[i]), [int(f) for f in np.flatnonzero(x[i])], [float(v) for v in x[i][x[i] != 0]]) for i in range(len(x))]
    return spark.createDataFrame(rows, "pos long, y int, ids array<int>, vals array<double>").repartition(parts)


# -- SVM --------------------------------------------------------------------------------------------


def golden(spark):
    x = np.array([[0, 0], [0, 1], [1, 0], [2, 1], [1, 0], [0, 0]], dtype=float)
    return x, np.array([0, 0, 1, 1, 1, 0])


def test_svm_golden(spark):
    x, y = golden(spark)
    model = svm.svm_fit(frame(spark, x, y), 6, 2, svm.SvmParams(n_iters=2))
    assert np.allclose(model.weights[0], [0.07992005, 0.01998001], atol=1e-8)
    assert np.isclose(model.bias[0], -0.06)
    signs = svm.svm_margins(frame(spark, x, y), model, ("pos",)).select(linear.signs(F.col("scores"))).collect()
    assert {tuple(r[0]) for r in signs} == {(1.0,)}


@pytest.mark.parametrize("kind", ["counts", "weights", "signed"])
@pytest.mark.parametrize("block_rows", [1000, 7])
def test_svm_one_vs_rest_is_sequential(spark, kind, block_rows):
    """Classes above the block size go through the search for the next miss and give the same weights."""
    n, width, k, epochs = 60, 6, 3, 6
    x = matrix(3, n, width, kind)
    y = np.random.default_rng(4).choice(k, n, p=[0.6, 0.3, 0.1])
    params = svm.SvmParams(learning_rate=0.05, lambda_param=0.1, n_iters=epochs, block_rows=block_rows)
    model = svm.svm_ovr_fit(frame(spark, x, y), n, width, k, params)
    for c in range(k):
        w, b = brute.svm(x, (y == c).astype(int), 0.05, 0.1, epochs)
        assert np.allclose(model.weights[c], w, atol=1e-9), c
        assert np.isclose(model.bias[c], b, atol=1e-9)


def test_first_miss_agrees_with_stepping():
    rng = np.random.default_rng(0)
    n, decay = 11, 0.97
    last, size = n * 9, 2000
    margin, pos = np.round(rng.normal(0.4, 1, size), 2), rng.integers(0, n, size)
    step, b = rng.integers(0, 30, size), rng.choice([-1.2, -1.0, -0.7, 0.0], size)
    got = svm._first_miss(margin, pos, step, b, n, last, decay)
    for i in range(size):
        visits = [t for t in range(step[i], last) if t % n == pos[i] and decay ** (t - step[i]) * margin[i] < 1 + b[i]]
        assert got[i] == (visits[0] if visits else last)


def test_sign_ties_take_the_lowest_class(spark):
    x, y = golden(spark)
    model = linear.LinearModel((0, 1, 2), np.zeros((3, 2)), np.array([0.5, -1.0, -1.0]))
    rows = svm.svm_ovr_predict(frame(spark, x, y), model, ("pos",)).collect()
    assert {r["prediction"] for r in rows} == {1} and len(rows) == 6


# -- logistic regression ----------------------------------------------------------------------------


@pytest.mark.parametrize("dense_width", [20_000, 0])
def test_first_gradient_golden(spark, monkeypatch, dense_width):
    monkeypatch.setattr(packed, "DENSE_WIDTH", dense_width)
    x, y = golden(spark)
    zero = linear.LinearModel((1,), np.zeros((1, 2)), np.zeros(1))
    got = {r["feature_id"]: r["g"] / 6 for r in logreg.gradient(frame(spark, x, y), zero).collect()}
    assert np.allclose([got[0], got[1], got[-1]], [-1 / 3, 0, 0])


@pytest.mark.parametrize("size", [None, 16, 30])
def test_batches_in_row_order(spark, size):
    n, width = 50, 5
    x, y = matrix(5, n, width), np.random.default_rng(6).integers(0, 2, n)
    params = logreg.LogRegParams(lr=0.1, n_iter=7, alpha=0.5, batch_size=size)
    fit = logreg.lr_ovr_fit(frame(spark, x, y), n, width, (0, 1), params)
    for i in (0, 1):
        w, b, _ = brute.logreg_batches(x, (y == i).astype(int), 0.1, 0.5, 1e-6, 7, size or n)
        assert np.allclose(fit.model.weights[i], w, atol=1e-9) and np.isclose(fit.model.bias[i], b, atol=1e-9)


@pytest.mark.parametrize("cells", [4_000_000, 0])
@pytest.mark.parametrize("dense_width", [20_000, 0])
def test_full_batches_of_several_blocks(spark, monkeypatch, cells, dense_width):
    """Partial gradients added by the driver and by Spark; rows in blocks of four or more, some of them empty."""
    monkeypatch.setattr(logreg, "GRADIENT_CELLS", cells)
    monkeypatch.setattr(packed, "BLOCK_CELLS", 20)
    monkeypatch.setattr(packed, "DENSE_WIDTH", dense_width)
    n, width = 50, 5
    x, y = matrix(5, n, width), np.random.default_rng(6).integers(0, 3, n)
    x[::7] = 0
    params = logreg.LogRegParams(lr=0.1, n_iter=4, alpha=0.5, batch_size=None, mode="batch")
    fit = logreg.lr_ovr_fit(frame(spark, x, y).repartition(3), n, width, (0, 1, 2), params)
    for i in range(3):
        w, b, _ = brute.logreg_batches(x, (y == i).astype(int), 0.1, 0.5, 1e-6, 4, n)
        assert np.allclose(fit.model.weights[i], w, atol=1e-9) and np.isclose(fit.model.bias[i], b, atol=1e-9)


@pytest.mark.parametrize("cells", [4_000_000, 170, 20])
def test_blocks_of_batches_equal_single_batches(spark, monkeypatch, cells):
    """All rows in one block, a chain of blocks, and a job per batch: the same steps, stops and curve."""
    n, width = 50, 5
    x, y = matrix(5, n, width), np.random.default_rng(6).integers(0, 2, n)
    monkeypatch.setattr(logreg, "BLOCK_CELLS", cells)
    monkeypatch.setattr(logreg, "CURVE_EVERY", 3)
    params = logreg.LogRegParams(lr=0.1, n_iter=5, alpha=0.5, batch_size=16, tolerance=0.6)
    fit = logreg.lr_ovr_fit(frame(spark, x, y), n, width, (0, 1), params)
    for i in (0, 1):
        w, b, stopped = brute.logreg_batches(x, (y == i).astype(int), 0.1, 0.5, 0.6, 5, 16)
        assert np.allclose(fit.model.weights[i], w, atol=1e-9) and np.isclose(fit.model.bias[i], b, atol=1e-9)
        assert fit.iterations[i] == stopped
    assert {(s.target, s.iteration) for s in fit.snapshots} >= {(c, 3) for c in (0, 1) if fit.iterations[c] >= 3}


def test_a_block_reads_only_its_files(spark, tmp_path):
    rows = frame(spark, matrix(5, 400, 5), np.zeros(400)).repartitionByRange(8, "pos")
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    block = logreg.block_of(stored, 100, 150)
    assert "PushedFilters: [IsNotNull(pos), GreaterThanOrEqual(pos,100), LessThanOrEqual(pos,149)]" in block._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["pos"] for r in block.collect()) == list(range(100, 150))


@pytest.mark.parametrize("size", [None, 10])
def test_a_stopped_class_keeps_its_weights(spark, size):
    n, width = 40, 4
    x, y = matrix(7, n, width), np.random.default_rng(8).choice(3, n, p=[0.8, 0.1, 0.1])
    tolerance = 0.9 if size else 0.25
    params = logreg.LogRegParams(lr=0.2, n_iter=30, tolerance=tolerance, batch_size=size, mode="batch")
    fit = logreg.lr_ovr_fit(frame(spark, x, y), n, width, (0, 1, 2), params)
    stops = []
    for c in range(3):
        w, b, iteration = brute.logreg_batches(x, (y == c).astype(int), 0.2, 0.01, tolerance, 30, size or n)
        assert fit.iterations[c] == iteration
        assert np.allclose(fit.model.weights[c], w, atol=1e-9)
        stops.append(iteration)
    assert min(stops) < 30
    recorded = {(s.target, s.iteration) for s in fit.snapshots}
    assert recorded == {(c, i) for c, i in enumerate(stops) if i < 30 or i % 100 == 0}


@pytest.mark.parametrize("tolerance", [1e-6, 1.5])
def test_random_rows_replay_the_draws(spark, tolerance):
    n, width, k = 40, 5, 3
    x, y = matrix(9, n, width), np.random.default_rng(10).integers(0, k, n)
    params = logreg.LogRegParams(lr=0.05, n_iter=230, tolerance=tolerance, seed=11)
    rows = frame(spark, x, y)
    drawn = logreg.draw_rows(rows, n, (0, 1, 2), params).orderBy("class", "step").collect()
    assert len(drawn) == 230 * k and {r["pos"] for r in drawn} == set(range(n))
    fit = logreg.lr_ovr_fit(rows, n, width, (0, 1, 2), params)
    for c in range(k):
        draws = [r["pos"] for r in drawn if r["class"] == c]
        w, b, steps = brute.logreg_draws(x, (y == c).astype(int), draws, 0.05, 0.01, tolerance)
        assert np.allclose(fit.model.weights[c], w, atol=1e-9) and np.isclose(fit.model.bias[c], b)
        assert fit.iterations[c] == steps
    if tolerance == 1e-6:
        assert {(s.target, s.iteration) for s in fit.snapshots} == {(c, i) for c in range(k) for i in (100, 200)}


def test_one_half_is_class_zero(spark):
    p = spark.createDataFrame([(0.5,), (0.5000001,)], "p double")
    assert [r[0] for r in p.select(logreg.lr_predict(F.col("p"))).collect()] == [0, 1]
    assert [r[0] for r in p.select(boost.boost_predict(F.col("p"))).collect()] == [1, 1]


@pytest.mark.parametrize("dense_width", [20_000, 0])
def test_scores_by_matrix_and_by_join_agree(spark, monkeypatch, dense_width):
    monkeypatch.setattr(packed, "DENSE_WIDTH", dense_width)
    n, width, k = 30, 6, 4
    x = matrix(12, n, width)
    rng = np.random.default_rng(13)
    model = linear.LinearModel(tuple(range(k)), rng.normal(size=(k, width)), rng.normal(size=k))
    rows = frame(spark, x, np.zeros(n)).withColumnRenamed("pos", "doc_id")
    by_matrix = {(r["doc_id"], r["class"]): r["score"] for r in linear.per_class(linear.linear_scores(rows, model, -1, ("doc_id",)), ("doc_id",), model.classes).collect()}
    joined = linear.linear_scores_long(rows, model.weight_table(spark), model.bias_table(spark), k * width, k, -1).collect()
    assert len(joined) == n * k == len(by_matrix)
    for r in joined:
        expect = x[r["doc_id"]] @ model.weights[r["class"]] - model.bias[r["class"]]
        assert np.isclose(r["score"], expect) and np.isclose(by_matrix[(r["doc_id"], r["class"])], expect)
    back = linear.LinearModel.from_tables(model.weight_table(spark), model.bias_table(spark), width)
    assert np.array_equal(back.weights, model.weights) and back.classes == model.classes


def test_normalised_rows_sum_to_one(spark):
    n, width = 20, 4
    x = matrix(14, n, width)
    model = linear.LinearModel((0, 1, 2), np.random.default_rng(15).normal(size=(3, width)), np.zeros(3))
    rows = logreg.lr_ovr_proba(frame(spark, x, np.zeros(n)), model, ("pos",)).collect()
    assert len(rows) == n and all(np.isclose(sum(r["scores"]), 1) for r in rows)


# -- boosted trees ----------------------------------------------------------------------------------


def as_dict(model, target, round_id):
    return {
        n.node_id: ("leaf", n.value) if n.feature_id is None else ("split", n.feature_id, n.threshold)
        for n in model.nodes
        if n.target == target and n.round == round_id
    }


def same_tree(got, want):
    assert set(got) == set(want)
    for node, (kind, *rest) in want.items():
        assert got[node][0] == kind
        assert np.allclose(got[node][1:], rest, atol=1e-8)


def test_root_split_golden(spark):
    x, y = golden(spark)
    params = boost.BoostParams(max_depth=1, gamma=0.1, n_estimators=1)
    model = boost.boost_fit(frame(spark, x, y), params)
    same_tree(as_dict(model, 1, 0), {0: ("split", 0, 1.0), 1: ("leaf", -0.857142857), 2: ("leaf", 0.857142857)})
    stats = boost.value_stats(frame(spark, x, y))
    state = boost.with_logits(frame(spark, x, y), (1,), params)
    hist = boost.node_histograms(state, (1,), 0, {1: [0]}, (), (), stats, params)
    found = boost.split_candidates(hist, boost.root_totals(hist, (1,)), stats, params).collect()
    gains = {(r["feature_id"], r["threshold"]): r["gain"] for r in found}
    assert np.allclose([gains[(0, 1.0)], gains[(0, 2.0)], gains[(1, 1.0)]], [1.185714, 0.055556, -0.1], atol=1e-6) and len(gains) == 3


@pytest.mark.parametrize("kind", ["counts", "weights", "signed"])
@pytest.mark.parametrize("spread", [False, True])
def test_trees_match_exhaustive_search(spark, monkeypatch, kind, spread):
    """Both plans of the split search, values of any sign, several rounds with written margins in between."""
    n, width, k = 70, 5, 3
    x = matrix(16, n, width, kind)
    y = np.random.default_rng(17).integers(0, k, n)
    if spread:
        monkeypatch.setattr(boost, "WINDOW_VALUES", 0)
        monkeypatch.setattr(boost, "VALUE_RANGES", 5)
    params = boost.BoostParams(n_estimators=3, max_depth=2, learning_rate=0.3, min_samples_split=6, gamma=0.01, write_every=2)
    model = boost.boost_ovr_fit(frame(spark, x, y), tuple(range(k)), params)
    logits = []
    for c in range(k):
        trees, logit = brute.boost(x, (y == c).astype(int), params)
        logits.append(logit)
        for round_id, nodes in enumerate(trees):
            same_tree(as_dict(model, c, round_id), nodes)
    scored = {r["pos"]: r["scores"] for r in boost.boost_logits(frame(spark, x, y), model, ("pos",)).collect()}
    assert np.allclose([scored[i] for i in range(n)], np.array(logits).T, atol=1e-8)


def test_groups_of_ranges_do_not_grow_with_the_values(spark, monkeypatch):
    """More distinct values make more groups of ranges, not larger ones; the groups of a feature with few values stay as they are."""
    monkeypatch.setattr(boost, "BUCKET_VALUES", 500, raising=False)
    rows = spark.range(5000).select(
        (F.col("id") % 2).alias("y"), F.sequence(F.lit(0), F.lit(3)).alias("ids"), F.array(*[F.col("id") * (k + 1) - 2500.0 for k in range(4)]).alias("vals")
    )
    params = boost.BoostParams(n_estimators=1)
    hist = boost.node_histograms(boost.with_logits(rows, (0, 1), params), (0, 1), 0, {0: [0], 1: [0]}, (), (), boost.value_stats(rows), params)
    sizes = [r["n"] for r in hist.groupBy("bucket").agg(F.sum(F.size("vals")).alias("n")).collect()]
    # The three zeros have no cells, the sums of all rows have one.
    assert sum(sizes) == 4 * 5000 - 3 + 1
    assert max(sizes) <= 2 * 500


def test_products_on_cells_equal_dense_products(monkeypatch):
    rng = np.random.default_rng(22)
    x = matrix(23, 12, 7)
    ids, vals = [np.flatnonzero(r) for r in x], [r[r != 0] for r in x]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(vals, pa.list_(pa.float64()))], names=["ids", "vals"])
    weights, factors = rng.normal(size=(7, 3)), rng.normal(size=(12, 3))
    for width in (20_000, 0):
        monkeypatch.setattr(packed, "DENSE_WIDTH", width)
        monkeypatch.setattr(packed, "BLOCK_CELLS", 35)
        blocks = list(packed.row_blocks([batch], 7))
        assert len(blocks) == (3 if width else 1)
        assert np.allclose(np.vstack([b.dot(weights) for b in blocks]), x @ weights)
        starts = np.cumsum([0] + [b.n for b in blocks])
        parts = [b.weighted_sums(factors[i : i + b.n]) for i, b in zip(starts, blocks)]
        assert np.allclose(sum(parts), factors.T @ x)


def test_products_hold_no_more_for_a_larger_batch():
    weights = np.ones((500, 4))

    def peak(n_rows: int) -> int:
        ids, vals = pa.array([[r % 500] for r in range(n_rows)], pa.list_(pa.int32())), pa.array([[1.0]] * n_rows)
        batch = pa.RecordBatch.from_arrays([ids, vals], names=["ids", "vals"])
        tracemalloc.start()
        for block in packed.row_blocks([batch], 500):
            block.weighted_sums(block.dot(weights))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(8000) < 1.2 * peak(2000)


def test_partial_sums_combine_within_a_task(monkeypatch):
    rng = np.random.default_rng(21)
    keys, g = rng.integers(0, 40, 900), rng.integers(0, 9, 900).astype(float)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 50]), pa.array(g[i : i + 50])], names=["k", "g"]) for i in range(0, 900, 50)]
    for held, rows in ((10_000, 40), (100, 40), (60, None)):
        monkeypatch.setattr(packed, "HELD_ROWS", held)
        out = pa.Table.from_batches(packed.combine_sums(batches, ["k"], ["g"])).to_pandas()
        assert rows is None or len(out) == rows
        assert out.groupby("k")["g"].sum().to_dict() == {k: g[keys == k].sum() for k in range(40)}
    empty = list(packed.combine_sums([], ["k"], ["g"]))
    assert empty == []


def test_no_trees_give_the_base_score(spark):
    x, y = golden(spark)
    model = boost.boost_ovr_fit(frame(spark, x, y), (0, 1), boost.BoostParams(n_estimators=0, base_score=0.3))
    assert {tuple(r["scores"]) for r in boost.boost_proba(frame(spark, x, y), model, ("pos",)).collect()} == {(0.3, 0.3)}


def test_tree_table_round_trip_and_leaf_values(spark):
    n, width = 40, 4
    x, y = matrix(18, n, width), np.random.default_rng(19).integers(0, 2, n)
    params = boost.BoostParams(n_estimators=2, max_depth=3)
    model = boost.boost_fit(frame(spark, x, y), params)
    table = model.tree_table(spark)
    back = boost.BoostModel.from_table(table, (1,), params)
    assert set(back.nodes) == set(model.nodes)
    rows = frame(spark, x, y).withColumnRenamed("pos", "doc_id")
    got = {(r["doc_id"], r["round"]): r["value"] for r in boost.apply_trees(rows, table).collect()}
    for round_id in (0, 1):
        nodes = as_dict(model, 1, round_id)
        for i in range(n):
            assert np.isclose(got[(i, round_id)], brute.tree_value(nodes, x[i]))


def test_training_loss_falls(spark):
    n, width = 60, 5
    x = matrix(20, n, width)
    y = (x[:, 0] + x[:, 1] > 1).astype(int)
    losses = []
    for rounds in (1, 2, 4):
        model = boost.boost_fit(frame(spark, x, y), boost.BoostParams(n_estimators=rounds, learning_rate=0.3))
        p = {r["pos"]: r["scores"][0] for r in boost.boost_proba(frame(spark, x, y), model, ("pos",)).collect()}
        losses.append(-np.mean([np.log(p[i] if y[i] else 1 - p[i]) for i in range(n)]))
    assert losses == sorted(losses, reverse=True)


def test_only_the_smaller_child_is_built(spark, monkeypatch):
    """Siblings come from their parents: of two children, the rows of the smaller one are added up and no others."""
    n, width = 90, 4
    x, y = matrix(24, n, width), np.random.default_rng(25).integers(0, 3, n)
    rows, params = frame(spark, x, y), boost.BoostParams(n_estimators=1, max_depth=3, min_samples_split=4)
    passes, sizes = [], []
    kept = boost._partial_histograms

    def watched(rows, classes, depth, slots, *rest):
        parts = kept(rows, classes, depth, slots, *rest)
        total = np.zeros(len(slots))
        for r in parts.where("feature_id = -1").collect():
            total += np.array(r["n"])
        passes.append(depth)
        sizes.append(dict(zip(slots, total)))
        return parts

    monkeypatch.setattr(boost, "_partial_histograms", watched)
    model = boost.boost_ovr_fit(rows, (0, 1, 2), params)
    assert passes == [0, 1, 2]
    assert all(v == n for v in sizes[0].values())
    for above, depth in ((sizes[0], 1), (sizes[1], 2)):
        for (c, node), count in sizes[depth].items():
            sibling = node + 1 if node % 2 else node - 1
            assert (c, sibling) not in sizes[depth]
            if (c, (node - 1) // 2) in above:
                assert count <= above[c, (node - 1) // 2] / 2
    for c in range(3):
        trees, _ = brute.boost(x, (y == c).astype(int), params)
        same_tree(as_dict(model, c, 0), trees[0])
