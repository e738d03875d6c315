import brute
import numpy as np
from pyspark.sql import functions as F

from lexigrade.functions.numeric import rounded4
from lexigrade.operators import evaluate

TRUE = [0, 0, 1, 1, 2, 2, 2]
GUESS = [0, 1, 1, 3, 2, 2, 0]


def frame(spark, true, guess, split="test"):
    return spark.createDataFrame([(split, int(t), int(g)) for t, g in zip(true, guess)], "split string, y int, prediction int")


def matrix(spark, true, guess):
    rows = evaluate.metrics_matrix(evaluate.confusion(frame(spark, true, guess))).collect()
    return {r["category"]: (r["precision"], r["recall"], r["f1"]) for r in rows}


def test_golden(spark):
    got = matrix(spark, TRUE, GUESS)
    assert got == {
        "Class 0": (0.5, 0.5, 0.5),
        "Class 1": (0.5, 0.5, 0.5),
        "Class 2": (1.0, 0.6667, 0.8),
        "Micro-Average": (0.6667, 0.5714, 0.6154),
        "Macro-Average": (0.6667, 0.5556, 0.6),
    }
    cells = evaluate.confusion(frame(spark, TRUE, GUESS), ("split",))
    row = evaluate.summary(cells, "m").first()
    assert np.isclose(row["accuracy"], 4 / 7) and row["micro_f1"] == 0.6154 and row["macro_recall"] == 0.5556
    counts = {r["class"]: (r["tp"], r["fp"], r["fn"]) for r in evaluate.class_counts(cells, ("split",)).collect()}
    assert counts == {0: (1, 1, 1), 1: (1, 1, 1), 2: (2, 0, 1)}


def test_random_reports(spark):
    rng = np.random.default_rng(1)
    for n, k in ((5, 2), (40, 4), (200, 9)):
        true, guess = rng.integers(0, k, n), rng.integers(0, k + 1, n)
        got, want = matrix(spark, true, guess), brute.metrics_matrix(true, guess)
        assert set(got) == set(want)
        for name in want:
            assert np.allclose(got[name], want[name], atol=1.01e-4 if name.startswith("Macro") else 0)


def test_binary_report(spark):
    rng = np.random.default_rng(2)
    true, guess = rng.integers(0, 2, 50), rng.integers(0, 2, 50)
    row = evaluate.binary_metrics(frame(spark, true, guess), ("split",)).first()
    want = brute.metrics_matrix(true, guess)
    for c in (0, 1):
        assert tuple(row[f"class{c}_{m}"] for m in evaluate.METRICS) == want[f"Class {c}"]
    assert tuple(row[f"micro_{m}"] for m in evaluate.METRICS) == want["Micro-Average"]
    assert np.isclose(row["accuracy"], np.mean(true == guess)) and row["n"] == 50


def test_one_class_never_guessed(spark):
    row = evaluate.binary_metrics(frame(spark, [1, 1, 0], [0, 0, 0])).first()
    assert (row["class1_precision"], row["class1_recall"], row["class1_f1"]) == (0, 0, 0)


def test_rounding_equals_numpy(spark):
    fractions = [(i / j,) for j in range(1, 120) for i in range(j + 1)]
    got = spark.createDataFrame(fractions, "x double").select("x", rounded4(F.col("x")).alias("r")).collect()
    assert all(r["r"] == float(np.round(r["x"], 4)) for r in got)
