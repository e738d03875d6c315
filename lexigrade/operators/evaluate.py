"""Classification reports as aggregates.

Predictions are counted once into a confusion table ``(by..., y, prediction, n)``; every report reads that
table, whose size is classes x classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrade.functions.numeric import REPORT_SCALE, f1, ratio, rounded4

METRICS = ("precision", "recall", "f1")


def confusion(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return predictions.groupBy(*by, "y", "prediction").agg(F.count(F.lit(1)).alias("n"))


def accuracy(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    right = F.sum(F.when(F.col("y") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.groupBy(*by).agg((right / F.sum("n")).alias("accuracy"))


def class_counts(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(by..., class, tp, fp, fn)`` for the classes that occur as truth."""
    zero = F.lit(0).cast("long")
    same = F.col("y") == F.col("prediction")
    as_truth = F.struct(
        F.col("y").alias("class"),
        F.when(same, F.col("n")).otherwise(zero).alias("tp"),
        zero.alias("fp"),
        F.when(same, zero).otherwise(F.col("n")).alias("fn"),
        F.lit(1).alias("truth"),
    )
    as_guess = F.struct(
        F.col("prediction").alias("class"),
        zero.alias("tp"),
        F.when(same, zero).otherwise(F.col("n")).alias("fp"),
        zero.alias("fn"),
        F.lit(0).alias("truth"),
    )
    sides = cells.select(*by, F.inline(F.array(as_truth, as_guess)))
    sums = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], F.max("truth").alias("truth"))
    return sums.where("truth = 1").drop("truth")


def _prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [c.alias(name) for c, name in zip((precision, recall, f1(precision, recall)), METRICS)]


def _rounded(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return df.select(*keep, *[rounded4(F.col(m)).alias(m) for m in METRICS])


def per_class_prf(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    keep = (*by, "class")
    return _rounded(counts.select(*keep, *_prf(F.col("tp"), F.col("fp"), F.col("fn"))), keep)


def micro_avg(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """From the summed counts: a prediction of a class that never occurs as truth is nobody's false positive."""
    sums = counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return _rounded(sums.select(*by, *_prf(F.col("tp"), F.col("fp"), F.col("fn"))), by)


def macro_avg(per_class: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean of the rounded class values, rounded again.

    The four-digit values are added as whole numbers: the sum is exact in any order, so a tie is a tie.
    """
    means = [F.rint(F.sum(F.rint(F.col(m) * REPORT_SCALE)) / F.count(F.lit(1))) / REPORT_SCALE for m in METRICS]
    return per_class.groupBy(*by).agg(*[mean.alias(m) for mean, m in zip(means, METRICS)])


def metrics_matrix(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(by..., category, precision, recall, f1)``: one row per class, then the micro and macro rows."""
    counts = class_counts(cells, by)
    classes = per_class_prf(counts, by)
    named = classes.select(*by, F.concat(F.lit("Class "), F.col("class").cast("string")).alias("category"), *METRICS)
    micro = micro_avg(counts, by).select(*by, F.lit("Micro-Average").alias("category"), *METRICS)
    macro = macro_avg(classes, by).select(*by, F.lit("Macro-Average").alias("category"), *METRICS)
    return named.unionByName(micro).unionByName(macro)


def summary(cells: DataFrame, model: str, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """One row per split: accuracy with the micro and macro averages."""
    counts = class_counts(cells, by)
    micro = micro_avg(counts, by).withColumnsRenamed({m: f"micro_{m}" for m in METRICS})
    macro = macro_avg(per_class_prf(counts, by), by).withColumnsRenamed({m: f"macro_{m}" for m in METRICS})
    joined = accuracy(cells, by).join(micro, list(by)).join(macro, list(by))
    return joined.select(F.lit(model).alias("model"), *by, "accuracy", *[f"{a}_{m}" for a in ("micro", "macro") for m in METRICS])


def binary_counts(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(by..., tp, fp, fn, tn)`` of class 1 for targets 0 and 1."""

    def cell(name: str, prediction: int, truth: int) -> Column:
        hit = (F.col("prediction") == prediction) & (F.col("y") == truth)
        return F.sum(F.when(hit, 1).otherwise(0)).alias(name)

    return predictions.groupBy(*by).agg(cell("tp", 1, 1), cell("fp", 1, 0), cell("fn", 0, 1), cell("tn", 0, 0))


def binary_scores() -> list[Column]:
    """Report columns over ``tp, fp, fn, tn``; the averages come from the unrounded class values."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    one, zero = _prf(tp, fp, fn), _prf(tn, fn, fp)
    right, wrong = tp + tn, fp + fn
    micro = _prf(right, wrong, wrong)
    columns = [(right + wrong).alias("n"), ratio(right, right + wrong).alias("accuracy")]
    for name, values in (("class0", zero), ("class1", one), ("micro", micro)):
        columns += [rounded4(v).alias(f"{name}_{m}") for v, m in zip(values, METRICS)]
    columns += [rounded4((a + b) / 2).alias(f"macro_{m}") for a, b, m in zip(one, zero, METRICS)]
    return columns


def binary_metrics(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return binary_counts(predictions, by).select(*by, *binary_scores())
