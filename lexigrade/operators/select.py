"""Feature selection by mutual information on packed vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrade.functions.lookup import constant_array
from lexigrade.functions.numeric import category, x_log_x
from lexigrade.operators.vectorize import unpack
from lexigrade.session import lookup_side

# Largest vocabulary whose id map travels inside the plan.
LOOKUP_IDS = 200_000


def class_totals(labels: DataFrame) -> DataFrame:
    """``(y, n_class)`` from the label rows, so token-free documents count."""
    return labels.groupBy("y").agg(F.count(F.lit(1)).alias("n_class"))


def contingency(train: DataFrame) -> DataFrame:
    """``(term_id, value, y, n)`` of the non-zero cells. The counts are combined before the shuffle."""
    cells = unpack(train, keep=("y",)).withColumn("value", category(F.col("value")))
    return cells.groupBy("term_id", "value", "y").agg(F.count(F.lit(1)).alias("n"))


def with_zero_cells(cells: DataFrame, totals: dict[int, int]) -> DataFrame:
    """Add the zero category of every term and class: class total minus the non-zero cells."""
    per_class = cells.groupBy("term_id", "y").agg(F.sum("n").alias("n"))
    spread = per_class.groupBy("term_id").agg(F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("seen"))
    listed = F.array(*[F.struct(F.lit(y).cast("int").alias("y"), F.lit(n).cast("long").alias("total")) for y, n in totals.items()])
    zeros = spread.select("term_id", "seen", F.inline(listed)).select(
        "term_id",
        F.lit(0.0).alias("value"),
        "y",
        (F.col("total") - F.coalesce(F.element_at("seen", F.col("y")), F.lit(0))).alias("n"),
    )
    return cells.unionByName(zeros.where("n > 0"))


def mutual_information(cells: DataFrame, totals: DataFrame, n_classes: int, n_docs: int) -> DataFrame:
    """``(term_id, mi)`` in nats, every distinct value a category, from the non-zero cells alone.

    With ``S(x) = x ln x`` the information of a term is the sum of ``S`` over its cells, minus ``S`` over its
    values, minus ``S`` over the classes, plus ``S(n)``, all over ``n``. The zero category follows from
    the class totals, and classes in which a term never occurs cancel, so no term x class table is built.
    """
    n = F.lit(float(n_docs))
    by_value = (
        cells.groupBy("term_id", "value")
        .agg(F.sum("n").alias("n_value"), F.sum(x_log_x(F.col("n").cast("double"))).alias("s"))
        .groupBy("term_id")
        .agg(F.sum("n_value").alias("nonzero"), F.sum(F.col("s") - x_log_x(F.col("n_value").cast("double"))).alias("s_values"))
    )
    left = F.col("n_class").cast("double") - F.col("n")
    by_class = (
        cells.groupBy("term_id", "y")
        .agg(F.sum("n").alias("n"))
        .join(lookup_side(totals, n_classes), "y")
        .groupBy("term_id")
        .agg(F.sum(x_log_x(left) - x_log_x(F.col("n_class").cast("double"))).alias("s_zero"))
    )
    zero = n - F.col("nonzero")
    mi = (F.col("s_values") + F.col("s_zero") - x_log_x(zero) + x_log_x(n)) / n
    return by_value.join(by_class, "term_id").select("term_id", F.greatest(mi, F.lit(0.0)).alias("mi"))


def top_k_features(scores: DataFrame, k: int) -> DataFrame:
    """``(term_id, mi, feature_id)`` of the ``k`` best terms, best first; ties go to the smaller id."""
    if k < 1:
        raise ValueError("the number of features must be at least 1")
    order = (F.desc(F.round("mi", 9)), "term_id")
    top = scores.orderBy(*order).limit(k)
    return top.withColumn("feature_id", (F.row_number().over(Window.orderBy(*order)) - 1).cast("int"))


def project(vectors: DataFrame, features: DataFrame, vocab_rows: int, k: int, keep: tuple[str, ...]) -> DataFrame:
    """Vectors over the selected features only, with feature ids in place of term ids.

    The map from term to feature is an array constant while the vocabulary is small, and then no row moves;
    beyond that it is a join followed by packing again.
    """
    if vocab_rows <= LOOKUP_IDS:
        slots = [-1] * max(1, vocab_rows)
        for row in features.select("term_id", "feature_id").collect():
            slots[row["term_id"]] = row["feature_id"]
        to_feature = constant_array(slots, "int")
        pairs = F.zip_with("ids", "vals", lambda i, v: F.struct(F.get(to_feature, i).alias("id"), v.alias("value")))
        packed = vectors.select(*keep, F.sort_array(F.filter(pairs, lambda e: e["id"] >= 0)).alias("entries"))
    else:
        long = vectors.select(*keep, F.inline_outer(F.arrays_zip("ids", "vals"))).withColumnRenamed("ids", "term_id")
        long = long.join(lookup_side(features.select("term_id", "feature_id"), k), "term_id", "left")
        entry = F.when(F.col("feature_id").isNotNull(), F.struct(F.col("feature_id").alias("id"), F.col("vals").alias("value")))
        packed = long.groupBy(*keep).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return packed.select(
        *keep,
        F.transform("entries", lambda e: e["id"]).alias("ids"),
        F.transform("entries", lambda e: e["value"]).alias("vals"),
    )
