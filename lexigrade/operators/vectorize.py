"""Term counts, vocabulary, TF-IDF weights and packed document vectors.

The vocabulary is counted straight from the texts: only partial term totals are shuffled. A document is one row,
so its tokens are counted, weighted and packed inside that row, in Arrow batches, without an exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrade import session
from lexigrade.functions.text import word_tokens
from lexigrade.functions.tokens import count_pairs, count_terms, find_terms, lists_of, token_blocks
from lexigrade.session import write_stage
from lexigrade.sources.corpus import ranked

REPRESENTATIONS = ("bow", "tfidf")


def check_representation(representation: str) -> str:
    name = representation.lower()
    if name not in REPRESENTATIONS:
        raise ValueError(f"unknown representation {representation!r}: choose one of {REPRESENTATIONS}")
    return name


def tokenised(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``(doc_id, keep..., tokens)``"""
    return docs.select("doc_id", *keep, word_tokens(F.col("text")).alias("tokens"))


def with_lists(docs: DataFrame, keep: tuple[str, ...], **lists: T.DataType) -> T.StructType:
    """Schema of ``(doc_id, keep...)`` and list columns."""
    return T.StructType([*docs.select("doc_id", *keep).schema.fields, *[T.StructField(n, T.ArrayType(t)) for n, t in lists.items()]])


def term_counts(docs: DataFrame, keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """``(doc_id, keep..., term, tf)``. With ``outer`` a token-free document keeps one row with a null term."""
    counted = tokenised(docs, keep).mapInArrow(count_terms, with_lists(docs, keep, term=T.StringType(), tf=T.LongType()))
    inline = F.inline_outer if outer else F.inline
    return counted.select("doc_id", *keep, inline(F.arrays_zip("term", "tf")))


def doc_freq(counts: DataFrame) -> DataFrame:
    """``(term, df)``: counts hold one row per document and term."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_terms(docs: DataFrame) -> DataFrame:
    """``(term, tf, df)``: occurrences and documents of every term.

    Every token counts once for ``tf``; every distinct token of a text counts once for ``df``. Nothing is
    grouped by document, so the shuffle carries term totals of tasks, not documents.
    """
    tokens = docs.select(word_tokens(F.col("text")).alias("tokens"))

    def counted(terms: Column, tf: int, df: int) -> Column:
        return F.struct(terms.alias("terms"), F.lit(tf).alias("tf"), F.lit(df).alias("df"))

    kinds = F.array(counted(F.col("tokens"), 1, 0), counted(F.array_distinct("tokens"), 0, 1))
    terms = tokens.select(F.explode(kinds).alias("k")).select(F.explode("k.terms").alias("term"), "k.tf", "k.df")
    return terms.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def smooth_idf(df: Column, n_docs: int) -> Column:
    return F.ln((1.0 + F.lit(n_docs)) / (1.0 + df)) + 1.0


def fit_vocab(train: DataFrame, max_terms: int) -> DataFrame:
    """The ``max_terms`` most counted terms of the train split with alphabetical ids; the smaller of equally counted terms are taken.

    Up to ``BROADCAST_ROWS`` terms they meet in one task that ranks them; a larger vocabulary is cut and numbered in ranges.
    """
    if max_terms > session.BROADCAST_ROWS:
        return _fit_large_vocab(corpus_terms(train), max_terms)
    top = corpus_terms(train).orderBy(F.desc("tf"), "term").limit(max_terms)
    return top.withColumn("term_id", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def _fit_large_vocab(terms: DataFrame, max_terms: int) -> DataFrame:
    """The same rows without a task that holds them all: the count at the cut, the ties at it by rank, ids by rank.

    One row per distinct count is ordered in one place; n different counts need at least n squared over two tokens, so they are few.
    """
    terms = write_stage(terms, "terms")
    more = Window.orderBy(F.desc("tf")).rowsBetween(Window.unboundedPreceding, -1)
    counts = terms.groupBy("tf").agg(F.count(F.lit(1)).alias("n")).withColumn("above", F.coalesce(F.sum("n").over(more), F.lit(0)))
    cut = counts.where(F.col("above") < max_terms).orderBy("tf").first()
    if cut is None:
        return terms.withColumn("term_id", F.lit(0)).limit(0)
    ties = ranked(terms.where(F.col("tf") == cut["tf"]), ["term"], "_tie").where(F.col("_tie") < max_terms - cut["above"]).drop("_tie")
    kept = terms.where(F.col("tf") > cut["tf"]).unionByName(ties)
    return ranked(kept, ["term"], "term_id").withColumn("term_id", F.col("term_id").cast("int"))


def _norm(entries: Column) -> Column:
    return F.sqrt(F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + e["value"] * e["value"]))


def pack_vectors(
    docs: DataFrame,
    vocab: DataFrame,
    vocab_rows: int,
    representation: str,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, keep..., ids, vals)``: one row per document, ids ascending, empty arrays where no word is known.

    ``vocab`` holds ``term, term_id, idf`` and optionally ``kept``. The TF-IDF norm runs over the whole
    vocabulary; terms that are not kept are removed after it and the row is not normalised again.
    """
    tfidf = check_representation(representation) == "tfidf"
    side = vocab.select("term", "term_id", "idf", (F.col("kept") if "kept" in vocab.columns else F.lit(True)).alias("kept"))
    if vocab_rows > session.BROADCAST_ROWS:
        return _pack_by_join(docs, side, tfidf, keep)
    terms = side.orderBy("term_id").toArrow()
    column = lambda name: terms[name].to_numpy()
    words, ids, idf, kept = terms["term"].combine_chunks(), column("term_id"), column("idf"), column("kept")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for others, rows, tokens in token_blocks(batches):
            at = find_terms(tokens, words)
            rows, at, counts = count_pairs(rows[at >= 0], at[at >= 0], len(words))
            n_rows, values = len(others[0]), counts.astype(float)
            if tfidf:
                values *= idf[at]
                # Added in ascending order of the ids, so equal documents get equal bits.
                values /= np.sqrt(np.bincount(rows, values * values, n_rows))[rows]
            rows, at, values = (x[kept[at]] for x in (rows, at, values))
            lists = lists_of(rows, n_rows, pa.array(ids[at], pa.int32())), lists_of(rows, n_rows, pa.array(values, pa.float64()))
            yield pa.RecordBatch.from_arrays([*others, *lists], ["doc_id", *keep, "ids", "vals"])

    return tokenised(docs, keep).mapInArrow(pack, with_lists(docs, keep, ids=T.IntegerType(), vals=T.DoubleType()))


def _pack_by_join(docs: DataFrame, side: DataFrame, tfidf: bool, keep: tuple[str, ...]) -> DataFrame:
    """The same for a vocabulary too large for a task: counted terms are joined, then grouped by document."""
    weight = F.col("tf") * F.col("idf") if tfidf else F.col("tf").cast("double")
    known = term_counts(docs, keep, outer=True).join(side, "term", "left")
    entry = F.when(F.col("term_id").isNotNull(), F.struct("term_id", weight.alias("value"), "kept"))
    # Sorted entries fix the order of the sum, so equal documents get equal bits.
    packed = known.groupBy("doc_id", *keep).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    norm = _norm(F.col("entries")) if tfidf else F.lit(1.0)
    packed = packed.select("doc_id", *keep, F.filter("entries", lambda e: e["kept"]).alias("entries"), norm.alias("norm"))
    return packed.select(
        "doc_id",
        *keep,
        F.transform("entries", lambda e: e["term_id"]).alias("ids"),
        F.transform("entries", lambda e: e["value"] / F.col("norm")).alias("vals"),
    )


def unpack(vectors: DataFrame, id_name: str = "term_id", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Long form ``(keep..., id_name, value)`` of packed vectors; empty rows vanish."""
    return vectors.select(*keep, F.inline(F.arrays_zip("ids", "vals"))).withColumnsRenamed({"ids": id_name, "vals": "value"})


def term_weights(vectors: DataFrame) -> DataFrame:
    """``(term_id, weight)``: column sums of the train matrix."""
    return unpack(vectors).groupBy("term_id").agg(F.sum("value").alias("weight"))


def rank_terms(vocab: DataFrame, skip_top: int, vocab_size: int, fitted: int) -> DataFrame:
    """Add ``rank`` by descending ``weight`` and ``kept``: the heaviest ``skip_top`` are dropped, the next ``vocab_size`` stay.

    Weights are compared with nine digits, ties go to the smaller term. ``vocab`` is bounded by the
    vocabulary size, so one window partition is enough.
    """
    ranked = vocab.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("weight", 9)), "term")))
    cut = skip_top > 0 or vocab_size < fitted
    kept = (F.col("rank") > skip_top) & (F.col("rank") <= skip_top + vocab_size) if cut else F.lit(True)
    return ranked.withColumn("kept", kept)
