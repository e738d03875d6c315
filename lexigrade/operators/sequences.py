"""Token-id sequences of one length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrade import session
from lexigrade.functions.tokens import find_terms, lists_of, token_blocks
from lexigrade.operators.vectorize import tokenised, with_lists


def encode_sequences(docs: DataFrame, vocab: DataFrame, vocab_rows: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, keep..., seq)``: vocabulary ids in text order, shifted by one so that 0 stays the padding.

    Words outside the vocabulary are dropped; a document without known words keeps an empty sequence.
    """
    if vocab_rows <= session.BROADCAST_ROWS:
        table = vocab.select("term", "term_id").toArrow()
        terms, ids = table["term"].combine_chunks(), table["term_id"].to_numpy().astype(int) + 1

        def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for others, rows, tokens in token_blocks(batches):
                at = find_terms(tokens, terms)
                seq = lists_of(rows[at >= 0], len(others[0]), pa.array(ids[at[at >= 0]], pa.int64()))
                yield pa.RecordBatch.from_arrays([*others, seq], ["doc_id", *keep, "seq"])

        return tokenised(docs, keep).mapInArrow(encode, with_lists(docs, keep, seq=T.LongType()))
    words = tokenised(docs, keep).select("doc_id", *keep, F.posexplode_outer("tokens").alias("at", "term"))
    known = words.join(vocab.select("term", "term_id"), "term", "left")
    item = F.when(F.col("term_id").isNotNull(), F.struct("at", (F.col("term_id") + 1).alias("id")))
    seq = F.transform(F.sort_array(F.collect_list(item)), lambda e: e["id"].cast("long"))
    return known.groupBy("doc_id", *keep).agg(seq.alias("seq"))


def pad_length(sequences: DataFrame, padding_length: str = "average") -> int:
    """Truncated mean length for ``average``, the longest sequence for any other word."""
    size = F.size("seq")
    length = F.floor(F.avg(size)) if padding_length == "average" else F.max(size)
    return int(sequences.agg(length.alias("length")).first()["length"] or 0)


def pad_truncate(seq: Column, length: int) -> Column:
    """Cut to ``length`` or fill up with zeros on the right."""
    padding = F.array_repeat(F.lit(0).cast("long"), length)
    return F.slice(F.concat(seq, padding), 1, length)


def padded_dataset(sequences: DataFrame, padding_length: str = "average") -> tuple[DataFrame, int]:
    """``(doc_id, x, y)`` with equally long ``x``, and that length."""
    length = pad_length(sequences, padding_length)
    return sequences.select("doc_id", pad_truncate(F.col("seq"), length).alias("x"), F.col("y").cast("long").alias("y")), length
