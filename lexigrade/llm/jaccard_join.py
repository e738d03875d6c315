"""Near-duplicate texts: a forest of MinHash prefix tries, then exact Jaccard similarity of word shingles.

Every text gets ``trees * depth`` MinHash values. Tree t is the sorted trie over the t-th ``depth`` values; texts
with an equal prefix share a bucket. The prefix is shortened until, first by the collision probability at the
threshold and then by the links found, the expected share of found links reaches ``recall``.

Equal word sequences are one text, so copies are never paired. Buckets of equal members are taken once. A bucket
is split into blocks of bounded size, and a task verifies one pair of blocks: no pair of texts is a row, every
pair that shares a bucket is verified, and each link is counted in one bucket only.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.llm.words import SPACE, Hasher, Rows, shingles
from lexigrade.session import write_stage

BLOCK_TEXTS = 512
BLOCK_SHINGLES = 1 << 21
COLUMNS = 4096


class JoinParams(NamedTuple):
    threshold: float = 0.8
    words: int = 5
    trees: int = 20
    depth: int = 6
    recall: float = 0.999
    seed: int = 17


def collision(similarity, prefix: int, trees: int):
    """Probability that two texts share a bucket in at least one tree."""
    return 1 - (1 - np.asarray(similarity, float) ** prefix) ** trees


def prefix_lengths(params: JoinParams) -> list[int]:
    """Prefix lengths to try, longest first; the first one reaches the recall at the threshold itself."""
    fit = [r for r in range(params.depth, 0, -1) if collision(params.threshold, r, params.trees) >= params.recall]
    return fit or [1]


def text_key(words: np.ndarray) -> bytes:
    return hashlib.md5(words.tobytes()).digest()


def sketcher(params: JoinParams):
    """Column function: text -> (key of its word sequence, number of shingles, MinHash values); null without words."""
    kind = "struct<key:binary,size:int,sketch:array<int>>"
    factors = np.random.default_rng(params.seed).integers(1, 1 << 63, params.trees * params.depth, np.uint64) | np.uint64(1)

    @F.arrow_udf(kind)
    def sketch(texts: pa.Array) -> pa.Array:
        hasher, keys, sizes, sketches = Hasher(SPACE), [], [], []
        for _, _, words in hasher.chunks(texts):
            keys += [text_key(words.hashes[a:b]) if b > a else None for a, b in zip(words.bounds[:-1], words.bounds[1:])]
            found = shingles(words, params.words)
            counts = np.diff(found.bounds)
            some = counts > 0
            out = np.zeros((len(counts), len(factors)), np.int32)
            if some.any():
                starts = found.bounds[:-1][some]
                for k, factor in enumerate(factors):
                    low = np.minimum.reduceat(found.hashes * factor, starts)
                    out[some, k] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
            sizes.append(counts)
            sketches.append(out)
        flat = np.concatenate(sketches) if sketches else np.zeros((0, len(factors)), np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * len(factors), pa.int32()), pa.array(flat.ravel()))
        count = pa.array(np.concatenate(sizes) if sizes else [], pa.int32())
        keyed = pa.array(keys, pa.binary())
        return pa.StructArray.from_arrays([keyed, count, lists], ["key", "size", "sketch"], mask=keyed.is_null())

    return sketch


def keyer():
    """Column function: text -> key of its word sequence."""

    @F.arrow_udf("binary")
    def key(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, words in Hasher(SPACE).chunks(texts):
            out += [text_key(words.hashes[a:b]) if b > a else None for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        return pa.array(out, pa.binary())

    return key


def shingler(params: JoinParams):
    """Column function: text -> its distinct shingles in ascending order."""

    @F.arrow_udf("array<bigint>")
    def sets(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, words in Hasher(SPACE).chunks(texts):
            found = shingles(words, params.words)
            out += [np.unique(found.hashes[a:b].view(np.int64)) for a, b in zip(found.bounds[:-1], found.bounds[1:])]
        return pa.array(out, pa.list_(pa.int64()))

    return sets


def intersections(flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of all pairwise intersections of ``n`` sets, a bounded number of distinct values at a time."""
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    ids = np.cumsum(new) - 1
    shared = np.bincount(ids) > 1
    keep = shared[ids]
    columns, owner = (np.cumsum(shared) - 1)[ids[keep]], owner[keep]
    total = np.zeros((n, n), np.float64)
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(columns, [low, low + COLUMNS])
        cells = np.zeros((n, COLUMNS), np.float32)
        cells[owner[a:b], columns[a:b] - low] = 1
        total += cells @ cells.T
    return total


def block_verifier(params: JoinParams, prefix: int):
    """Task over one pair of blocks of a bucket: per linked text its local root, its links and their expected share."""

    def verify(table: pa.Table) -> pa.Table:
        n, bucket = table.num_rows, table["bucket"][0].as_py()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        sets = table["shingles"].combine_chunks()
        lengths = np.diff(sets.offsets.to_numpy())
        similar = intersections(sets.flatten().to_numpy(), np.repeat(np.arange(n), lengths), n)
        union = lengths[:, None] + lengths[None, :] - similar
        block = table["block"].to_numpy()
        pairs = np.triu(np.ones((n, n), bool), 1) if low == high else (block == low)[:, None] & (block == high)[None, :]
        left, right = np.nonzero(pairs & (similar >= params.threshold * union - 1e-9))
        root = list(range(n))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        buckets = [set(x) for x in table["buckets"].to_pylist()]
        links, expected = np.zeros(n, np.int64), np.zeros(n)
        for i, j in zip(left.tolist(), right.tolist()):
            root[find(i)] = find(j)
            if min(buckets[i] & buckets[j]) == bucket:
                weight = 1 / collision(similar[i, j] / union[i, j], prefix, params.trees)
                for x in (i, j):
                    links[x] += 1
                    expected[x] += weight
        touched = np.unique(np.concatenate([left, right])).astype(int)
        keys = table["key"].to_pylist()
        return pa.table({
            "key": pa.array([keys[i] for i in touched], pa.binary()), "root": pa.array([keys[find(i)] for i in touched], pa.binary()),
            "links": pa.array(links[touched], pa.int64()), "expected": pa.array(expected[touched], pa.float64()),
        })

    return verify


def _verify_buckets(docs: DataFrame, texts: DataFrame, params: JoinParams, prefix: int) -> DataFrame:
    """Links inside all buckets of one prefix length: rows (key, root, links, expected)."""
    d = params.depth
    parts = F.transform(F.sequence(F.lit(0), F.lit(params.trees - 1)), lambda t: F.xxhash64(t, F.slice("sketch", t * d + 1, F.lit(prefix))))
    leaves = texts.select("key", "size", F.explode(parts).alias("bucket"))
    buckets = leaves.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("total"),
        F.bit_xor(F.xxhash64("key")).alias("mark_1"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("mark_2"),
    ).filter("n > 1")
    # Buckets of other trees with the same members hold the same pairs.
    taken = buckets.groupBy("n", "total", "mark_1", "mark_2").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "total")
    members = write_stage(leaves.join(taken, "bucket").select("bucket", "key", "n", "total"), "near-members")
    of_text = members.groupBy("key").agg(F.collect_set("bucket").alias("buckets"))
    wanted = of_text.join(texts.select("key", "first_id"), "key").withColumnRenamed("key", "wanted")
    named = docs.select(F.col("doc_id").alias("first_id_"), F.col("text").alias("text_"))
    owned = named.join(wanted, F.col("first_id_").eqNullSafe(F.col("first_id"))).filter(keyer()("text_") == F.col("wanted"))
    sets = owned.select(F.col("wanted").alias("key"), "buckets", shingler(params)("text_").alias("shingles")).dropDuplicates(["key"])
    count = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("total") / BLOCK_SHINGLES))
    blocks = members.withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = blocks.select("bucket", "key", "block", other).select(
        "bucket", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    pairs = dealt.join(sets, "key").select("bucket", "low", "high", "block", "key", "buckets", "shingles")
    found = pairs.groupBy("bucket", "low", "high").applyInArrow(
        block_verifier(params, prefix), "key binary, root binary, links bigint, expected double"
    )
    return write_stage(found, "near-links")


def components(edges: DataFrame) -> DataFrame:
    """Smallest key of the connected component of every key in ``edges`` (key, root): rows (key, component).

    Roots hook onto smaller ones and paths are halved, so the rounds grow with the logarithm of the longest path.
    Each round is written out.
    """
    pairs = edges.filter("key <> root").select("key", "root")
    both = write_stage(pairs.union(pairs.select("root", "key")).toDF("a", "b").distinct(), "near-edges")
    parents = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("component"))
    while True:
        parents = write_stage(parents, "near-parents")
        up = parents.select(F.col("key").alias("component"), F.col("component").alias("top"))
        lifted = parents.join(up, "component").select("key", "component", "top")
        near = both.join(lifted.select(F.col("key").alias("b"), "top"), "b").groupBy("a").agg(F.min("top").alias("low"))
        offers = lifted.join(near.withColumnRenamed("a", "key"), "key")
        both_ways = offers.select("key", F.least("top", "low").alias("component")).union(offers.select("component", "low"))
        moved = write_stage(both_ways.groupBy("key").agg(F.min("component").alias("component")), "near-moved")
        changed = moved.join(parents.withColumnRenamed("component", "was"), "key").filter("component <> was")
        parents = moved
        if changed.isEmpty():
            return parents


class Classes(NamedTuple):
    """``rows`` (doc_id, key) of all documents; ``texts`` (key, first_id, copies, class_id, class_key, links)."""

    rows: DataFrame
    texts: DataFrame


def near_classes(docs: DataFrame, params: JoinParams = JoinParams()) -> Classes:
    """Classes of documents joined by copies and by links of similarity at least ``threshold``.

    Only ``doc_id`` and ``text`` are read. Words are ``[^\\x20\\x09-\\x0D]+``. A text of fewer words than a shingle is
    one shingle; a null or wordless text (key null) has no links and no copies. Repeated rows are copies. Null ids
    are allowed; a class without any other id has a null ``class_id``. An empty table gives empty tables.
    """
    read = docs.select("doc_id", sketcher(params)("text").alias("s"))
    rows = write_stage(read.select("doc_id", "s.key", "s.size", "s.sketch"), "near-sketches")
    texts = rows.filter("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch")
    )
    for prefix in prefix_lengths(params):
        found = _verify_buckets(docs, texts, params, prefix)
        links, expected = found.agg(F.sum("links"), F.sum("expected")).first()
        if not links or links >= params.recall * expected:
            break
    linked = found.groupBy("key").agg(F.sum("links").alias("links")).join(components(found), "key", "left")
    firsts = texts.select("key", "first_id", "copies")
    joined = firsts.join(linked, "key", "left").select(
        "key", "first_id", "copies", F.coalesce("component", "key").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
    )
    joined = write_stage(joined, "near-texts")
    head = joined.filter("links > 0").groupBy("component").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("head"))
    classes = joined.join(head, "component", "left").select(
        "key", "first_id", "copies", F.when(F.col("head").isNull(), F.col("first_id")).otherwise(F.col("head.first_id")).alias("class_id"),
        F.coalesce("head.key", "key").alias("class_key"), "links",
    )
    return Classes(rows.select("doc_id", "key"), write_stage(classes, "near-classes"))


def class_of_documents(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id of its class), ``n_links`` (other texts linked with
    its text), ``n_copies`` (documents with its text, itself included). A wordless text is a class of its own."""
    found = near_classes(docs, params)
    crowd = found.texts.filter("copies > 1 or links > 0").select("key", "class_id", "links", "copies")
    joined = found.rows.join(crowd, "key", "left")
    return joined.select(
        "doc_id", F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )


def keep_one_per_class(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with the document of smallest id of every class; wordless texts stay. All columns are kept."""
    found = near_classes(docs, params)
    crowd = found.texts.filter("copies > 1 or links > 0").select("key", "first_id", "class_id", "class_key")
    stays = (F.col("key") == F.col("class_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    judged = found.rows.join(crowd, "key").select("doc_id", "key", stays.alias("stays"))
    gone = judged.filter("not stays").distinct()
    again = judged.filter("stays").groupBy("doc_id", "key").count().filter("count > 1")

    def without(table: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        sides = ids.select(F.col("doc_id").alias("__near_id"), F.col("key").alias("__near_other"))
        return table.join(sides, table["doc_id"].eqNullSafe(sides["__near_id"]) & (table["__near_key"] == sides["__near_other"]), how)

    keyed = docs.withColumn("__near_key", keyer()("text"))
    kept = without(keyed, gone, "left_anti")
    if not again.isEmpty():
        repeated = without(kept, again, "left_semi").dropDuplicates(["doc_id", "__near_key"])
        kept = without(kept, again, "left_anti").unionByName(repeated)
    return kept.drop("__near_key")
