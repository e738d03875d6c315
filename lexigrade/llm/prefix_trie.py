"""Prefix trie of conversations, built as a burst trie.

A container holds the suffixes of all conversations that begin with the turns of its trie head. A container of more turns than one task should
hold bursts: its head first runs down the turns that its members have in common, then every next turn id becomes the head of a new container.
That is a join with one turn per conversation and a count that Spark combines before the shuffle, so neither a first turn that a third of
all conversations share nor a large group of copies meets in one task. Containers that are small enough rest; at the end they are dealt to
shards, and each is sorted and swept once into its nodes. Totals of subtrees climb the containers from the last burst to the root.

Turns are numbered without gathering a conversation: they are range-sorted, every task numbers its run, and the first conversation of a run
adds what stands before it. Turn texts are replaced by 128-bit ids at once. There is one round per burst: as many as branching turns follow each
other while more than ``container_turns`` turns share them; common turns cost no round.

Null roles and texts are empty, null turns come first, equal turns are ordered by role and id, repeated rows are turns of their own. A null
``conv_id`` is a conversation of its own, is nobody's smallest member unless it is alone, and is written as nothing. Without conversations there
is no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrade.session import BROADCAST_ROWS, count_up_to, lookup_side, write_stage

#: Turns that a container may hold before it bursts.
CONTAINER_TURNS = 20_000
#: Depths whose running sum one window partition makes.
PATH_BLOCK = 10_000
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = [field.split(" ")[0] for field in NODE.split(", ")]


# -- turns ------------------------------------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """``(conv, depth, id, words)``: the turns of every conversation, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        words.cast("long").alias("words"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "id")]
    run = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "id", "words")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(0))
            ends = runs.run_ends.to_numpy()
            starts = np.concatenate([[0], ends[:-1]])
            at = np.arange(batch.num_rows) - np.repeat(starts, ends - starts) + 1
            if (runs.values[0].as_py(),) == last:
                at[: ends[0]] += before
            last, before = (runs.values[-1].as_py(),), int(at[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(at), part), pa.int32()), pa.array(at)], names=["conv", "id", "words", "part", "at"])

    stored = write_stage(run.mapInArrow(number, "conv long, id string, words long, part int, at long"), "trie-runs")
    # Only the first conversation of a run has turns in runs before: at most one row per task.
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("conv", "part").agg(F.max("at").alias("n")).withColumn("before", F.sum("n").over(ahead))
    offsets = counts.where("before > 0").select(F.col("conv").alias("c"), F.col("part").alias("p"), "before")
    placed = stored.join(F.broadcast(offsets), (F.col("part") == F.col("p")) & F.col("conv").eqNullSafe(F.col("c")), "left")
    return placed.select("conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("depth"), "id", "words")


def members_of(turns: DataFrame) -> DataFrame:
    """``(conv, n)``: conversations and their numbers of turns."""
    return turns.groupBy("conv").agg(F.max("depth").alias("n"))


# -- sweeping ---------------------------------------------------------------------------------------


class _Node:
    __slots__ = ("depth", "words", "parent", "rep", "n", "children", "leaves", "saved", "ends")

    def __init__(self, depth: int, words: int, parent: _Node | None):
        self.depth, self.words, self.parent = depth, words, parent
        self.rep, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, []

    def close(self) -> None:
        """All members are known: hand the sums to the parent."""
        self.n += len(self.ends)
        known = [c for c in (self.rep, *self.ends) if c is not None]
        self.rep = min(known) if known else None
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.words
        up = self.parent
        if up is not None:
            up.n, up.children, up.leaves, up.saved = up.n + self.n, up.children + 1, up.leaves + self.leaves, up.saved + self.saved
            if self.rep is not None:
                up.rep = self.rep if up.rep is None else min(up.rep, self.rep)


def ends_digest(convs: list[int | None]) -> str:
    ordered = sorted(convs, key=lambda c: (c is not None, c or 0))
    return hashlib.sha256(",".join("" if c is None else str(c) for c in ordered).encode()).hexdigest()


def sweep(suffixes: list[tuple[tuple[str, ...], list[int], int | None]], depth: int) -> list[_Node]:
    """The nodes below a head at ``depth``; a suffix is its turn ids, their words and its conversation."""
    suffixes.sort(key=lambda s: s[0])
    nodes: list[_Node] = []
    path: list[_Node] = []
    before: tuple[str, ...] = ()
    for ids, words, conv in suffixes:
        common = 0
        while common < min(len(ids), len(before)) and ids[common] == before[common]:
            common += 1
        while len(path) > common:
            path.pop().close()
        for i in range(common, len(ids)):
            path.append(_Node(depth + i + 1, words[i], path[-1] if path else None))
            nodes.append(path[-1])
        path[-1].ends.append(conv)
        before = ids
    while path:
        path.pop().close()
    return nodes


_SWEPT = "key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def swept(resting: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of all resting containers; ``resting`` holds ``(conv, key, head, rep)`` of their suffixes."""
    heads = resting.select(F.col("conv").alias("c"), "key", "head", "rep")
    rows = turns.join(heads, F.col("conv").eqNullSafe(F.col("c")) & (F.col("depth") > F.col("head")))
    shards = rows.select("key", "head", "rep", "conv", "depth", "id", "words").repartition("key").sortWithinPartitions("key", "conv", "depth")
    names = [field.split(" ")[0] for field in _SWEPT.split(", ")]

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, rep, suffixes = None, 0, None, []
        out: list[tuple] = []

        def close() -> None:
            if suffixes:
                for n in sweep([(tuple(ids), words, conv) for conv, ids, words in suffixes], head):
                    above = rep if n.parent is None else n.parent.rep
                    out.append((key, n.rep, n.depth, above, n.n, n.children, n.leaves, n.saved, ends_digest(n.ends)))

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), *[pa.int64()] * 7, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names=names)

        for part in batches:
            for k, h, r, conv, _, turn, words in zip(*[c.to_pylist() for c in part.columns]):
                if k != key:
                    close()
                    key, head, rep, suffixes = k, h, r, []
                    if len(out) > 10_000:
                        yield batch()
                        out.clear()
                if not suffixes or suffixes[-1][0] != conv:
                    suffixes.append((conv, [], []))
                suffixes[-1][1].append(turn)
                suffixes[-1][2].append(words)
        close()
        if out:
            yield batch()

    return shards.mapInArrow(nodes, _SWEPT)


# -- bursting ---------------------------------------------------------------------------------------


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


class _Round(NamedTuple):
    """Containers of one burst, and the common turns that the heads of those that burst again run down."""

    containers: DataFrame
    path: DataFrame | None


def _containers(heads: DataFrame, limit: int) -> DataFrame:
    """One row per container; all members of a key share the head's depth, words and parent."""
    grouped = heads.groupBy("key").agg(
        F.min("conv").alias("rep"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("turns") - F.col("head")).alias("left"),
        *[F.first(c).alias(c) for c in ("head", "words", "parent_key", "parent_rep")],
    )
    return write_stage(grouped.withColumn("bursts", F.col("left") > limit), "trie-containers")


def _burst(alive: DataFrame, over: DataFrame, n_over: int, turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Path nodes, ends on the path and heads of the new containers of the containers ``over``."""
    members = alive.join(lookup_side(over.select(F.col("key").alias("k"), "rep"), n_over), F.col("key") == F.col("k"))
    members = members.select(F.col("conv").alias("c"), "key", "head", "turns", "rep")
    rows = turns.join(members, same("conv", "c") & (F.col("depth") > F.col("head"))).drop("c")
    levels = rows.groupBy("key", "depth").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("rep"),
        F.min("words").alias("words"),
        (F.min("id") != F.max("id")).alias("forks"),
        F.first("head").alias("head"),
        F.first("rep").alias("head_rep"),
    )
    levels = write_stage(levels, "trie-levels")
    forks = levels.where("forks").groupBy("key").agg(F.min("depth").alias("fork"))
    forks = write_stage(forks, "trie-forks")
    fork = lookup_side(forks.select(F.col("key").alias("k"), "fork"), n_over)
    common = levels.join(fork, F.col("key") == F.col("k"), "left").where("fork IS NULL OR depth < fork")
    above = common.select(F.col("key").alias("ka"), (F.col("depth") + 1).alias("da"), F.col("rep").alias("above"))
    path = common.join(above, (F.col("key") == F.col("ka")) & (F.col("depth") == F.col("da")), "left")
    parent = F.when(F.col("depth") == F.col("head") + 1, F.col("head_rep")).otherwise(F.col("above"))
    path = path.select("key", "depth", "n", "rep", "words", parent.alias("parent_rep"), (F.col("depth") + 1).eqNullSafe(F.col("fork")).alias("bottom"))
    path = write_stage(path, "trie-path")

    ends = members.join(fork, F.col("key") == F.col("k"), "left").where("fork IS NULL OR turns < fork")
    ends = ends.select("key", F.col("turns").alias("depth"), F.col("c").alias("conv"))
    bottoms = path.where("bottom").select(F.col("key").alias("kb"), F.col("rep").alias("bottom_rep"))
    new = rows.join(fork, F.col("key") == F.col("k")).where("depth = fork")
    new = new.join(lookup_side(bottoms, n_over), F.col("key") == F.col("kb"), "left")
    heads = new.select(
        "conv",
        F.md5(F.concat("key", "id")).alias("key"),
        F.col("depth").alias("head"),
        "turns",
        "words",
        F.col("key").alias("parent_key"),
        F.coalesce("bottom_rep", "rep").alias("parent_rep"),
    )
    return path, ends, write_stage(heads, "trie-heads")


def _digests(ends: DataFrame) -> DataFrame:
    """``(key, depth, ends)``: hash of the sorted members that end at a node, streamed in order; holds no list."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running, done = None, None, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.string()))], names=["key", "depth", "ends"])

        for part in batches:
            for key, depth, conv in zip(*[c.to_pylist() for c in part.columns]):
                text = "" if conv is None else str(conv)
                if (key, depth) != node:
                    if node is not None:
                        done.append((*node, running.hexdigest()))
                    node, running = (key, depth), hashlib.sha256(text.encode())
                else:
                    running.update(f",{text}".encode())
            if len(done) > 10_000:
                yield batch()
                done.clear()
        if node is not None:
            done.append((*node, running.hexdigest()))
            yield batch()

    ordered = ends.repartition("key", "depth").sortWithinPartitions("key", "depth", F.col("conv").asc_nulls_first())
    return ordered.select("key", "depth", "conv").mapInArrow(digest, "key string, depth long, ends string")


def _path_sums(path: DataFrame) -> DataFrame:
    """``path`` with ``below``: tokens saved by a path node and all common turns under it, as sums of blocks of depths."""
    saved = path.withColumn("own", (F.col("n") - 1) * F.col("words")).withColumn("block", F.floor(F.col("depth") / PATH_BLOCK))
    down = F.col("block").desc()
    under = Window.partitionBy("key").orderBy(down).rowsBetween(Window.unboundedPreceding, -1)
    blocks = saved.groupBy("key", "block").agg(F.sum("own").alias("all")).withColumn("under", F.coalesce(F.sum("all").over(under), F.lit(0)))
    inside = Window.partitionBy("key", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return saved.join(blocks, ["key", "block"]).withColumn("below", F.sum("own").over(inside) + F.col("under")).drop("own", "block", "all", "under")


def build(turns: DataFrame, members: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the trie of ``turns (conv, depth, id, words)`` of the conversations ``members (conv, n)``.

    ``members`` also names conversations without turns. Node columns are those of ``NODE``.
    """
    turns = write_stage(turns, "trie-turns")
    none = F.lit(None)
    heads = write_stage(
        members.select(
            "conv", F.lit("").alias("key"), F.lit(0).cast("long").alias("head"), F.col("n").alias("turns"), F.lit(0).cast("long").alias("words"),
            none.cast("string").alias("parent_key"), none.cast("long").alias("parent_rep"),
        ),
        "trie-heads",
    )
    rounds: list[_Round] = []
    ends, resting = [], []
    while True:
        containers = _containers(heads, container_turns)
        ends.append(heads.where("turns = head").select("key", F.col("head").alias("depth"), "conv"))
        alive = heads.where("turns > head")
        over = containers.where("bursts")
        n_over = count_up_to(over, BROADCAST_ROWS)
        quiet = containers.where("not bursts").select(F.col("key").alias("k"), "rep")
        resting.append(alive.join(quiet, F.col("key") == F.col("k")).select("conv", "key", "head", "rep"))
        if not n_over:
            rounds.append(_Round(containers, None))
            break
        path, path_ends, heads = _burst(alive, over, n_over, turns)
        rounds.append(_Round(containers, path))
        ends.append(path_ends)

    union = lambda parts: reduce(DataFrame.unionByName, parts)
    inner = write_stage(swept(union(resting), turns), "trie-swept")
    tops = inner.join(union([r.containers for r in rounds]).select(F.col("key").alias("k"), "head"), F.col("key") == F.col("k"))
    tops = tops.where("depth = head + 1").groupBy("key").agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    tops = write_stage(tops, "trie-tops")

    # From the last round up: what hangs below the head or, where it ran down common turns, below their last one.
    nodes, below = [], None
    for containers, path in reversed(rounds):
        hanging = tops if below is None else tops.unionByName(below)
        hanging = hanging.select(F.col("key").alias("kh"), "children", "leaves", "saved")
        heads = containers.join(hanging, F.col("key") == F.col("kh"), "left")
        children, leaves = F.coalesce("children", F.lit(0)), F.coalesce("leaves", F.lit(1))
        saved = F.coalesce("saved", F.lit(0))
        if path is not None:
            sums = _path_sums(path)
            first = sums.groupBy(F.col("key").alias("kp")).agg(F.max("below").alias("run"), F.max("depth").alias("last"))
            on_path = sums.join(hanging, F.col("key") == F.col("kh"), "left").join(first.drop("run"), F.col("key") == F.col("kp"))
            nodes.append(
                on_path.select(
                    "key", F.col("rep").alias("conv_id"), "depth", F.col("parent_rep").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                    F.when(F.col("depth") == F.col("last"), children).otherwise(1).alias("n_children"), leaves.alias("n_leaves"),
                    (F.col("below") + saved).alias("saved_tokens"),
                )
            )
            heads = heads.join(first, F.col("key") == F.col("kp"), "left")
            children = F.when(F.col("run").isNotNull(), 1).otherwise(children)
            saved = saved + F.coalesce("run", F.lit(0))
        done = heads.select(
            "key", F.col("rep").alias("conv_id"), F.col("head").alias("depth"), F.col("parent_rep").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            children.cast("long").alias("n_children"), leaves.alias("n_leaves"), (saved + (F.col("n") - 1) * F.col("words")).alias("saved_tokens"), "parent_key",
        )
        done = write_stage(done, "trie-nodes")
        nodes.append(done.drop("parent_key"))
        below = done.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(
            F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
    ended = _digests(union(ends)).select(F.col("key").alias("ke"), F.col("depth").alias("de"), "ends")
    outer = union(nodes).join(ended, (F.col("key") == F.col("ke")) & (F.col("depth") == F.col("de")), "left")
    outer = outer.withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY)))
    return outer.select(*COLUMNS).unionByName(inner.select(*COLUMNS))


def trie(conversations: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The trie of conversations ``(conv_id, turn, role, text)`` as they are."""
    turns = numbered(conversations)
    return build(turns, members_of(turns), container_turns)
