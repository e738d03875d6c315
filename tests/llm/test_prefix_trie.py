"""The prefix trie against a dictionary of all prefixes, with bursts forced by small containers."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from lexigrade.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, key string, head int, words int, depth int"


def turn_id(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def sequences(rows):
    """Turns ``(id, words)`` of each conversation, in order."""
    out: dict = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        out.setdefault(conv, []).append((turn is not None, turn or 0, role, turn_id(role, text), len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in out.items()}


def brute(by_conv):
    nodes: dict = {}
    for conv, turns in by_conv.items():
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(i for i, _ in turns[:d]), {"members": [], "ends": [], "words": turns[d - 1][1] if d else 0})
            node["members"].append(conv)
        node["ends"].append(conv)
    for node in nodes.values():
        known = [c for c in node["members"] if c is not None]
        node["rep"] = min(known) if known else None
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, node in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(node["members"]) - 1) * node["words"]
    out = []
    for p, node in nodes.items():
        ends = sorted(node["ends"], key=lambda c: (c is not None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        parent = nodes[p[:-1]]["rep"] if p else None
        out.append((node["rep"], len(p), parent, len(node["members"]), children[p], leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def conversations(seed, n, longest, kinds=3):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        length = draw.randint(1, longest)
        for turn in range(length):
            rows.append((conv, None if turn == 0 and conv and conv % 7 == 0 else turn, ("user", "assistant", None)[turn % 3], draw.choice(["a b", "c", "", None, "d e f"][: kinds + 1])))
    # A large group of copies, a group of copies with different ends, repeated rows, and a prefix of others that ends early.
    for conv in range(100, 130):
        rows += [(conv, t, "user", f"copy {t}") for t in range(12)]
    for conv in range(130, 150):
        rows += [(conv, t, "user", f"copy {t}") for t in range(9)] + [(conv, 9, "user", f"end {conv % 4}")]
    rows += [(200, t, "user", f"copy {t}") for t in range(5)] + [(201, 0, "user", "same")] * 4
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], SCHEMA).repartition(3)


def found(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("container", [1, 40, 200, prefix_trie.CONTAINER_TURNS])
def test_trie_equals_all_prefixes(spark, container):
    """Whatever bursts, the nodes are the same; a container of one turn bursts down to single conversations."""
    rows = conversations(1, 25, 5)
    assert found(prefix_trie.trie(frame(spark, rows), container)) == brute(sequences(rows))


def test_rounds_follow_branching_not_length(spark, monkeypatch):
    """Two long conversations that differ in their last turn need one burst for their common turns."""
    rows = [(c, t, "user", f"turn {t}" if t < 299 else f"end {c}") for c in (4, 9, 11) for t in range(300)]
    rounds = []
    kept = prefix_trie._containers
    monkeypatch.setattr(prefix_trie, "_containers", lambda heads, limit: rounds.append(limit) or kept(heads, limit))
    monkeypatch.setattr(prefix_trie, "PATH_BLOCK", 16)
    assert found(prefix_trie.trie(frame(spark, rows), 50)) == brute(sequences(rows))
    assert len(rounds) <= 3


def test_no_task_gets_a_bursting_container(spark, monkeypatch):
    """Only resting containers are swept, and they hold at most the given number of turns."""
    rows = conversations(2, 60, 6)
    sizes = []
    kept = prefix_trie.swept

    def watched(resting, turns):
        heads = resting.selectExpr("conv c", "key k", "head")
        rows = turns.join(heads, turns["conv"].eqNullSafe(heads["c"]) & (turns["depth"] > heads["head"]))
        sizes.extend(r["count"] for r in rows.groupBy("k").count().collect())
        return kept(resting, turns)

    monkeypatch.setattr(prefix_trie, "swept", watched)
    assert found(prefix_trie.trie(frame(spark, rows), 30)) == brute(sequences(rows))
    assert sizes and max(sizes) <= 30


def test_a_conversation_spread_over_tasks_is_numbered_through(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(1, t, "user", f"turn {t}") for t in range(800)] + [(None, t, "user", f"turn {t}") for t in range(3)]
    turns = prefix_trie.numbered(frame(spark, rows)).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["depth"] for r in turns if r["conv"] == 1) == list(range(1, 801))
    assert {r["id"]: r["depth"] for r in turns if r["conv"] == 1} == {turn_id("user", f"turn {t}"): t + 1 for t in range(800)}


def test_rebuilt_conversations(spark):
    """Families take their first turns from their first conversation; some of those are missing or short."""
    rows = [(c, t, "user", f"{c} {t}") for c in range(20, 60) if c != 40 for t in range(1 + c % 5)] + [(-3, 0, "user", "below"), (None, 0, "user", "none")]
    turns = sequences(rows)

    def take(c):
        return zlib.crc32(str(c).encode()) % 4 if c is not None else 0

    wanted = {}
    for c, own in turns.items():
        base = turns.get(None if c is None else c - int(abs(c) % 20) * (1 if c >= 0 else -1), [])
        wanted[c] = base[: take(c)] + own[take(c) :] if c is not None else own
    assert found(prefix_trie.build(*queries.rebuilt(prefix_trie.numbered(frame(spark, rows))), 25)) == brute(wanted)


def test_no_conversations(spark):
    assert found(prefix_trie.trie(frame(spark, []))) == []
