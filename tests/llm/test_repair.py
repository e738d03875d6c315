"""Conversation repair against an exhaustive search, on whole and on cut conversations."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexigrade.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, edits int, place string"
FIELDS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(turns):
    """Every sequence of edits, cheapest first: ``(cost, audit, lines)`` of (role, text, fault) turns."""
    best: dict[tuple[int, str], tuple] = {(0, ""): (0, "", ())}
    roles = "".join

    def allowed(initials):
        return re.fullmatch(r"(s?(ua)*u?)?", initials) is not None

    def inserted(found):
        out = dict(found)
        for _ in range(2):
            for (_, initials), (cost, audit, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    if allowed(now := initials + role[0]):
                        put(out, now, (cost + 5, audit + "I", lines + (role + ":",)))
        return out

    def put(out, initials, value):
        # What may follow depends only on the last role and on whether there is one.
        key = (min(len(initials), 1), initials[-1:])
        if key not in out or value[:2] < out[key][:2]:
            out[key] = value

    best = {(0, ""): (0, "", ())}
    for role, text, fault in turns:
        out: dict = {}
        for (n, last), (cost, audit, lines) in inserted(best).items():
            prefix = {"": "", "s": "s", "u": "u", "a": "ua"}[last]
            put(out, prefix, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if role[:1] and allowed(prefix + role[:1]):
                put(out, prefix + role[:1], (cost + extra, audit + "K", lines + (f"{role}:{text}",)))
            for new in ("user", "assistant"):
                if allowed(prefix + new[0]):
                    put(out, prefix + new[0], (cost + 1 + extra, audit + "R", lines + (f"{new}:{text}",)))
        best = out
    ends = [v for (_, last), v in inserted(best).items() if last in ("", "a")]
    return min(ends, key=lambda v: v[:2]) if turns else (0, "", ())


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns, seen, illegal, faults = [], set(), 0, []
        for i, (_, role, text) in enumerate(mine):
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            turns.append((role, text, fault))
            illegal += i > 0 and mine[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        known = [t for t, _, _ in mine if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, lines = brute(turns)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def conversations(seed, n, longest):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "support"])
            text = draw.choice(["a b.", "c?", "cut", " \n", "", None, "d e f!", f"own {turn}."])
            rows += [(conv, draw.choice([turn, turn, turn, None, turn + 3]), role, text)] * draw.choice([1, 1, 1, 1, 2, 3])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def result(spark, rows):
    found = repair.report(repair.repair(frame(spark, rows).repartition(3))).select(*FIELDS)
    return {r["conv_id"]: tuple(r) for r in found.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_repair_equals_exhaustive_search(spark, seed):
    rows = conversations(seed, 40, 9)
    assert result(spark, rows) == expected(rows)


def test_cut_conversations_equal_whole_ones(spark, monkeypatch):
    """Segments of three turns, chained by their matrices: nothing changes."""
    rows = conversations(11, 8, 60)
    monkeypatch.setattr(repair, "SEGMENT_TURNS", 3)
    assert result(spark, rows) == expected(rows)


def test_one_conversation_spread_over_all_tasks(spark):
    """A conversation with nearly all turns is cut where the sorted runs end; no task gets all of it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], f"turn {i}.") for i in range(900)] + [(2, 0, "user", "hi.")]
    stored = repair.segments(repair.collapse(frame(spark, rows)))
    sizes = [r["n"] for r in stored.where("conv = 1").groupBy("part").agg(F.sum(F.length("codes")).alias("n")).collect()]
    found = result(spark, rows)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 900 and sum(sizes) == 900
    assert found == expected(rows)


def test_forward_and_backward_vectors_meet(spark):
    """At every cut of a conversation the least sum of both vectors is the whole cost."""
    draw = random.Random(5)
    codes = bytes(draw.randrange(9) for _ in range(60))
    whole = repair.backward(codes, repair.CLOSED)[0]
    for middle in range(1, 60):
        before, after = repair.forward(codes[:middle], 0), repair.backward(codes[middle:], repair.CLOSED)
        assert min(before[s][0] + after[s] for s in range(4)) == whole
    edits, state = repair.divide(codes, 0, repair.CLOSED)
    at, cost = 0, 0
    for code, letters in zip(codes, edits):
        at, (price, _) = next((to, v) for to, v in repair.EDITS[code][at].items() if v[1] == letters)
        cost += price
    assert (cost + repair.CLOSED[state], at) == (whole, state)


def test_repaired_turns_are_legal(spark):
    rows = conversations(3, 30, 12)
    turns = repair.repaired_turns(repair.repair(frame(spark, rows))).orderBy("conv_id", "place").collect()
    by: dict = {}
    for r in turns:
        assert r["edit"] in "KRI"
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, (_, _, _, _, _, _, _, _, digest) in expected(rows).items():
        mine = by.get(conv, [])
        assert re.fullmatch(r"(s?(ua)+)?", "".join(role[0] for role, _ in mine))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in mine).encode()).hexdigest() == digest


def test_no_rows_and_dropped_conversations(spark):
    assert result(spark, []) == {}
    rows = frame(spark, [(5, 0, "user", "gone."), (6, 1, "user", "kept."), (None, None, None, None)]).withColumn("copies", F.when(F.col("conv_id") == 5, 0).otherwise(1))
    found = {r["conv_id"]: (r["cost"], r["audit"], r["gaps"]) for r in repair.report(repair.repair(rows, "copies")).collect()}
    assert found == {5: (0, "", 0), 6: (2, "D", 0), None: (2, "D", 0)}


def test_damage_follows_the_key(spark):
    table = queries.damaged(queries.table(spark, "/root/testdata/sf0.01", "conversations"))
    kinds = {r["copies"]: r["count"] for r in table.groupBy("copies").count().collect()}
    assert set(kinds) == {0, 1, 2} and table.where("copies = 1 and text = ''").count() > 0
