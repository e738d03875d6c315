"""Rows with every awkward case: nulls in any column, empty and very long texts, repeated rows, clashing names."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, `__lines` int, bucket int"
COMMON = "This very common line stands in many documents."


def prose(seed: int, n: int) -> str:
    words, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        words.append("".join("abcdefghijklmnopqrstuvwxyz"[x >> s & 15] for s in (3, 8, 13, 18)))
    return " ".join(words) + "."


def awkward_texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, base.replace(" ", "\n\t ")), (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (9, "one two"),
        (10, prose(2, 200) + "\n" + COMMON), (11, COMMON.upper() + " \n" + prose(3, 90)), (12, "\t" + COMMON + "\n" + COMMON + "\n" + prose(4, 70)),
        (13, prose(5, 30_000)), (None, prose(6, 80)), (None, prose(6, 80)), (14, prose(7, 60)), (14, prose(7, 60)), (15, "é\u00a0 ß <|endoftext|> \U0001f600  x\n\n  y"),
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, None, None if (i or 0) % 2 else "s", None if t is None else len(t), "k", 0.5, 1, 2) for i, t in awkward_texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
