"""URL filter: glob rules as a bit-parallel wildcard automaton.

Each rule is a chain of states, one per character, packed into 64-bit words (several words for many rules). A step of
Shift-And moves all rules of all URLs of a batch on by one character; a star keeps its state alive. A host star does
not cross a slash, so a host rule can't match inside a path.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``host`` matches itself and its subdomains and may hold stars, as may ``path``, which matches as a prefix."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


class Automaton:
    """Masks of all rules: 256 byte values x words."""

    def __init__(self, rules: Sequence[Rule]):
        chains = []  # per rule: (byte or None for any, loop) with loop in ("", "host", "any") kept after the state
        for rule in rules:
            # State 0 is the empty prefix; before the host any labels may stand.
            states: list[list] = [[None, "host"]]
            for part, loop in (("." + rule.host, "host"), (rule.path, "any")):
                for byte in part.encode("utf-8"):
                    if byte == ord("*"):
                        states[-1][1] = loop
                    else:
                        states.append([byte, ""])
            states[-1][1] = "any"
            chains.append(states)
        total = sum(map(len, chains))
        self.words = max(1, -(-total // 64))
        self.next = np.zeros((256, self.words), np.uint64)
        self.loop_any, self.loop_host = (np.zeros(self.words, np.uint64) for _ in range(2))
        self.first, self.last = np.zeros(self.words, np.uint64), []
        bit = 0
        for states in chains:
            for i, (byte, loop) in enumerate(states):
                word, mask = bit // 64, np.uint64(1 << (bit % 64))
                if i == 0:
                    self.first[word] |= mask
                else:
                    self.next[byte, word] |= mask
                if loop == "any":
                    self.loop_any[word] |= mask
                elif loop == "host":
                    self.loop_host[word] |= mask
                bit += 1
            self.last.append(bit - 1)

    def run(self, texts: list[bytes]) -> np.ndarray:
        """Matches: texts x rules."""
        n = len(texts)
        state = np.tile(self.first, (n, 1))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        for at in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -at, side="left"))
            byte = data[starts[:live] + at]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            slash = (byte == ord("/"))[:, None]
            state[:live] = (moved & self.next[byte]) | (now & self.loop_any) | np.where(slash, np.uint64(0), now & self.loop_host)
        out = np.zeros((n, len(self.last)), bool)
        for r, bit in enumerate(self.last):
            out[order, r] = state[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1) != 0
        return out


def matcher(rules: Sequence[Rule]):
    """Column function: (host, path) -> number of the winning rule, or null.

    The longest rule wins; of equally long ones the first.
    """
    rank = np.array([len(rules) * len(r.text) - i for i, r in enumerate(rules)], np.int64)
    masks = Automaton(rules)

    @F.arrow_udf("int")
    def match(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        texts = [f".{h}{p}".encode("utf-8", "surrogatepass") for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        out: list[int | None] = []
        for low in range(0, len(texts), 8192):
            hit = masks.run(texts[low : low + 8192])
            best = np.where(hit, rank, np.iinfo(np.int64).min).argmax(1)
            out += [int(b) if ok else None for b, ok in zip(best, hit.any(1))]
        return pa.array(out, pa.int32())

    return match


def url_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with ``__host`` and ``__path``: the host follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z lower-cased; the path goes on up to ``?``, ``#`` or the end. Both are empty without ``://``."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("__host", F.translate(host, capitals, small)).withColumn("__path", path)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], globs: Sequence[Rule]) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, glob_rule.

    ``rules`` decide; where none fits, the longest of ``globs`` does (``glob_rule`` names it), else the verdict is ``allow``. Null or
    malformed urls have an empty host and path and are allowed. Repeated rows are judged each; an empty table gives no
    rows; other columns are ignored.
    """
    parts = url_parts(pages.select("page_id", "url"))

    def lookup(index, values):
        return F.coalesce(*[F.when(index == i, v) for i, v in enumerate(values)], F.lit(None).cast("string"))

    found = parts.select(
        "page_id", F.col("__host").alias("host"), F.col("__path").alias("path"),
        matcher(rules)("__host", "__path").alias("r"), matcher(globs)("__host", "__path").alias("g"),
    )
    rule, own = lookup(F.col("r"), [r.text for r in rules]), lookup(F.col("g"), [g.text for g in globs])
    verdict = F.coalesce(lookup(F.col("r"), [r.verdict for r in rules]), lookup(F.col("g"), [g.verdict for g in globs]), F.lit("allow"))
    return found.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.when(F.col("r").isNull(), own).alias("glob_rule"))
