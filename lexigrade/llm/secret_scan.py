"""Secret scanning: an Aho-Corasick pass finds keywords, anchored expressions run only at its hits, and tokens that
carry a checksum must pass it.

Runs of hexadecimal digits have no keyword: a run of at least 32 covers a multiple of 32, so only the characters at
these places are looked at before a run is measured.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from functools import lru_cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order at equal starts.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
ORDER = {k: i for i, k in enumerate(KINDS)}

#: Keywords and the shapes of secrets.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
ASSIGN_AFTER = re.compile(r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
RUN = re.compile(r"[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----[\sA-Za-z0-9+/=]+-----END \1-----")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX = frozenset("0123456789abcdef")


def checked_token(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before them, in base 62."""
    value, digits = zlib.crc32(match[1].encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return match[2] == digits.rjust(6, "0")


def decoded(match: re.Match) -> bool:
    """Header and payload of a web token are JSON objects, and the header names an algorithm."""
    try:
        header, payload = (json.loads(base64.urlsafe_b64decode(p + "=" * (-len(p) % 4))) for p in (match[1], match[2]))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(payload, dict) and "alg" in header


#: Further kinds: keyword, expression anchored at it, check.
CHECKED = {
    **{f"gh{c}_": ("github", GITHUB, checked_token) for c in "pousr"},
    "npm_": ("npm", NPM, checked_token),
    "eyJ": ("jwt", JWT, decoded),
    "-----BEGIN": ("pem", PEM, lambda match: True),
}


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """Keywords in all cases of their ASCII letters; the value is (kind or keyword, length)."""
    words = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        for spelt in product(*({c, c.upper()} for c in word)):
            words.add_word("".join(spelt), ("assign", len(word)))
    words.add_word("AKIA", ("access", 4))
    for word in CHECKED:
        words.add_word(word, (word, len(word)))
    words.make_automaton()
    return words


def hex_runs(text: str) -> list[tuple[int, int]]:
    found, done, size = [], 0, len(text)
    for step, char in enumerate(text[MIN_HEX - 1 :: MIN_HEX]):
        at = step * MIN_HEX + MIN_HEX - 1
        if char not in HEX or at < done:
            continue
        low = high = at
        while low > done and text[low - 1] in HEX:
            low -= 1
        while high + 1 < size and text[high + 1] in HEX:
            high += 1
        done = high + 1
        if done - low >= MIN_HEX:
            found.append((low, done))
    return found


class _Runs:
    """Ends of the runs of web-token characters, each found once: many hits in one long run cost no more than one."""

    def __init__(self, text: str):
        self.text, self.end, self.good = text, -1, False

    def is_token(self, start: int) -> bool:
        """Whether the run from ``start`` ends before a dot and another token part: else no web token starts there."""
        if start >= self.end:
            self.end = RUN.match(self.text, start).end()
            self.good = self.text.startswith(".eyJ", self.end)
        return self.good


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind."""
    if not text:
        return []
    spans = [("hex", a, b) for a, b in hex_runs(text)]
    done = dict.fromkeys(KINDS, 0)
    run = _Runs(text)
    hits = sorted({(end - length + 1, what, length) for end, (what, length) in automaton().iter(text)})
    for start, what, length in hits:
        kind, shape, passes = CHECKED.get(what, (what, ACCESS, None))
        if start < done[kind]:
            continue
        if kind == "assign":
            match = ASSIGN_AFTER.match(text, start + length)
            good = match and len(match[1]) >= MIN_ASSIGN
        elif kind == "access":
            match = shape.match(text, start)
            good = match and match.end() - start >= MIN_ACCESS
        elif kind == "jwt" and not run.is_token(start):
            continue
        else:
            match = shape.match(text, start)
            good = match and passes(match)
        if match:
            done[kind] = match.end()
        if good:
            spans.append((kind, start, match.end()))
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))


def spans_of():
    """Column function: text -> array of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in scan(t.as_py())] for t in texts], kind)

    return spans


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end), by start, then kind.

    Offsets count code points, ends are exclusive. Null or empty texts have no spans; texts are read whole; repeated
    rows are scanned each; other columns are ignored; an empty table gives no rows.
    """
    return docs.select("doc_id", spans_of()("text").alias("spans"))
