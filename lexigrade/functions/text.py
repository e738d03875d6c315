"""Tokenisers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern (letters, digits, underscore of any script) and the
# whitespace set that a Unicode-aware split cuts on.
WORD_PATTERN = r"([\p{L}\p{N}_]+)"
SPACE_PATTERN = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def _no_tokens() -> Column:
    return F.array().cast("array<string>")


def word_tokens(text: Column) -> Column:
    """Lower-cased word tokens in text order; an empty array for a null text."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(1)), _no_tokens())


def ws_tokens(text: Column) -> Column:
    """Lower-cased tokens between runs of whitespace."""
    pieces = F.split(F.lower(text), SPACE_PATTERN)
    return F.coalesce(F.filter(pieces, lambda piece: piece != ""), _no_tokens())
