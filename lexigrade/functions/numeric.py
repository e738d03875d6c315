"""Numeric column expressions shared by the models and the reports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Clip of the logistic input, digits of the reports, digits that make two weights one category.
LOGIT_CLIP = 700.0
REPORT_SCALE = 10_000.0
CATEGORY_SCALE = 1e12
# Fixed values of the counter-based draw: a prime, and a factor and a shift below it. No product leaves 63 bits.
DRAW_PRIME = 2_147_483_647
DRAW_FACTOR, DRAW_SHIFT = 48_271, 1_013_904_223


def rounded4(x: Column) -> Column:
    """Four digits, ties to even on the scaled value."""
    return F.rint(x * REPORT_SCALE) / REPORT_SCALE


def category(x: Column) -> Column:
    """Value as a category: differences in the last bits of a weight do not open a new one."""
    return F.rint(x * CATEGORY_SCALE) / CATEGORY_SCALE


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def sigmoid_clipped(z: Column) -> Column:
    return sigmoid(F.greatest(F.least(z, F.lit(LOGIT_CLIP)), F.lit(-LOGIT_CLIP)))


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, 0 on an empty denominator."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2.0 * precision * recall, precision + recall)


def x_log_x(x: Column) -> Column:
    return F.when(x > 0, x * F.ln(x)).otherwise(F.lit(0.0))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(x), f), 0)


def draw_mix(z: Column) -> Column:
    """A permutation of ``0..DRAW_PRIME-1``: a linear step, then the fifth power modulo the prime."""
    p = F.lit(DRAW_PRIME).cast("long")
    fifth = lambda z: _bound(z * z % p, lambda square: square * square % p * z % p)
    return _bound(F.pmod(z * DRAW_FACTOR + DRAW_SHIFT, p), fifth)


def counter_draw(n: int, *counters: Column) -> Column:
    """A number in ``0..n-1`` that depends on the counters alone: no state, and plain arithmetic that any SQL repeats."""
    p = F.lit(DRAW_PRIME).cast("long")
    high = reduce(lambda z, c: draw_mix(z + F.pmod(c.cast("long"), p)), counters, F.lit(0).cast("long"))
    return _bound(high, lambda z: (z * p + draw_mix(z)) % F.lit(n).cast("long"))
