"""Integer lookup tables as constant columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def constant_array(values: Sequence[float], element: str) -> Column:
    """A constant array column; the optimizer folds it to one literal, so an index costs O(1)."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{element}>")
