"""Broadcast of objects of this package to executors that have no copy of it."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import SparkSession

T = TypeVar("T")


def share(spark: SparkSession, value: T) -> Callable[[], T]:
    """A function that returns ``value`` in any task; classes registered for pickling by value travel along.

    The caller bounds the size of ``value``."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    read: list[T] = []

    def get() -> T:
        if not read:
            read.append(pickle.loads(held.value))
        return read[0]

    return get
