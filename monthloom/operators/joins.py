"""Joins whose keys may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], how: str
) -> DataFrame:
    """Equi-join in which NULL keys match; right keys are renamed and dropped.

    It stays a hash or merge join, and both sides may come from the same frame.
    """
    renamed = {name: f"__{name}" for name in key}
    other = right.withColumnsRenamed(renamed)
    tests = [F.col(name).eqNullSafe(F.col(hidden)) for name, hidden in renamed.items()]
    return left.join(other, reduce(lambda a, b: a & b, tests), how).drop(*renamed.values())
