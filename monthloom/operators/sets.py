"""Unions, differences and intersections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Rows of several frames with the name of the frame they came from."""
    parts = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    return reduce(lambda left, right: left.unionByName(right), parts)


def symmetric_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows on one side only, NULL-safe, with the side they are on.

    Both directions come out of one aggregate over the tagged union instead of two
    set differences that each read both inputs.
    """
    tagged = union_tagged(
        {"left": left.select(*columns), "right": right.select(*columns)}, "side"
    )
    sides = tagged.groupBy(*columns).agg(
        F.count_if(F.col("side") == "left").alias("on_left"),
        F.count_if(F.col("side") == "right").alias("on_right"),
    )
    alone = (F.col("on_left") == 0) | (F.col("on_right") == 0)
    side = F.when(F.col("on_right") == 0, "left").otherwise("right")
    return sides.where(alone).select(*columns, side.alias("side"))


def union_struct_tagged(frames: dict[str, DataFrame]) -> DataFrame:
    """Different shapes in one result: a struct column per kind, NULL in other kinds."""
    shapes = {name: frame.schema for name, frame in frames.items()}
    parts = []
    for name, frame in frames.items():
        record = F.struct(*frame.columns)
        columns = [
            (record if other == name else F.lit(None).cast(shape)).alias(other)
            for other, shape in shapes.items()
        ]
        parts.append(frame.select(F.lit(name).alias("kind"), *columns))
    return reduce(lambda left, right: left.unionByName(right), parts)


def common_months(
    available: DataFrame, reporters: Sequence[str], products: Sequence[str]
) -> DataFrame:
    """Months present in every requested scope; a scope without data empties the result.

    ``available`` holds reporter_code, cmd_code, month.
    """
    needed = len(set(reporters)) * len(set(products))
    inside = available.where(
        F.col("reporter_code").isin(list(reporters)) & F.col("cmd_code").isin(list(products))
    )
    per_scope = inside.select("reporter_code", "cmd_code", "month").distinct()
    counted = per_scope.groupBy("month").agg(F.count("*").alias("scopes"))
    return counted.where(F.col("scopes") == F.lit(needed)).select("month")
