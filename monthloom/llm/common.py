"""What several operators need: shared scratch tables, bounded Arrow batches, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
#: Rows of one Arrow batch on its way to a Python worker; bounds what long texts occupy.
BATCH_ROWS = 256


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    The session's ``spark.checkpoint.dir`` names it; where that is unset, as in a local
    test, a folder in the warehouse is taken.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(frame: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder: lineage ends there."""
    spark, path = frame.sparkSession, scratch(frame.sparkSession)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_arrow(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over batches of at most ``BATCH_ROWS`` rows; what Arrow freed does not stay in the worker."""
    spark = frame.sparkSession
    # Workers find this package where the driver found it, whatever folder they start in.
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if str(ROOT) not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, str(ROOT)]))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    @wraps(function)
    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, schema)


def remainder(id_column: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % divisor


class Memo(dict):
    """A cache of ``function`` with at most ``limit`` entries; full, it starts anew."""

    def __init__(self, function: Callable, limit: int = 400_000) -> None:
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id it is linked with.

    Alternating large-star and small-star steps: each replaces the edges by edges to the
    smallest neighbour, so that every tree gets flat in a logarithmic number of rounds.
    Neighbour minima are aggregated before the shuffle and joined back, so that an id with
    very many neighbours is never gathered; each round is a table in the shared folder.
    """
    edges = saved(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = (
            edges.select(F.col("b").alias("v"), F.col("a").alias("w"))
            .join(low.withColumnRenamed("a", "v"), "v")
            .select(F.col("w").alias("a"), F.col("low").alias("b"))
            .union(low.filter("low < a").select("a", "low"))
            .filter("a <> b")
            .distinct()
        )
        small_low = large.groupBy("a").agg(F.min("b").alias("low"))
        edges = saved(
            large.join(small_low, "a")
            .select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = tuple(
            edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return ids.join(edges.select(F.col("a").alias("id"), F.col("b").alias("component")), "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )
