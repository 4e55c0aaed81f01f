"""Raw tables: month-partitioned parquet, sorted by the clustering columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.schemas import RAW_COLUMNS, RAW_SCHEMA

RAW_CLUSTER = ("partner_code", "cmd_code")
FACT_CLUSTER = ("reporter_code", "cmd_code", "partner_code")


def in_range(frame: DataFrame, month: str, start: date, end_exclusive: date) -> DataFrame:
    return frame.where(
        (F.col(month) >= F.lit(start)) & (F.col(month) < F.lit(end_exclusive))
    )


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """The declared schema also types the partition column, so codes stay strings."""
    return spark.read.schema(schema).parquet(path)


def scan_raw(spark: SparkSession, path: str, start: date, end_exclusive: date) -> DataFrame:
    """Months in [start, end); literal bounds prune the month partitions."""
    table = scan_table(spark, path).select(*RAW_COLUMNS)
    return in_range(table, "period_start_date", start, end_exclusive)


def cluster(
    frame: DataFrame,
    partition: Sequence[str] = ("period_start_date",),
    cluster_by: Sequence[str] = RAW_CLUSTER,
    dealt: bool = False,
) -> DataFrame:
    """Lay rows out for a partitioned write.

    The rebalance hint lets adaptive execution merge small months and split a
    month that holds far more rows than the others over several tasks. Rows that are
    ``dealt`` by ranges of months already stay where they are.
    """
    if dealt:
        return frame.sortWithinPartitions(*partition, *cluster_by)
    return frame.hint("rebalance", *[F.col(name) for name in partition]).sortWithinPartitions(
        *partition, *cluster_by
    )


def write_table(
    frame: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition: Sequence[str] = ("period_start_date",),
    cluster_by: Sequence[str] = RAW_CLUSTER,
    dealt: bool = False,
) -> None:
    """Static overwrite or append."""
    writer = cluster(frame, partition, cluster_by, dealt).write.mode(mode)
    writer.option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(path)


def overwrite_partitions(
    frame: DataFrame,
    path: str,
    partition: Sequence[str] = ("period_start_date",),
    cluster_by: Sequence[str] = RAW_CLUSTER,
) -> None:
    """Replace only the partitions that occur in ``frame``."""
    writer = cluster(frame, partition, cluster_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(hadoop_path)


def delete_partitions(spark: SparkSession, path: str, name: str, values: Sequence[str]) -> None:
    """Remove whole partition folders; ``values`` are calendar months, so few."""
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={value}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(folder, True)
