"""Published snapshots: gzip JSON with exact decimal strings, one folder per version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.functions.text import csv_cell, namespaced_sha256, plain_decimal

# Keeps every file small enough to be hashed as one row.
MAX_RECORDS_PER_FILE = 1_000_000


def wire_columns(schema: T.StructType) -> list[Column]:
    """Decimals as plain strings, dates as ISO strings, all else unchanged."""
    columns = []
    for field in schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = plain_decimal(column)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return columns


def wire_schema(schema: T.StructType) -> T.StructType:
    text = (T.DecimalType, T.DateType)
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, text) else f.dataType)
            for f in schema
        ]
    )


def to_wire(frame: DataFrame, schema: T.StructType) -> DataFrame:
    return frame.select(*wire_columns(schema))


def write_documents(frame: DataFrame, path: str, partition: str | None = None) -> None:
    """JSON lines; with ``partition`` one folder per market, so readers load one only."""
    if partition is not None:
        frame = frame.hint("rebalance", F.col(partition))
    writer = frame.write.mode("errorifexists").option("compression", "gzip")
    writer = writer.option("ignoreNullFields", False)
    writer = writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.json(path)


def scan_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The schema also types the partition column: codes keep their leading zeros."""
    return spark.read.schema(wire_schema(schema)).option("mode", "FAILFAST").json(path)


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """Relative name, bytes, rows and SHA-256 of each data file below ``path``."""

    def name(file: Column) -> Column:
        market = F.nullif(F.regexp_extract(file, r"/(reporter_code=[^/]+)/[^/]+$", 1), F.lit(""))
        return F.concat_ws("/", market, F.regexp_extract(file, r"([^/]+)$", 1)).alias("file")

    options = {"recursiveFileLookup": True, "pathGlobFilter": "*.json.gz"}
    hashed = spark.read.format("binaryFile").options(**options).load(path).select(
        name(F.col("path")),
        F.col("length").alias("bytes"),
        namespaced_sha256(F.col("content")).alias("sha256"),
    )
    # A damaged file is told by its hash; here it only loses rows.
    lines = spark.read.options(**options).option("ignoreCorruptFiles", True).text(path)
    counted = lines.groupBy(name(F.col("_metadata.file_path"))).agg(F.count("*").alias("rows"))
    joined = hashed.join(counted, "file", "left")
    return joined.select("file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), "sha256")


def write_csv(frame: DataFrame, path: str) -> None:
    """Every cell quoted, formula signs guarded, decimals plain; no byte-order mark."""
    cells = []
    for field in frame.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            # A number: its sign is not a formula.
            cells.append(plain_decimal(value).alias(field.name))
        else:
            cells.append(csv_cell(value).alias(field.name))
    writer = frame.select(*cells).write.mode("errorifexists").option("header", True).option("quoteAll", True)
    writer.option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)
