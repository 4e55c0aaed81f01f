"""Reference data kept as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from monthloom.schemas import COUNTRY_SCHEMA, HS_SCHEMA


def scan_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.option("escape", '"').csv(path)


def scan_countries(spark: SparkSession, path: str) -> DataFrame:
    return scan_seed(spark, path, COUNTRY_SCHEMA)


def scan_hs_codes(spark: SparkSession, path: str) -> DataFrame:
    return scan_seed(spark, path, HS_SCHEMA)
