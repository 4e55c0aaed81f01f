"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.catalog.oracle import by_line, with_tables
from monthloom.operators.dimensions import dim_countries
from monthloom.params import Params
from monthloom.plans.multi_market import MultiMarket
from monthloom.plans.single_market import SingleMarket
from monthloom.sources.star import Panel

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
START, END = date(1995, 1, 1), date(2001, 12, 1)
STAR = Params(start=START, end=END, products=TYPES, reporters=REGIONS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FUNCTIONS: dict[str, tuple] = {}


def pinned(frame: DataFrame) -> DataFrame:
    """Keep rows that several branches of one plan read.

    All of them are at most as many as the panel's cells, see ``sources.star``.
    """
    return frame.persist(StorageLevel.MEMORY_AND_DISK)


class Tables:
    """The panel of one data folder and the marts built on it, made when asked for."""

    def __init__(self, spark: SparkSession, folder: str, by_line: bool = False) -> None:
        self.spark, self.folder, self.by_line = spark, folder, by_line

    @cached_property
    def panel(self) -> Panel:
        return Panel(self.spark, self.folder, self.by_line)

    @cached_property
    def countries(self) -> DataFrame:
        return dim_countries(self.panel.countries)

    @cached_property
    def multi(self) -> MultiMarket:
        p = self.panel
        return MultiMarket(p.detail, p.world, p.countries, p.hs_codes, STAR, pinned)

    @cached_property
    def single(self) -> SingleMarket:
        p = self.panel
        return SingleMarket(p.detail, p.world, p.countries, p.hs_codes, STAR, pinned)

    def scratch(self) -> str:
        """A new folder below the cluster's shared one, or the warehouse where that is unset."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            shared = self.spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
            if self.spark.sparkContext.getCheckpointDir() is None:
                self.spark.sparkContext.setCheckpointDir(f"{shared}/checkpoints")
        return f"{shared.rstrip('/')}/panel-{uuid4().hex}"


def report(frame: DataFrame) -> DataFrame:
    """Plain types for comparison: dates and times as ISO text, decimals as doubles."""
    columns = []
    for field in frame.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def query(name: str, sql: str | None = None):
    """Register ``function(tables) -> DataFrame`` under ``name``."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return report(function(Tables(spark, folder)))

        FUNCTIONS[name] = function, sql
        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return function

    return register


def also_by_line(name: str) -> None:
    """Register the query ``name`` once more, as ``line_<name>``, on the panel by line."""
    function, sql = FUNCTIONS[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(function(Tables(spark, folder, by_line=True)))

    run.__name__ = f"line_{name}"
    run.__doc__ = function.__doc__
    QUERIES[run.__name__] = run
    ORACLES[run.__name__] = by_line(with_tables(sql))
