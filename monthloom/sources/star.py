"""A revisioned monthly panel made from a sales star schema.

Month of shipping, region of the buyer (reporter), nation of the supplier
(partner) and part type (product) span the panel; the line number stands in for
the revision of an extract.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthloom.functions.calendar import first_of_month, to_period
from monthloom.functions.text import namespaced_sha256
from monthloom.params import IMPORT_FLOW, WORLD_CODE
from monthloom.schemas import COUNTRY_SCHEMA, HS_SCHEMA, RAW_COLUMNS, RAW_SCHEMA

UNIT = ("period_start_date", "reporter_code", "cmd_code")
EXTRACT = (*UNIT, "revision")
LINES_A_TASK = 250_000


# Columns of the star tables this panel is made of.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    ),
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A declared schema: no job that opens files only to learn their columns."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def typed(frame: DataFrame, schema) -> DataFrame:
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def hundredths(value: Column) -> Column:
    """Whole hundredths of a two-digit amount: exact sums on plain longs per line."""
    return F.floor(value * 100 + 0.5)


def two_digits(total: Column) -> Column:
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,9)")


def line_parts(spark: SparkSession, folder: str) -> int:
    """Parts of a panel by line: as many as the table asks for. Counting reads footers only."""
    lines = read(spark, folder, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, lines // LINES_A_TASK + 1)


def star_cells(
    spark: SparkSession, folder: str, by_line: bool = False, tasks: int = 0, by_month: bool = False
) -> DataFrame:
    """One row per month, reporter, partner, product and revision.

    ``by_line`` takes the supplier itself as partner and the part as product: about one
    row per line, so the panel grows with the table.

    No join carries a broadcast hint: Spark broadcasts a side only below its size
    threshold and sorts and merges otherwise, where it also splits skewed keys.
    Orders meet customers before the lines do, so the widest input is shuffled with
    two narrow columns attached instead of the customer row. The sums combine on
    the map side; unless ``by_line``, what is left is bounded by the codes.

    ``by_line`` nothing combines, so the joined lines are dealt once by month, reporter
    and product, to ``tasks``. Extracts and their versions lie together from there on,
    and the steps that follow shuffle nothing again. ``by_month`` deals ranges of them,
    for a write by month.
    """
    nation = read(spark, folder, "nation")
    region = read(spark, folder, "region")
    buyers = (
        read(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("reporter_code"))
    )
    orders = (
        read(spark, folder, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "reporter_code", F.col("o_orderdate").alias("ordered_at"))
    )
    product = F.col("p_partkey").cast("string") if by_line else F.col("p_type")
    partner = F.col("s_suppkey") if by_line else F.col("s_nationkey")
    parts = read(spark, folder, "part").select("p_partkey", product.alias("cmd_code"))
    sellers = read(spark, folder, "supplier").select(
        "s_suppkey", partner.cast("string").alias("partner_code")
    )
    weighed = F.when(F.col("l_linenumber") != 7, F.col("l_quantity"))
    joined = (
        read(spark, folder, "lineitem")
        .select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            first_of_month(F.col("l_shipdate")).alias("period_start_date"),
            (F.col("l_linenumber") % 3 + 1).cast("long").alias("revision"),
            hundredths(F.col("l_extendedprice")).alias("amount"),
            hundredths(F.col("l_quantity")).alias("units"),
            hundredths(weighed).alias("weight"),
        )
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    if by_line:
        deal = joined.repartitionByRange if by_month else joined.repartition
        joined = deal(tasks or line_parts(spark, folder), *UNIT)
    return joined.groupBy(*EXTRACT, "partner_code").agg(
        two_digits(F.sum("amount")).alias("primary_value"),
        two_digits(F.sum("weight")).alias("net_weight"),
        two_digits(F.sum("units")).alias("quantity"),
        F.max("ordered_at").alias("ordered_at"),
    )


def star_detail(cells: DataFrame) -> DataFrame:
    """Add the lineage of each extract. An extract has at most one row per nation."""
    extract = Window.partitionBy(*EXTRACT)
    name = F.concat_ws(
        "/", to_period(F.col("period_start_date")), "reporter_code", "cmd_code", "revision"
    )
    summary = F.concat_ws(
        ":",
        "source_file",
        F.count("*").over(extract).cast("string"),
        (F.sum("primary_value").over(extract) * 100).cast("decimal(38,0)").cast("string"),
    )
    stamped = (
        cells.withColumn("source_file", name)
        .withColumns(
            {
                "period": to_period(F.col("period_start_date")),
                "flow_code": F.lit(IMPORT_FLOW),
                "hs_version": F.concat(F.lit("H"), (F.col("revision") + 3).cast("string")),
                "ingested_at": F.max("ordered_at").over(extract),
                "checksum": namespaced_sha256(summary),
                "run_id": F.concat(F.lit("run-"), F.col("source_file")),
            }
        )
        .select(*RAW_COLUMNS)
    )
    return typed(stamped, RAW_SCHEMA)


def star_countries(spark: SparkSession, folder: str, by_line: bool = False) -> DataFrame:
    if by_line:  # suppliers are numbered from 1, so none has the world code
        name = F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string"))
        partners = read(spark, folder, "supplier").select("s_suppkey", name.alias("n_name"))
        key = F.col("s_suppkey").cast("int")
    else:
        partners, key = read(spark, folder, "nation"), F.col("n_nationkey")
    iso3 = F.concat(F.lit("Q"), F.format_string("%s%s", _letter(key, 26), _letter(key, 1)))
    special, group, unsure = key % 8 == 0, key % 8 == 1, key % 11 == 10
    kind = F.when(special, "special").when(group, "group").otherwise("country")
    mapped = F.when(key % 7 == 0, F.lit("")).otherwise(iso3)
    shaped = partners.select(
        key.cast("string").alias("partner_code"),
        F.col("n_name").alias("source_name"),
        F.lit("").alias("source_note"),
        iso3.alias("source_iso_alpha3"),
        group.alias("source_is_group"),
        kind.alias("partner_type"),
        F.when(unsure, "needs_review").otherwise("verified").alias("classification_status"),
        mapped.alias("map_iso3"),
        F.when(special, "unresolved").otherwise("detail").alias("reconciliation_role"),
        F.lit("star").alias("source_url"),
        F.lit("1998-08-02").alias("retrieved_at"),
        F.lit("star").alias("classification_source_url"),
        F.when(unsure, "Awaiting review").alias("classification_note"),
        F.lit("star").alias("mapping_source_url"),
        F.lit(None).cast("string").alias("mapping_note"),
    )
    return typed(shaped, COUNTRY_SCHEMA)


def _letter(key, divisor: int):
    return F.chr(F.floor(key / divisor).cast("long") % 26 + 65)


def star_hs_codes(spark: SparkSession, folder: str, by_line: bool = False) -> DataFrame:
    """Every product in editions H4 and H6; only some of them in H5."""
    product = F.col("p_partkey").cast("string") if by_line else F.col("p_type")
    types = read(spark, folder, "part").select(product.alias("cmd_code")).distinct()
    editions = types.withColumn("hs_version", F.explode(F.array(*map(F.lit, ("H4", "H5", "H6")))))
    listed = (F.col("hs_version") != "H5") | (F.length("cmd_code") % 2 == 0)
    shaped = editions.where(listed).select(
        "hs_version",
        "cmd_code",
        F.concat_ws(" ", F.initcap("cmd_code"), F.lit("parts")).alias("hs_description"),
        F.lit(6).alias("code_level"),
        F.lit("8542").alias("parent_code"),
        F.lit("star").alias("source_url"),
        F.lit("1998-08-02").alias("retrieved_at"),
    )
    return typed(shaped, HS_SCHEMA)


def star_world(detail: DataFrame, countries: DataFrame) -> DataFrame:
    """Independent totals per extract, with gaps and zeros on purpose."""
    verified = countries.where(
        (F.col("partner_type") == "country") & (F.col("classification_status") == "verified")
    ).select("partner_code", F.lit(True).alias("is_verified"))
    month = F.month("period_start_date")
    strict = F.col("reporter_code").isin("ASIA", "EUROPE")
    counted = F.when(~strict | F.col("is_verified"), F.col("primary_value"))
    lineage = ("ingested_at", "source_file", "checksum", "run_id", "hs_version", "period")
    totals = (
        detail.where(month != 7)
        .join(verified, "partner_code", "left")
        .groupBy(*EXTRACT, "flow_code", *lineage)
        .agg(F.sum(counted).alias("total"))
        .where(F.col("total").isNotNull())
    )
    zeroed = (F.col("reporter_code") == "AFRICA") & (month == 8)
    missing = F.lit(None).cast("decimal(38,9)")
    shaped = totals.withColumns(
        {
            "partner_code": F.lit(WORLD_CODE),
            "primary_value": F.when(zeroed, F.lit(0)).otherwise(F.col("total")),
            "net_weight": missing,
            "quantity": missing,
        }
    )
    return typed(shaped.select(*RAW_COLUMNS), RAW_SCHEMA)


@dataclass(frozen=True)
class Panel:
    """The panel of one data folder; each part is planned when first asked for.

    Several branches of a plan read the detail rows, so they are persisted. Their
    number is bounded by months x regions x types x nations x 3 revisions, however
    many lines were read; lost blocks are rebuilt from the tables. A panel ``by_line`` has
    about as many rows as there are lines and is not kept.
    """

    spark: SparkSession
    folder: str
    by_line: bool = False

    @cached_property
    def parts(self) -> int:
        return line_parts(self.spark, self.folder)

    @cached_property
    def detail(self) -> DataFrame:
        if self.by_line:
            return star_detail(star_cells(self.spark, self.folder, True, self.parts))
        rows = star_detail(star_cells(self.spark, self.folder))
        return rows.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def detail_by_month(self) -> DataFrame:
        """The same rows for a write by month; by line a task holds one or few months."""
        if not self.by_line:
            return self.detail
        return star_detail(star_cells(self.spark, self.folder, True, self.parts, by_month=True))

    @cached_property
    def countries(self) -> DataFrame:
        return star_countries(self.spark, self.folder, self.by_line)

    @cached_property
    def hs_codes(self) -> DataFrame:
        return star_hs_codes(self.spark, self.folder, self.by_line)

    @cached_property
    def world(self) -> DataFrame:
        return star_world(self.detail, self.countries)
