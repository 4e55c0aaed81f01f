"""Load extracts as their manifests arrive.

A manifest is written after its data, so it is the commit record to watch. Late data
needs no watermark: a newer revision of any month replaces that month's unit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthloom.params import PRODUCTS, Params
from monthloom.plans.landing import accepted, newest_extracts, parse_records, reconcile
from monthloom.plans.load import contradictions, cut_lineage, load_extracts, months_of, refresh_fact
from monthloom.schemas import RAW_SCHEMA
from monthloom.sources.landing import MANIFEST_FILE, manifests_from_text
from monthloom.sources.landing import scan_checksums, scan_lines
from monthloom.sources.raw import scan_table


def stream_manifests(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Whole manifest files with their paths."""
    reader = spark.readStream.format("text").option("wholetext", True)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", MANIFEST_FILE)
    read = reader.option("maxFilesPerTrigger", files_per_batch).load(f"{landing}/v3")
    return read.select("value", F.col("_metadata.file_path").alias("manifest_file"))


def load_batch(
    batch: DataFrame,
    tables: str,
    countries: DataFrame,
    hs_codes: DataFrame,
    params: Params,
    products: Sequence[str] = tuple(PRODUCTS),
    number: int = 0,
) -> None:
    """Check, load and publish to the fact the extracts of one batch.

    The batch is bounded by ``files_per_batch``; so is the list of its folders.
    Rejected extracts are written to ``rejected/batch=<number>`` with their reasons: a
    repeated batch writes its own again. An extract that contradicts what is stored is
    rejected like one that is unsound, and the others load; a revision that arrives after a
    newer one is passed over.
    """
    spark = batch.sparkSession
    manifests = cut_lineage(manifests_from_text(batch))
    folders = [row[0] for row in manifests.select("extract").collect()]
    if not folders:
        return
    rows = parse_records(scan_lines(spark, "", folders))
    sums = scan_checksums(spark, "", folders)
    checked = cut_lineage(reconcile(manifests, rows, sums, products, params.start))
    refused = checked.where(F.size("reasons") > 0).select("extract", "reasons")
    newest, ambiguous = newest_extracts(accepted(checked))
    doubtful = ambiguous.select("extract", F.array(F.lit("ambiguous_revision")).alias("reasons"))
    judged = contradictions(spark, tables, cut_lineage(newest))
    refused = refused.unionByName(doubtful).unionByName(judged)
    refused.write.mode("overwrite").json(f"{tables}/rejected/batch={number}")
    chosen = cut_lineage(newest.join(judged.select("extract"), "extract", "left_anti"))
    if not chosen.limit(1).count():
        return
    load_extracts(spark, tables, chosen, rows, skip_stale=True)
    months = months_of(chosen.where(F.col("kind") == "partner_detail"))
    detail = scan_table(spark, f"{tables}/partner_detail", RAW_SCHEMA)
    refresh_fact(spark, f"{tables}/fact", detail, countries, hs_codes, params, months)


def stream_extracts(
    spark: SparkSession,
    landing: str,
    tables: str,
    checkpoint: str,
    countries: DataFrame,
    hs_codes: DataFrame,
    params: Params,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start a run that works off everything that has arrived and then stops.

    A batch that is repeated after a failure finds its versions stored already.
    """

    def each(batch: DataFrame, number: int) -> None:
        load_batch(batch, tables, countries, hs_codes, params, params.products, number)

    writer = stream_manifests(spark, landing, files_per_batch).writeStream.foreachBatch(each)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
