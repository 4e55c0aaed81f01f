"""Landed extracts: NDJSON rows with one manifest each, identified by their path.

Layout: ``v3/reporter_code=/hs_version=/cmd_code=/period=/query_type=/revision=``
with ``data.ndjson`` and ``manifest.json``, or one file of each as Spark names them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.functions.text import namespaced_sha256
from monthloom.params import WORLD_CODE
from monthloom.schemas import MANIFEST_SCHEMA

# By name, or as `write_lines` and `write_manifests` leave them.
DATA_FILE = "{data.ndjson,part-*.txt}"
MANIFEST_FILE = "{manifest.json,part-*.mft}"
# Larger files are hashed line by line instead of as one row.
WHOLE_BYTES = 64 << 20
# Fixed path pattern; its parts are the identity of an extract.
PATH_PATTERN = (
    r"/v3/reporter_code=([^/]+)/hs_version=([^/]+)/cmd_code=([^/]+)"
    r"/period=([^/]+)/query_type=([^/]+)/revision=([0-9]+)/[^/]+$"
)
PATH_FIELDS = ("reporter_code", "hs_version", "cmd_code", "period", "query_type", "revision")
_ENVELOPE = "elapsedTime string, count bigint, data array<string>, error string"


def _files(spark: SparkSession, name: str) -> DataFrameReader:
    """All files of one name; folder names are identity, not table partitions."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name)


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]+$", "")


def path_identity(path: Column) -> dict[str, Column]:
    """``path_*`` columns read off the file path."""
    parts = {
        f"path_{name}": F.nullif(F.regexp_extract(path, PATH_PATTERN, place), F.lit(""))
        for place, name in enumerate(PATH_FIELDS, start=1)
    }
    parts["path_revision"] = parts["path_revision"].try_cast("bigint")
    return parts


def manifest_schema() -> T.StructType:
    return T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])


def scan_manifests(
    spark: SparkSession, root: str, paths: Sequence[str] | None = None
) -> DataFrame:
    """One row per manifest with ``extract`` (its folder) and the path identity.

    Only files below ``paths`` are listed and opened, see ``scope_paths``.
    """
    reader = _files(spark, MANIFEST_FILE).schema(manifest_schema())
    reader = reader.option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt")
    path = F.col("_metadata.file_path")
    where = list(paths) if paths is not None else f"{root}/v3"
    read = reader.json(where).withColumn("manifest_file", path)
    return _identified(read)


def scope_paths(root: str, wanted: Mapping[str, Iterable[str]]) -> list[str]:
    """One path pattern a reporter for its periods: other folders are neither listed nor opened.

    ``wanted`` holds periods by reporter; both are bounded by markets and calendar.
    """
    return [
        f"{root}/v3/reporter_code={reporter}/hs_version=*/cmd_code=*/"
        f"period={{{','.join(sorted(set(periods)))}}}/query_type=*/revision=*"
        for reporter, periods in sorted(wanted.items())
    ]


def present_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of a few path patterns that match a folder; no file is opened."""
    found = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path).schema
            found.append(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def list_folders(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(extract, data_files, manifests, bytes, modified_at) of each landed folder.

    Files are listed, not opened.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    data = name.rlike(r"^(data\.ndjson|part-.*\.txt)$")
    manifest = name.rlike(r"^(manifest\.json|part-.*\.mft)$")
    return (
        listed.select(folder_of(F.col("path")).alias("extract"), "length", "modificationTime", data.alias("d"), manifest.alias("m"))
        .where("d or m")
        .groupBy("extract")
        .agg(
            F.count_if("d").alias("data_files"),
            F.count_if("m").alias("manifests"),
            F.coalesce(F.sum(F.when(F.col("d"), F.col("length"))), F.lit(0)).alias("bytes"),
            F.max("modificationTime").alias("modified_at"),
        )
    )


def write_lines(lines: DataFrame, root: str, order: Sequence[str]) -> None:
    """Data files of extracts: ``lines`` has the path fields, ``line`` and the ``order`` columns.

    An extract is one file whose lines are in order, as its checksum is over the file.
    """
    dealt = lines.repartition(*PATH_FIELDS).sortWithinPartitions(*PATH_FIELDS, *order)
    dealt.select(*PATH_FIELDS, "line").write.mode("append").partitionBy(*PATH_FIELDS).text(f"{root}/v3")


def write_manifests(manifests: DataFrame, root: str) -> None:
    """Manifest files, one a row: to be written after the data, which they commit."""
    columns = [F.col(name).alias(f"path_{name}") for name in PATH_FIELDS]
    content = F.to_json(F.struct(*[f.name for f in MANIFEST_SCHEMA]), {"ignoreNullFields": "false"})
    shaped = manifests.select(*columns, content.alias("value"))
    shaped = shaped.withColumnsRenamed({f"path_{name}": name for name in PATH_FIELDS})
    plain = {"extension": "mft", "sep": "\u0001", "quote": "\u0000", "escape": "\u0000"}
    writer = shaped.repartition(*PATH_FIELDS).write.mode("append").options(**plain)
    writer.partitionBy(*PATH_FIELDS).csv(f"{root}/v3")


def _identified(manifests: DataFrame) -> DataFrame:
    return manifests.withColumns(
        {
            "extract": folder_of(F.col("manifest_file")),
            "reporter_code": F.col("request_parameters")["reporterCode"],
            **path_identity(F.col("manifest_file")),
        }
    )


def manifests_from_text(text: DataFrame) -> DataFrame:
    """``text`` has manifest_file and value (the file's content)."""
    parsed = F.from_json("value", manifest_schema(), {"columnNameOfCorruptRecord": "_corrupt"})
    return _identified(text.select("manifest_file", parsed.alias("m")).select("manifest_file", "m.*"))


def scan_lines(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """Non-empty data lines with the folder of their extract."""
    reader = _files(spark, DATA_FILE)
    read = reader.text(paths if paths is not None else f"{root}/v3")
    lines = read.select(
        folder_of(F.col("_metadata.file_path")).alias("extract"), F.col("value").alias("line")
    )
    return lines.where(F.trim("line") != "")


def scan_checksums(
    spark: SparkSession,
    root: str,
    paths: list[str] | None = None,
    whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """SHA-256 of the exact bytes of each data file.

    A file up to ``whole_bytes`` is hashed as one row. A larger one is never held: its lines
    are read in parallel and pass through one hash state in their order. A checksum that
    cannot be had that way (a file with a byte-order mark) is NULL and so never right.
    """
    target = paths if paths is not None else f"{root}/v3"
    files = _files(spark, DATA_FILE).format("binaryFile").load(target)
    whole = files.where(F.col("length") <= whole_bytes).select(
        folder_of(F.col("path")).alias("extract"),
        "length",
        namespaced_sha256(F.col("content")).alias("data_checksum"),
    )
    lines = _files(spark, DATA_FILE).option("lineSep", "\n").text(target)
    size = F.col("_metadata.file_size")
    placed = lines.where(size > whole_bytes).select(
        F.col("_metadata.file_path").alias("path"),
        size.alias("length"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("line"),
    )
    dealt = placed.repartition("path").sortWithinPartitions("path", "start", "at")
    hashed = dealt.mapInArrow(_line_hasher(), "path string, length long, data_checksum string")
    large = hashed.select(folder_of(F.col("path")).alias("extract"), "length", "data_checksum")
    return whole.unionByName(large)


def _line_hasher():
    """Digest of each file from its lines, which follow each other in order."""
    kind = pa.schema([("path", pa.string()), ("length", pa.int64()), ("data_checksum", pa.string())])

    def run(batches):
        path, length, seen, state = None, 0, 0, None

        def digest():
            if seen == length - 1:
                state.update(b"\n")
            exact = seen in (length, length - 1)
            return {"path": path, "length": length, "data_checksum": f"sha256:{state.hexdigest()}" if exact else None}

        for batch in batches:
            done = []
            for own, size, line in zip(*(batch.column(k) for k in (0, 1, 4)), strict=True):
                if own.as_py() != path:
                    if path is not None:
                        done.append(digest())
                    path, length, state = own.as_py(), size.as_py(), hashlib.sha256(line.as_buffer())
                    seen = len(line.as_buffer())
                else:
                    state.update(b"\n")
                    state.update(line.as_buffer())
                    seen += 1 + len(line.as_buffer())
            yield pa.RecordBatch.from_pylist(done, kind)
        if path is not None:
            yield pa.RecordBatch.from_pylist([digest()], kind)

    return run


def uncommitted(checksums: DataFrame, manifests: DataFrame) -> DataFrame:
    """Data folders without a manifest: not safe to use."""
    return checksums.join(manifests.select("extract"), "extract", "left_anti")


def unwrap_envelope(responses: DataFrame, record_cap: int, text: str = "response") -> DataFrame:
    """Responses with ``records`` (JSON texts) and ``rejected`` (NULL when usable)."""
    parsed = responses.withColumn("envelope", F.from_json(text, _ENVELOPE))
    count, size = F.col("envelope.count"), F.size("envelope.data")
    error = F.coalesce(F.col("envelope.error"), F.lit(""))
    rejected = (
        F.when(F.col("envelope").isNull() | count.isNull(), "invalid_response")
        .when(F.col("envelope.data").isNull(), "invalid_response")
        .when(error != "", "source_error")
        .when(count != size, "count_mismatch")
        .when(count >= record_cap, "truncated")
    )
    return parsed.withColumns({"records": F.col("envelope.data"), "rejected": rejected}).drop(
        "envelope"
    )


def response_rows(unwrapped: DataFrame) -> DataFrame:
    """One row per record of the usable responses."""
    usable = unwrapped.where(F.col("rejected").isNull())
    return usable.withColumn("line", F.explode("records")).drop("records", "rejected")


def split_kind(partner: Column) -> Column:
    """World rows and detail rows of one response are separate extracts."""
    return F.when(partner == WORLD_CODE, "world_total").otherwise("partner_detail")


def json_rows(frame: DataFrame, column: str, row_schema: T.StructType) -> DataFrame:
    """A JSON array column as typed rows."""
    parsed = F.from_json(column, T.ArrayType(row_schema))
    return frame.select(F.explode(parsed).alias("record")).select("record.*")
