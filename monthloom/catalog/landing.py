"""Landing contracts on source-format records that Spark writes from the panel's rows.

Some records are spoiled by rules over their own codes, so that every check fires.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.catalog.explore import plain_cents_sql
from monthloom.catalog.oracle import money
from monthloom.catalog.registry import REGIONS, TYPES, Tables, query
from monthloom.functions.text import plain_decimal
from monthloom.operators import aggregate
from monthloom.operators.revision import latest_manifests
from monthloom.plans import landing
from monthloom.sources import landing as source
from monthloom.sources.star import read

# Whole-number market codes, as the source format wants them.
CODES = {name: place * 100 for place, name in enumerate(REGIONS, start=1)}
CODE_SQL = "CASE rep " + " ".join(f"WHEN '{n}' THEN {c}" for n, c in CODES.items()) + " END"
FIRST = date(1995, 1, 1)


def market_code():
    code = F.lit(None).cast("int")
    for name, number in CODES.items():
        code = F.when(F.col("reporter_code") == name, number).otherwise(code)
    return code


def source_lines(detail: DataFrame) -> DataFrame:
    """One JSON record per row, with its extract and a spoiled field here and there."""
    partner, revision = F.col("partner_code"), F.col("revision")
    record = F.struct(
        F.lit("M").alias("freqCode"),
        F.when((partner == "7") & (revision == 1), "X").otherwise("M").alias("flowCode"),
        F.lit(0).alias("partner2Code"),
        F.when((partner == "11") & (revision == 2), "C01").otherwise("C00").alias("customsCode"),
        F.lit(0).alias("motCode"),
        (~((partner == "5") & (revision == 3))).alias("isOriginalClassification"),
        partner.cast("int").alias("partnerCode"),
        F.when((partner == "9") & (revision == 1), F.concat(plain_decimal(F.col("primary_value")), F.lit("e0")))
        .otherwise(plain_decimal(F.col("primary_value")))
        .alias("primaryValue"),
        plain_decimal(F.col("net_weight")).alias("netWgt"),
        plain_decimal(F.col("quantity")).alias("qty"),
        "period",
        market_code().alias("reporterCode"),
        F.col("cmd_code").alias("cmdCode"),
        F.col("hs_version").alias("classificationCode"),
    )
    line = F.to_json(record, {"ignoreNullFields": "false"})
    # JSON numbers, not strings, are what the amount rule has to refuse as well.
    numeric = F.regexp_replace(line, r'"primaryValue":"([0-9.]+)"', r'"primaryValue":$1')
    spoiled = F.when((partner == "13") & (revision == 2), numeric).otherwise(line)
    return detail.select(F.col("source_file").alias("extract"), spoiled.alias("line"))


BAD_SQL = """(par = '7' AND rev = 1) OR (par = '11' AND rev = 2) OR (par = '5' AND rev = 3)
  OR (par = '9' AND rev = 1) OR (par = '13' AND rev = 2)"""


@query(
    "landing_row_reasons",
    """SELECT reason, count(*) AS rows FROM (
  SELECT 'flow' AS reason FROM t_detail WHERE par = '7' AND rev = 1
  UNION ALL SELECT 'customs' FROM t_detail WHERE par = '11' AND rev = 2
  UNION ALL SELECT 'original_classification' FROM t_detail WHERE par = '5' AND rev = 3
  UNION ALL SELECT 'amount' FROM t_detail WHERE (par = '9' AND rev = 1) OR (par = '13' AND rev = 2)
) GROUP BY reason""",
)
def landing_row_reasons(t: Tables):
    """Records that break a fixed field, the edition flag or the amount format."""
    parsed = landing.parse_records(source_lines(t.panel.detail))
    return parsed.select(F.explode("row_reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("rows")
    )


@query(
    "landing_records",
    f"""SELECT src AS extract, period, CAST({CODE_SQL} AS VARCHAR) AS reporter_code,
  par AS partner_code, cmd AS cmd_code, hs AS hs_version,
  CASE WHEN NOT ((par = '9' AND rev = 1) OR (par = '13' AND rev = 2))
    THEN CAST(v AS DOUBLE) / 100 END AS primary_value,
  CAST(w AS DOUBLE) AS net_weight, CAST(q AS DOUBLE) AS quantity FROM t_detail""",
)
def landing_records(t: Tables):
    parsed = landing.parse_records(source_lines(t.panel.detail))
    return parsed.drop("row_reasons", "flow_code")


@query(
    "landing_extract_facts",
    f"""SELECT src AS extract, count(*) AS rows,
  CAST(sum(CASE WHEN NOT ((par = '9' AND rev = 1) OR (par = '13' AND rev = 2)) THEN v END)
    AS DOUBLE) / 100 AS amount,
  count(*) FILTER ({BAD_SQL}) AS bad_rows, count(DISTINCT par) AS partners,
  count(DISTINCT hs) AS editions, count(*) FILTER (par = '0') AS world_rows
FROM t_detail GROUP BY src""",
)
def landing_extract_facts(t: Tables):
    return landing.extract_facts(landing.parse_records(source_lines(t.panel.detail)))


@query(
    "landing_split",
    """SELECT kind, count(*) AS rows, count(DISTINCT period) AS periods FROM (
  SELECT CASE WHEN par = '0' THEN 'world_total' ELSE 'partner_detail' END AS kind, period
  FROM t_detail UNION ALL SELECT 'world_total', period FROM t_world) GROUP BY kind""",
)
def landing_split(t: Tables):
    """World and partner records of one response go to separate extracts."""
    both = t.panel.detail.unionByName(t.panel.world)
    kind = source.split_kind(F.col("partner_code")).alias("kind")
    return both.select(kind, "period").groupBy("kind").agg(
        F.count("*").alias("rows"), F.count_distinct("period").alias("periods")
    )


@query(
    "landing_unrequested",
    """SELECT rep AS reporter_code, count(*) AS rows FROM t_detail
WHERE rep NOT IN (SELECT r_name FROM region WHERE r_regionkey % 2 = 0) GROUP BY rep""",
)
def landing_unrequested(t: Tables):
    """Rows of reporters that the request did not name."""
    asked = source_regions(t).where(F.col("r_regionkey") % 2 == 0)
    requested = asked.select(F.col("r_name").alias("reporter_code"))
    extra = landing.unrequested(t.panel.detail, requested)
    return extra.groupBy("reporter_code").agg(F.count("*").alias("rows"))


def source_regions(t: Tables) -> DataFrame:
    return read(t.spark, t.folder, "region")


EXTRACT_KEY = ("period", "reporter_code", "cmd_code", "revision")


@query(
    "edition_splits",
    """SELECT period, rep AS reporter_code, cmd AS cmd_code, count(*) AS rows,
  count(DISTINCT hs) AS editions FROM t_detail GROUP BY period, rep, cmd
HAVING count(DISTINCT hs) <> 1""",
)
def edition_splits(t: Tables):
    """Months of a market and product in which several editions are stored."""
    rows = t.panel.detail.withColumn("row_reasons", F.array().cast("array<string>"))
    facts = landing.extract_facts(rows, ("period", "reporter_code", "cmd_code"))
    found = landing.edition_splits(facts)
    return found.select("period", "reporter_code", "cmd_code", "rows", "editions")


def responses(t: Tables) -> DataFrame:
    """One response per month, market and product: at most 3 x 25 records each."""
    key = ("period", "reporter_code", "cmd_code")
    lines = t.panel.detail.select(*key, F.to_json(F.struct("partner_code", "revision")).alias("r"))
    listed = lines.groupBy(*key).agg(
        F.count("*").alias("n"), F.array_join(F.collect_list("r"), ",").alias("data")
    )
    count = F.when(F.col("cmd_code") == "PROMO", F.col("n") + 1).otherwise(F.col("n"))
    error = F.when(F.col("reporter_code") == "EUROPE", "rate limit").otherwise("")
    text = F.concat(
        F.lit('{"count":'), count.cast("string"),
        F.lit(',"data":['), "data", F.lit('],"error":"'), error, F.lit('"}'),
    )
    broken = F.when(F.col("cmd_code") == "SMALL", F.substring(text, 1, 9)).otherwise(text)
    return listed.select(*key, broken.alias("response"))


RESPONSE_SQL = """SELECT period, rep, cmd, count(*) AS n, CASE WHEN cmd = 'SMALL' THEN 'invalid_response'
  WHEN rep = 'EUROPE' THEN 'source_error' WHEN cmd = 'PROMO' THEN 'count_mismatch'
  WHEN count(*) >= 21 THEN 'truncated' END AS rejected
FROM t_detail GROUP BY period, rep, cmd"""


@query(
    "envelope_unwrap",
    f"""SELECT coalesce(rejected, 'usable') AS outcome, count(*) AS responses
FROM ({RESPONSE_SQL}) GROUP BY ALL""",
)
def envelope_unwrap(t: Tables):
    """Responses that carry an error, miscount, are cut at the record cap or cannot be read."""
    outcome = F.coalesce("rejected", F.lit("usable")).alias("outcome")
    return source.unwrap_envelope(responses(t), 21).select(outcome).groupBy("outcome").agg(
        F.count("*").alias("responses")
    )


@query(
    "envelope_rows",
    f"""SELECT d.period, d.rep AS reporter_code, d.cmd AS cmd_code, d.par AS partner_code,
  d.rev AS revision FROM t_detail d JOIN ({RESPONSE_SQL}) r USING (period, rep, cmd)
WHERE r.rejected IS NULL""",
)
def envelope_rows(t: Tables):
    rows = source.response_rows(source.unwrap_envelope(responses(t), 21))
    parsed = F.from_json("line", "partner_code string, revision bigint").alias("r")
    return rows.select("period", "reporter_code", "cmd_code", parsed).select(
        "period", "reporter_code", "cmd_code", "r.partner_code", "r.revision"
    )


def manifests(t: Tables) -> DataFrame:
    """One manifest per stored extract; some contradict their rows, path or request."""
    rows = t.panel.detail.where(F.col("partner_code") != "0")
    facts = rows.groupBy(*EXTRACT_KEY, "hs_version", "checksum", "source_file", "ingested_at").agg(
        F.count("*").alias("n"), F.sum("primary_value").cast("decimal(38,9)").alias("total")
    )
    product, revision = F.col("cmd_code"), F.col("revision")
    code = market_code().cast("string")
    off = F.when((product == "PROMO") & (revision == 1), 1).otherwise(0)
    more = F.when((product == "SMALL") & (revision == 2), F.lit("0.01")).otherwise(F.lit("0"))
    flow = F.when((product == "LARGE") & (revision == 3), "X").otherwise("M")
    wrong_path = (product == "ECONOMY") & (revision == 1)
    request = F.create_map(
        *[
            part
            for name, value in (
                ("reporterCode", code),
                ("period", F.col("period")),
                ("cmdCode", product),
                ("flowCode", flow),
                ("partner2Code", F.lit("0")),
                ("customsCode", F.lit("C00")),
                ("motCode", F.lit("0")),
            )
            for part in (F.lit(name), value)
        ]
    )
    folder = F.concat(
        F.lit("file:/v3/reporter_code="), code,
        F.lit("/hs_version="), "hs_version",
        F.lit("/cmd_code="), product,
        F.lit("/period="), "period",
        F.lit("/query_type=partner_detail/revision="),
        F.when(wrong_path, revision + 1).otherwise(revision).cast("string"),
    )
    text = F.to_json(
        F.struct(
            request.alias("request_parameters"),
            "checksum",
            F.lit("2.0.0").alias("schema_version"),
            "hs_version",
            "period",
            F.lit("partner_detail").alias("query_type"),
            "cmd_code",
            "revision",
            (F.col("n") + off).alias("row_count"),
            plain_decimal(F.col("total") + more.cast("decimal(10,9)")).alias("primary_value_sum"),
            F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingested_at"),
            F.lit("star").alias("source"),
        )
    )
    files = facts.select(
        F.concat(folder, F.lit("/manifest.json")).alias("manifest_file"),
        text.alias("value"),
        "source_file",
        F.col("checksum").alias("data_checksum"),
    )
    read = source.manifests_from_text(files.select("manifest_file", "value"))
    kept = files.select("manifest_file", "source_file", "data_checksum")
    # The star's extracts are named by their source file, not by a folder.
    named = read.join(kept, "manifest_file").drop("extract")
    return named.withColumnRenamed("source_file", "extract")


def reconciled(t: Tables) -> DataFrame:
    found = manifests(t)
    sums = found.select("extract", "data_checksum")
    detail = t.panel.detail.where(F.col("partner_code") != "0")
    rows = landing.parse_records(source_lines(detail))
    return landing.reconcile(found.drop("data_checksum"), rows, sums, TYPES, FIRST)


RECONCILED_SQL = f"""SELECT src, period, rep, cmd, rev, hs, n, v,
  CAST(list_filter([CASE WHEN cmd = 'ECONOMY' AND rev = 1 THEN 'path_identity' END,
    CASE WHEN cmd = 'LARGE' AND rev = 3 THEN 'request_identity' END,
    CASE WHEN cmd = 'PROMO' AND rev = 1 THEN 'row_count' END,
    CASE WHEN unread > 0 OR (cmd = 'SMALL' AND rev = 2) THEN 'amount_sum' END,
    CASE WHEN bad > 0 THEN 'rows' END], lambda x: x IS NOT NULL) AS VARCHAR[]) AS reasons
FROM (SELECT src, period, rep, cmd, rev, hs, count(*) AS n, CAST(sum(v) AS BIGINT) AS v,
    count(*) FILTER ({BAD_SQL}) AS bad,
    count(*) FILTER ((par = '9' AND rev = 1) OR (par = '13' AND rev = 2)) AS unread
  FROM t_detail WHERE par <> '0' GROUP BY ALL)"""


@query(
    "reconcile_manifests",
    f"""SELECT reason, count(*) AS extracts FROM (
  SELECT unnest(reasons) AS reason FROM ({RECONCILED_SQL})) GROUP BY reason""",
)
def reconcile_manifests(t: Tables):
    """Extracts per reason that keeps them from loading."""
    return reconciled(t).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("extracts")
    )


@query(
    "accepted_extracts",
    f"""SELECT src AS extract, 'partner_detail' AS kind, CAST({CODE_SQL} AS VARCHAR) AS reporter_code,
  cmd AS cmd_code, hs AS hs_version, period, rev AS revision, n AS row_count,
  {money("v", "primary_value_sum")} FROM ({RECONCILED_SQL}) WHERE len(reasons) = 0""",
)
def accepted_extracts(t: Tables):
    return landing.accepted(reconciled(t)).select(
        "extract",
        "kind",
        "reporter_code",
        "cmd_code",
        "hs_version",
        "period",
        "revision",
        "row_count",
        "primary_value_sum",
    )


@query(
    "extract_manifest_counts",
    f"""SELECT period, rep AS reporter_code, cmd AS cmd_code, rev AS revision, n AS row_count,
  {money("total", "primary_value_sum")} FROM t_extracts""",
)
def extract_manifest_counts(t: Tables):
    line = F.concat_ws("|", "partner_code", plain_decimal(F.col("primary_value")))
    found = aggregate.extract_summary(t.panel.detail, EXTRACT_KEY, "primary_value", line)
    return found.drop("content_digest")


def _lane(place: int) -> str:
    return f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * place}, 15) AS HUGEINT)) AS VARCHAR)"


@query(
    "extract_digest",
    f"""SELECT period, rep AS reporter_code, cmd AS cmd_code, rev AS revision, 'sha256:' ||
  sha256(count(*) || ':' || {" || ':' || ".join(_lane(i) for i in range(4))}) AS content_digest
FROM (SELECT *, sha256(par || '|' || hs || '|' || src || '|' || {plain_cents_sql("v")}) AS h FROM t_detail)
GROUP BY period, rep, cmd, rev""",
)
def extract_digest(t: Tables):
    """Order-free content digest of each extract, summed over its lines."""
    line = F.concat_ws("|", "partner_code", "hs_version", "source_file", plain_decimal(F.col("primary_value")))
    found = aggregate.extract_summary(t.panel.detail, EXTRACT_KEY, "primary_value", line)
    return found.drop("row_count", "primary_value_sum")


@query(
    "extract_canonical_text",
    f"""SELECT period, rep AS reporter_code, cmd AS cmd_code, rev AS revision,
  count(*) AS row_count, CAST(sum(v) AS DOUBLE) / 100 AS primary_value_sum,
  'sha256:' || sha256(string_agg('{{"cmd_code":"' || cmd || '","hs_version":"' || hs ||
    '","partner_code":"' || par || '","period":"' || period || '"}}', chr(10)
    ORDER BY CAST(par AS BIGINT)) || chr(10)) AS checksum
FROM t_detail GROUP BY period, rep, cmd, rev""",
)
def extract_canonical_text(t: Tables):
    """Checksum of each extract's sorted canonical lines."""
    columns = ("period", "partner_code", "cmd_code", "hs_version")
    return landing.serialize_extracts(t.panel.detail, EXTRACT_KEY, columns).drop("data")


@query(
    "path_identity",
    """SELECT period AS path_period, hs AS path_hs_version, cmd AS path_cmd_code,
  rev AS path_revision, 'partner_detail' AS path_query_type, count(*) AS extracts
FROM t_extracts GROUP BY ALL""",
)
def path_identity(t: Tables):
    """Identities read off file paths."""
    key = ("hs_version", "cmd_code", "period")
    parts = F.concat_ws("/", *[F.concat(F.lit(f"{n}="), n) for n in key])
    path = F.concat(
        F.lit("s3://any/v3/reporter_code="), market_code().cast("string"), F.lit("/"), parts,
        F.lit("/query_type=partner_detail/revision="), F.col("revision").cast("string"),
        F.lit("/data.ndjson"),
    )
    paths = t.panel.detail.select(path.alias("path"))
    if t.by_line:  # as many parts as lines ask for: a task's paths do not grow with the table
        paths = paths.repartition(t.panel.parts, "path")
    found = paths.distinct()
    read = found.select(*[c.alias(n) for n, c in source.path_identity(F.col("path")).items()])
    kept = [c for c in read.columns if c != "path_reporter_code"]
    if t.by_line:
        read = read.repartition(t.panel.parts, *kept)
    return read.groupBy(*kept).agg(
        F.count("*").alias("extracts")
    )


@query(
    "latest_manifests",
    """SELECT rep AS reporter_code, cmd AS cmd_code, period, 'partner_detail' AS query_type,
  max(rev) AS revision, arg_max(chk, rev) AS checksum, CAST(1 AS BIGINT) AS copies
FROM t_extracts GROUP BY rep, cmd, period""",
)
def latest(t: Tables):
    stored = t.panel.detail.select(
        "reporter_code",
        "cmd_code",
        "period",
        F.lit("partner_detail").alias("query_type"),
        "revision",
        "checksum",
    ).distinct()
    return latest_manifests(stored)
