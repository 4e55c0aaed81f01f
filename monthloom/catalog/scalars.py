"""Column functions over the panel's rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.catalog.marts import PARTNER_SQL
from monthloom.catalog.oracle import cut, cut_growth, iso, money, ratio
from monthloom.catalog.registry import Tables, query
from monthloom.functions import calendar, ratios, status, text
from monthloom.plans.publish import typed_rows
from monthloom.sources.landing import json_rows
from monthloom.sources.snapshot import to_wire
from monthloom.schemas import PARTNER_COLUMNS, PARTNER_SCHEMA, RAW_SCHEMA

CELL_SQL = "period, rep AS reporter_code, cmd AS cmd_code, par AS partner_code, rev AS revision"
CELL = ("period", "reporter_code", "cmd_code", "partner_code", "revision")


@query(
    "scalar_ratios",
    f"""SELECT {CELL_SQL},
  CAST({ratio("v", "(q * 100)")} AS DOUBLE) / 1e9 AS rounded,
  CAST({cut("v", "(q * 100)")} AS DOUBLE) / 1e9 AS truncated,
  CAST({cut_growth("v", "(q * 100)")} AS DOUBLE) / 1e9 AS truncated_growth,
  CAST(({ratio("v", "(q * 100)")}) - 1000000000 AS DOUBLE) / 1e9 AS growth,
  CAST({ratio("v", "(w * 100)")} AS DOUBLE) / 1e9 AS unit_value,
  CAST(NULL AS DOUBLE) AS by_zero FROM t_detail""",
)
def scalar_ratios(t: Tables):
    value, quantity = F.col("primary_value"), F.col("quantity")
    return t.panel.detail.select(
        *CELL,
        ratios.safe_divide(value, quantity).alias("rounded"),
        ratios.trunc_share(value, quantity).alias("truncated"),
        ratios.trunc_growth(value, quantity).alias("truncated_growth"),
        ratios.growth(value, quantity).alias("growth"),
        ratios.unit_value(value, F.col("net_weight")).alias("unit_value"),
        ratios.safe_divide(value, value - value).alias("by_zero"),
    )


def _digits(cents: str) -> str:
    return (
        f"CASE WHEN {cents} % 100 = 0 THEN '' WHEN {cents} % 10 = 0 THEN '.' || ({cents} % 100) // 10"
        f" ELSE '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0') END"
    )


def _compact(limit: int, unit: str) -> str:
    shown = f"((2 * v + {limit}) // (2 * {limit}))"
    return f"CAST({shown} // 100 AS VARCHAR) || ({_digits(shown)}) || '{unit}'"


@query(
    "display_text",
    f"""SELECT {CELL_SQL}, CAST(v // 100 AS VARCHAR) || ({_digits("v")}) AS plain,
  format('{{:,}}', v // 100) || ({_digits("v")}) AS amount,
  CASE WHEN v >= 99999950000 THEN {_compact(1000000000, "B")}
    WHEN v >= 99999950 THEN {_compact(1000000, "M")}
    WHEN v >= 99999.95 THEN {_compact(1000, "K")}
    ELSE CAST(v // 100 AS VARCHAR) || ({_digits("v")}) END AS compact,
  CASE WHEN w IS NULL THEN '資料不足' ELSE CAST(w AS VARCHAR) END AS weight,
  '''=' || rep AS guarded, strftime(m, '%Y.%m') AS month_label, strftime(m, '%Y') AS year_label
FROM t_detail""",
)
def display_text(t: Tables):
    value, month = F.col("primary_value"), F.col("period_start_date")
    return t.panel.detail.select(
        *CELL,
        text.plain_decimal(value).alias("plain"),
        text.amount_text(value).alias("amount"),
        text.compact_amount_text(value).alias("compact"),
        text.amount_text(F.col("net_weight")).alias("weight"),
        text.csv_cell(F.concat(F.lit("="), "reporter_code")).alias("guarded"),
        calendar.month_label(month).alias("month_label"),
        calendar.year_label(month).alias("year_label"),
    )


@query(
    "percent_text",
    """SELECT strftime(m, '%Y-%m-%d') AS month, rep AS reporter_code, cmd AS cmd_code,
  par AS partner_code, CASE WHEN share IS NULL THEN '資料不足'
    WHEN floor(y * 8) = y * 8 THEN printf('%.2f%%', floor(y * 100 + 0.5) / 100)
    ELSE printf('%.2f%%', y) END AS share_text
FROM (SELECT *, CAST(share AS DOUBLE) / 1e9 * 100 AS y FROM t_partners)""",
)
def percent_text(t: Tables):
    shown = text.percent_text(F.col("market_share")).alias("share_text")
    return t.multi.partners.select("month", "reporter_code", "cmd_code", "partner_code", shown)


VARIANTS = ("{}", " {}", "{}e0", "+{}", "{}00000000", "{}.5", "-{}", "{}00000001", "{}x")


@query(
    "numeric_parse",
    """WITH x AS (SELECT i, CASE i WHEN 0 THEN p WHEN 1 THEN ' ' || p WHEN 2 THEN p || 'e0'
    WHEN 3 THEN '+' || p WHEN 4 THEN p || '00000000' WHEN 5 THEN p || '.5' WHEN 6 THEN '-' || p
    WHEN 7 THEN p || '00000001' ELSE p || 'x' END AS s
  FROM (SELECT printf('%d.%02d', v // 100, v % 100) AS p FROM t_detail),
    (SELECT unnest(range(0, 9)) AS i)),
y AS (SELECT i, s, regexp_full_match(s, '-?[0-9]+(\\.[0-9]+)?') AS ok FROM x)
SELECT CAST(i AS INTEGER) AS variant, count(*) AS texts,
  count(*) FILTER (ok AND NOT regexp_matches(s, '\\.[0-9]{9}[0-9]*[1-9]')) AS parsed,
  count(*) FILTER (regexp_full_match(s, '-?[0-9]+(\\.[0-9]{1,9})?')) AS parsed_nine,
  CAST(sum(CASE WHEN ok AND NOT regexp_matches(s, '\\.[0-9]{9}[0-9]*[1-9]')
    THEN CAST(regexp_extract(s, '^-?[0-9]+\\.[0-9]{2}') AS DECIMAL(18,2)) END) AS DOUBLE) AS total
FROM y GROUP BY i""",
)
def numeric_parse(t: Tables):
    """Spellings of every amount: which the strict readings take, and their sum."""
    base = F.col("primary_value").cast("decimal(18,2)").cast("string")
    spelled = F.array(*[F.format_string(v.replace("{}", "%s"), base) for v in VARIANTS])
    texts = t.panel.detail.select(F.posexplode(spelled).alias("variant", "s"))
    parsed = text.parse_decimal(F.col("s"))
    return texts.groupBy("variant").agg(
        F.count("*").alias("texts"),
        F.count(parsed).alias("parsed"),
        F.count(text.parse_decimal_nine(F.col("s"))).alias("parsed_nine"),
        F.sum(parsed).alias("total"),
    )


@query(
    "calendar_functions",
    f"""SELECT DISTINCT {iso("m", "month")}, period, {iso("m + INTERVAL 1 MONTH", "next_month")},
  {iso("m - INTERVAL 1 YEAR", "last_year")}, {iso("last_day(m)", "month_end")},
  CAST(year(m) * 12 + month(m) AS INTEGER) AS month_index, true AS valid,
  false AS valid_month_13, false AS valid_short, m >= DATE '1998-01-01' AS valid_late
FROM t_detail""",
)
def calendar_functions(t: Tables):
    month, period = F.col("period_start_date"), F.col("period")
    early, late = date(1995, 1, 1), date(1998, 1, 1)
    return t.panel.detail.select(
        month.alias("month"),
        "period",
        calendar.shift_month(month, 1).alias("next_month"),
        calendar.shift_month(month, -12).alias("last_year"),
        F.last_day(month).alias("month_end"),
        calendar.month_index(month).alias("month_index"),
        calendar.valid_period(period, early).alias("valid"),
        calendar.valid_period(F.concat(F.substring(period, 1, 4), F.lit("13")), early).alias(
            "valid_month_13"
        ),
        calendar.valid_period(F.substring(period, 1, 5), early).alias("valid_short"),
        calendar.valid_period(period, late).alias("valid_late"),
    ).distinct()


@query(
    "json_rows",
    f"""SELECT {CELL_SQL}, {money("v", "primary_value")}, {iso("m", "period_start_date")}
FROM t_detail""",
)
def json_round_trip(t: Tables):
    """Rows as JSON text and back through the declared types."""
    texts = t.panel.detail.select(
        F.to_json(F.array(F.struct(*CELL, "period_start_date", "primary_value"))).alias("rows")
    )
    wanted = T.StructType([RAW_SCHEMA[n] for n in (*CELL, "period_start_date", "primary_value")])
    return json_rows(texts, "rows", wanted)


@query("packed_rows", f"SELECT {PARTNER_SQL} FROM t_partners")
def packed_rows(t: Tables):
    """Partner rows packed into cells and unpacked by column order, amounts included."""
    wire = to_wire(t.multi.partners, PARTNER_SCHEMA)
    unpacked = text.unpack_rows(text.pack_rows(wire, PARTNER_COLUMNS), PARTNER_COLUMNS)
    return typed_rows(unpacked, PARTNER_SCHEMA)


@query(
    "amount_bands",
    """SELECT CASE WHEN v IS NULL THEN 'no_data' WHEN v = 0 THEN 'zero'
    WHEN v < 100000000 THEN 'band_0' WHEN v < 1000000000 THEN 'band_1'
    WHEN v < 10000000000 THEN 'band_2' WHEN v < 100000000000 THEN 'band_3'
    ELSE 'band_4' END AS band, count(*) AS months
FROM (SELECT world AS v FROM t_monthly) GROUP BY ALL""",
)
def amount_bands(t: Tables):
    banded = t.multi.monthly.select(status.band_amount(F.col("world_value")).alias("band"))
    return banded.groupBy("band").agg(F.count("*").alias("months"))


@query(
    "code_rules",
    """SELECT count(*) AS partners, count(*) FILTER (map3 IS NOT NULL) AS mapped,
  count(*) AS valid_codes, CAST(0 AS BIGINT) AS valid_padded,
  count(*) FILTER (regexp_full_match(name, '[A-Za-z0-9_-]{1,128}')) AS run_names FROM t_country""",
)
def code_rules(t: Tables):
    padded = F.concat(F.lit(" "), "partner_code")
    return t.countries.agg(
        F.count("*").alias("partners"),
        F.count_if(text.valid_iso3(F.col("map_iso3"))).alias("mapped"),
        F.count_if(text.valid_code(F.col("partner_code"))).alias("valid_codes"),
        F.count_if(text.valid_code(padded)).alias("valid_padded"),
        F.count_if(text.valid_run_id(F.col("source_name"))).alias("run_names"),
    )
