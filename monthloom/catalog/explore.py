"""Interactive analysis over all markets and all products of the panel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from monthloom.catalog.oracle import cut, cut_growth, iso, money, nano
from monthloom.catalog.marts import PARTNER_SQL
from monthloom.catalog.registry import REGIONS, START, TYPES, Tables, query
from monthloom.operators import aggregate, rank
from monthloom.operators.dimensions import with_label
from monthloom.operators.sets import common_months as months_in_all
from monthloom.plans import explore

LAST = date(2001, 10, 1)
ALL = "+".join(TYPES)
PARTNER = "12"


def scoped(t: Tables):
    return (
        explore.scope_monthly(t.multi.monthly, TYPES),
        explore.scope_partners(t.multi.monthly, t.multi.partners, TYPES),
    )


def analysis(t: Tables, countries: tuple[str, ...] = (), n: int = 10, by=("reporter_code",)):
    monthly, partners = scoped(t)
    return explore.Analysis(monthly, partners, START, LAST, countries, n, by)


def geometry(t: Tables):
    """Drawn countries: every nation code but one in six."""
    drawn = F.substring("source_iso_alpha3", 3, 1).isin("C", "I", "O", "U")
    return t.countries.where(~drawn).select(F.col("source_iso_alpha3").alias("iso3"))


GEOMETRY_SQL = "SELECT iso3 FROM t_country WHERE iso3[3] NOT IN ('C', 'I', 'O', 'U')"


@query(
    "market_scope_monthly",
    f"""SELECT {iso("m", "month")}, rep AS reporter_code, '{ALL}' AS cmd_code,
  {money("world", "world_value")}, {nano("yoy", "world_yoy")}, world IS NOT NULL AS has_world,
  has_countries FROM (SELECT *, {cut_growth("world", "pworld")} AS yoy FROM t_sm)""",
)
def market_scope_monthly(t: Tables):
    return scoped(t)[0]


SCOPED_SQL = ", ".join(
    [
        iso("m", "month"),
        f"rep AS reporter_code, '{ALL}' AS cmd_code, hs AS hs_version, par AS partner_code",
        "name AS source_name, map3 AS map_iso3",
        money("v", "import_value"),
        f"CAST({cut('v', 'world')} AS DOUBLE) / 1e9 AS market_share",
        "status AS market_share_status",
        money("pmv", "previous_month_value"),
        money("pyv", "previous_year_value"),
        f"CAST({cut_growth('v', 'pmv')} AS DOUBLE) / 1e9 AS mom",
        f"CAST({cut_growth('v', 'pyv')} AS DOUBLE) / 1e9 AS yoy",
    ]
)


@query("market_scope_partners", f"SELECT {SCOPED_SQL} FROM t_sp")
def market_scope_partners(t: Tables):
    return scoped(t)[1]


PAIR = ("LARGE", "ECONOMY")
PAIR_SQL = SCOPED_SQL.replace(f"'{ALL}'", "'LARGE+ECONOMY'")


def pair_partners(t: Tables):
    return explore.scope_partners(t.multi.monthly, t.multi.partners, PAIR)


@query("market_scope_pair", f"SELECT {PAIR_SQL} FROM t_pair_growth")
def market_scope_pair(t: Tables):
    """Two products as one series, in the order they were asked for."""
    return pair_partners(t)


RANGE = "m BETWEEN DATE '1995-01-01' AND DATE '2001-10-01'"


@query(
    "period_totals",
    f"""SELECT rep AS reporter_code, {money("w", "world")}, {money("v", "selected")},
  wm AS world_months, ms AS months,
  CAST({cut("v", "w")} AS DOUBLE) / 1e9 AS selected_share
FROM (SELECT rep, CAST(sum(world) AS BIGINT) AS w, count(world) AS wm, count(*) AS ms
  FROM t_sm WHERE {RANGE} GROUP BY rep)
LEFT JOIN (SELECT rep, CAST(sum(v) AS BIGINT) AS v FROM t_sp WHERE {RANGE} GROUP BY rep)
USING (rep)""",
)
def period_totals(t: Tables):
    return analysis(t).totals


@query(
    "selected_share",
    f"""SELECT {money("w", "world")}, {money("v", "selected")}, wm AS world_months, ms AS months,
  CAST({cut("v", "w")} AS DOUBLE) / 1e9 AS selected_share
FROM (SELECT CAST(sum(world) AS BIGINT) AS w, count(world) AS wm, count(*) AS ms
  FROM t_sm WHERE {RANGE}),
(SELECT CAST(sum(v) AS BIGINT) AS v FROM t_sp WHERE {RANGE} AND par IN ('3', '12', '19'))""",
)
def selected_share(t: Tables):
    """Three selected partners against the undiminished world of all markets."""
    return analysis(t, ("3", "12", "19"), by=()).totals


RANK_SQL = f"""SELECT rep, par, min(name) AS name, min(map3) AS map3, CAST(sum(v) AS BIGINT) AS v
FROM t_sp WHERE {RANGE} GROUP BY rep, par"""


@query(
    "ranking_all",
    f"""SELECT rep AS reporter_code, par AS partner_code, name, map3 AS map_iso3,
  {money("v", "value")} FROM ({RANK_SQL})""",
)
def ranking_all(t: Tables):
    return analysis(t).rankings


@query(
    "ranking_topn",
    f"""SELECT par AS partner_code, min(name) AS name, min(map3) AS map_iso3,
  CAST(sum(v) AS DOUBLE) / 100 AS value,
  CAST(row_number() OVER (ORDER BY sum(v) DESC, par) AS INTEGER) AS rank
FROM t_sp WHERE {RANGE} GROUP BY par ORDER BY sum(v) DESC, par LIMIT 10""",
)
def ranking_topn(t: Tables):
    """Top ten partners over all markets together."""
    return analysis(t, by=()).top


@query(
    "ranking_share",
    f"""WITH r AS ({RANK_SQL}), p AS (SELECT *, CAST(row_number() OVER
  (PARTITION BY rep ORDER BY v DESC, par) AS INTEGER) AS k FROM r),
w AS (SELECT rep, CAST(sum(world) AS BIGINT) AS w FROM t_sm WHERE {RANGE} GROUP BY rep)
SELECT rep AS reporter_code, par AS partner_code, name, map3 AS map_iso3, {money("v", "value")},
  k AS rank, {money("w", "world")}, CAST({cut("v", "w")} AS DOUBLE) / 1e9 AS world_share
FROM p LEFT JOIN w USING (rep) WHERE k <= 5""",
)
def ranking_share(t: Tables):
    """Top five partners per market with their share of its period world total."""
    return analysis(t, n=5).ranking_table


TREND_SQL = f"""SELECT s.rep, s.m, p.v FROM (SELECT rep, m FROM t_sm WHERE {RANGE}) s
LEFT JOIN (SELECT rep, m, CAST(sum(v) AS BIGINT) AS v FROM t_sp GROUP BY rep, m) p USING (rep, m)"""


@query(
    "trend_by_month",
    f"""SELECT rep AS reporter_code, {iso("m", "month")}, {money("v", "value")}
FROM ({TREND_SQL})""",
)
def trend_by_month(t: Tables):
    return analysis(t).trend


@query(
    "trend_segments",
    f"""WITH x AS (SELECT s.rep, s.m, p.v FROM (SELECT rep, m FROM t_sm WHERE {RANGE}) s
  JOIN (SELECT rep, m, CAST(sum(v) AS BIGINT) AS v FROM t_sp WHERE par = '{PARTNER}'
    GROUP BY rep, m) p USING (rep, m))
SELECT rep AS reporter_code, strftime(m, '%Y-%m-%d') AS month, CAST(v AS DOUBLE) / 100 AS value,
  dense_rank() OVER (PARTITION BY rep ORDER BY island) AS segment
FROM (SELECT *, year(m) * 12 + month(m) - row_number() OVER (PARTITION BY rep ORDER BY m) AS island
  FROM x)""",
)
def trend_segments(t: Tables):
    return analysis(t, (PARTNER,)).trend_segments


@query(
    "yoy_series_world",
    f"""SELECT rep AS reporter_code, {iso("m", "month")},
  CAST({cut_growth("world", "pworld")} AS DOUBLE) / 1e9 AS value, 'World YoY' AS label
FROM t_sm WHERE {RANGE}""",
)
def yoy_series_world(t: Tables):
    return analysis(t, ("3", "12")).yoy


@query(
    "yoy_series_partner",
    f"""SELECT s.rep AS reporter_code, {iso("s.m", "month")},
  CAST({cut_growth("p.v", "p.pyv")} AS DOUBLE) / 1e9 AS value, 'NATION_{PARTNER} YoY' AS label
FROM (SELECT rep, m FROM t_sm WHERE {RANGE}) s
LEFT JOIN t_sp p ON p.rep = s.rep AND p.m = s.m AND p.par = '{PARTNER}'""",
)
def yoy_series_partner(t: Tables):
    return analysis(t, (PARTNER,)).yoy


@query("end_month_comparison", f"SELECT {SCOPED_SQL} FROM t_sp WHERE m = DATE '2001-10-01'")
def end_month_comparison(t: Tables):
    return analysis(t).comparison


@query(
    "scatter_eligible",
    f"SELECT * FROM (SELECT {PAIR_SQL} FROM t_pair_growth WHERE m = DATE '2000-10-01')"
    " WHERE yoy IS NOT NULL",
)
def scatter_eligible(t: Tables):
    """Partners with a yearly growth in the end month; the ranking cut does not apply."""
    monthly = explore.scope_monthly(t.multi.monthly, PAIR)
    return explore.Analysis(monthly, pair_partners(t), START, date(2000, 10, 1), n=1).scatter


@query(
    "month_counts",
    f"""SELECT rep AS reporter_code, count(*) AS months, count(world) AS world_months,
  strftime(max(m) FILTER (world IS NOT NULL OR has_countries), '%Y-%m-%d') AS last_month
FROM t_sm WHERE {RANGE} GROUP BY rep""",
)
def month_counts(t: Tables):
    return analysis(t).month_counts


HAVE_SQL = "SELECT rep, cmd, m FROM t_monthly WHERE world IS NOT NULL OR n > 0"


@query(
    "common_months",
    f"""SELECT strftime(m, '%Y-%m-%d') AS month FROM ({HAVE_SQL})
GROUP BY m HAVING count(*) = 30""",
)
def common_months(t: Tables):
    available = explore.available_months(t.multi.monthly)
    return months_in_all(available, REGIONS, TYPES)


@query(
    "common_months_filtered",
    f"""SELECT {PARTNER_SQL} FROM t_partners WHERE m IN
(SELECT m FROM ({HAVE_SQL}) GROUP BY m HAVING count(*) = 30)""",
)
def common_months_filtered(t: Tables):
    return explore.keep_common_months(t.multi.partners, t.multi.monthly, REGIONS, TYPES)


@query(
    "annual_comparison",
    f"""WITH x AS ({TREND_SQL}),
y AS (SELECT DISTINCT rep, CAST(year(m) AS INTEGER) AS y FROM x),
z AS (SELECT y.rep, y.y, CAST(s.i AS INTEGER) AS i, x.v
  FROM y CROSS JOIN (SELECT unnest(range(1, 13)) AS i) s
  LEFT JOIN x ON x.rep = y.rep AND year(x.m) = y.y AND month(x.m) = s.i)
SELECT rep AS reporter_code, y AS year, i AS slot, {money("v", "value")},
  count(v) OVER (PARTITION BY rep, y) AS filled_months FROM z""",
)
def annual_comparison(t: Tables):
    return analysis(t).annual


@query(
    "map_bands",
    f"""WITH r AS ({RANK_SQL}), s AS (SELECT DISTINCT x.rep, g.iso3
  FROM (SELECT rep FROM t_sm WHERE {RANGE}) x, ({GEOMETRY_SQL}) g),
v AS (SELECT rep, map3 AS iso3, CAST(sum(v) AS BIGINT) AS v FROM r
  WHERE map3 IS NOT NULL GROUP BY ALL)
SELECT rep AS reporter_code, iso3 AS map_iso3, {money("v", "value")},
  CASE WHEN v IS NULL THEN 'no_data' WHEN v = 0 THEN 'zero' WHEN v < 100000000 THEN 'band_0'
    WHEN v < 1000000000 THEN 'band_1' WHEN v < 10000000000 THEN 'band_2'
    WHEN v < 100000000000 THEN 'band_3' ELSE 'band_4' END AS band
FROM s LEFT JOIN v USING (rep, iso3)""",
)
def map_bands(t: Tables):
    return analysis(t).map_distribution(geometry(t))


@query(
    "unmapped_total",
    f"""SELECT rep AS reporter_code, CAST(sum(v) AS DOUBLE) / 100 AS unmapped
FROM t_sp WHERE {RANGE} AND map3 IS NULL GROUP BY rep""",
)
def unmapped_total(t: Tables):
    return analysis(t).unmapped


@query(
    "unmapped_by_geometry",
    f"""WITH r AS ({RANK_SQL}) SELECT rep AS reporter_code, CAST(sum(v) AS DOUBLE) / 100 AS unmapped
FROM r WHERE map3 IS NULL OR map3 NOT IN ({GEOMETRY_SQL}) GROUP BY rep""",
)
def unmapped_by_geometry(t: Tables):
    return analysis(t).unmapped_by_geometry(geometry(t))


@query(
    "detail_page",
    f"""SELECT * FROM (SELECT {PARTNER_SQL} FROM t_partners WHERE {RANGE} AND rep = 'ASIA')
ORDER BY month DESC, partner_code, cmd_code LIMIT 50 OFFSET 100""",
)
def detail_page(t: Tables):
    """Third page of one market's native rows."""
    rows = explore.detail_rows(t.multi.partners, START, LAST)
    return explore.detail_page(rows.where(F.col("reporter_code") == "ASIA"), 2)


@query(
    "detail_last_page",
    f"""SELECT * FROM (SELECT {PARTNER_SQL} FROM t_partners WHERE {RANGE} AND rep = 'EUROPE')
ORDER BY month DESC, partner_code, cmd_code LIMIT 50 OFFSET
  (SELECT 50 * greatest((count(*) - 1) // 50, 0) FROM t_partners WHERE {RANGE} AND rep = 'EUROPE')""",
)
def detail_last_page(t: Tables):
    """A page number beyond the last one shows the last one."""
    rows = explore.detail_rows(t.multi.partners, START, LAST)
    return explore.detail_page(rows.where(F.col("reporter_code") == "EUROPE"), 10**6)


@query(
    "detail_search",
    f"""SELECT {PARTNER_SQL} FROM t_partners WHERE {RANGE} AND
  contains(lower(concat_ws(' ', name, map3, par)), 'nation_1')""",
)
def detail_search(t: Tables):
    return explore.detail_rows(t.multi.partners, START, LAST, query="Nation_1")


PLAIN = "rtrim(rtrim(CAST({x} AS VARCHAR), '0'), '.')"


def plain_cents_sql(cents: str) -> str:
    text = PLAIN.format(x=f"CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))")
    return f"CASE WHEN {cents} IS NULL THEN '' WHEN {cents} = 0 THEN '0' ELSE {text} END"


def plain_nano_sql(x: str) -> str:
    text = PLAIN.format(x=f"CAST({x} AS DECIMAL(19,0)) * CAST(0.000000001 AS DECIMAL(10,9))")
    return f"CASE WHEN {x} IS NULL THEN '' WHEN {x} = 0 THEN '0' ELSE {text} END"


def _cell(x: str) -> str:
    guarded = f"regexp_replace({x}, '^([=+@-])', '''\\1')"
    return f"'\"' || replace({guarded}, '\"', '\"\"') || '\"'"


CSV_SQL = " || ',' || ".join(
    _cell(x)
    for x in (
        "strftime(m, '%Y-%m-%d')",
        "rep",
        "cmd",
        "hs",
        "par",
        "name",
        plain_cents_sql("v"),
        plain_nano_sql("share"),
        plain_nano_sql("yoy"),
        plain_nano_sql("mom"),
    )
)


@query("detail_csv", f"SELECT {CSV_SQL} AS line FROM t_partners WHERE {RANGE}")
def detail_csv(t: Tables):
    return explore.csv_lines(explore.detail_rows(t.multi.partners, START, LAST))


@query(
    "partner_options",
    """SELECT rep AS reporter_code, par AS partner_code, min(name) AS source_name,
  min(map3) AS map_iso3 FROM t_partners GROUP BY rep, par""",
)
def partner_options(t: Tables):
    return rank.partner_options(t.multi.partners, ("reporter_code",))


@query("month_list", f"SELECT DISTINCT {iso('m', 'month')} FROM t_monthly")
def month_list(t: Tables):
    return t.multi.monthly.select("month").distinct().orderBy("month")


@query(
    "country_labels",
    """SELECT par AS partner_code, map3 AS map_iso3, name AS source_name,
  CASE WHEN name = 'NATION_3' THEN 'Third' WHEN map3 IS NOT NULL AND is_group = false
    THEN 'Land ' || map3 ELSE name END AS label FROM t_country""",
)
def country_labels(t: Tables):
    """Labels by ISO3 for single countries, one override, source names elsewhere."""
    single = t.countries.where(~F.col("source_is_group") & F.col("map_iso3").isNotNull())
    labels = single.select(
        F.col("map_iso3").alias("iso3"), F.concat(F.lit("Land "), "map_iso3").alias("label")
    )
    shown = with_label(t.countries, labels, {"NATION_3": "Third"})
    return shown.select("partner_code", "map_iso3", "source_name", "label")


@query(
    "annual_world",
    """WITH y AS (SELECT DISTINCT rep, cmd, CAST(year(m) AS INTEGER) AS y FROM t_monthly)
SELECT y.rep AS reporter_code, y.cmd AS cmd_code, y.y AS year, CAST(s.i AS INTEGER) AS slot,
  CAST(x.world AS DOUBLE) / 100 AS value
FROM y CROSS JOIN (SELECT unnest(range(1, 13)) AS i) s
LEFT JOIN t_monthly x ON x.rep = y.rep AND x.cmd = y.cmd AND year(x.m) = y.y
  AND month(x.m) = s.i""",
)
def annual_world(t: Tables):
    return aggregate.annual_slots(t.multi.monthly, "world_value", ("reporter_code", "cmd_code"))
