"""Named sub-queries for the comparison SQL; money is in whole cents, ratios in 1e-9."""

from __future__ import annotations

import re

SPINE = "generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)"


def ratio(n: str, d: str) -> str:
    """Half up at nine digits, NULL unless the base is positive."""
    return (
        f"CASE WHEN {d} > 0 THEN CAST((2 * CAST({n} AS HUGEINT) * 1000000000 + {d})"
        f" // (2 * CAST({d} AS HUGEINT)) AS BIGINT) END"
    )


def growth(n: str, d: str) -> str:
    return f"({ratio(n, d)}) - 1000000000"


def cut(n: str, d: str) -> str:
    """Cut off at nine digits, NULL unless the base is positive."""
    return (
        f"CASE WHEN {d} > 0 THEN CAST((CAST({n} AS HUGEINT) * 1000000000) // {d} AS BIGINT) END"
    )


def cut_growth(n: str, d: str) -> str:
    return f"({cut(n, d)}) - 1000000000"


def money(x: str, name: str) -> str:
    return f"CAST({x} AS DOUBLE) / 100 AS {name}"


def nano(x: str, name: str) -> str:
    return f"CAST({x} AS DOUBLE) / 1e9 AS {name}"


def iso(x: str, name: str) -> str:
    return f"strftime({x}, '%Y-%m-%d') AS {name}"


def stamp(x: str, name: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S') AS {name}"


TABLES = {
    "t_cells": """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, r_name AS rep, p_type AS cmd,
  CAST(l_linenumber % 3 + 1 AS BIGINT) AS rev, CAST(s_nationkey AS VARCHAR) AS par,
  CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT) AS v,
  CAST(sum(CASE WHEN l_linenumber <> 7 THEN l_quantity END) AS BIGINT) AS w,
  CAST(sum(l_quantity) AS BIGINT) AS q, max(o_orderdate) AS od
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL""",
    "t_detail": """
SELECT m, rep, cmd, rev, par, v, w, q, ing, period, 'H' || (rev + 3) AS hs, src,
  'sha256:' || sha256(src || ':' || n || ':' || total) AS chk, 'run-' || src AS run
FROM (SELECT *, strftime(m, '%Y%m') AS period,
    strftime(m, '%Y%m') || '/' || rep || '/' || cmd || '/' || rev AS src,
    max(od) OVER e AS ing, count(*) OVER e AS n, CAST(sum(v) OVER e AS BIGINT) AS total
  FROM t_cells WINDOW e AS (PARTITION BY m, rep, cmd, rev))""",
    "t_country": """
SELECT CAST(n_nationkey AS VARCHAR) AS par, n_name AS name,
  'Q' || chr(65 + (n_nationkey // 26) % 26) || chr(65 + n_nationkey % 26) AS iso3,
  CASE WHEN n_nationkey % 8 = 0 THEN 'special' WHEN n_nationkey % 8 = 1 THEN 'group'
    ELSE 'country' END AS kind,
  CASE WHEN n_nationkey % 11 = 10 THEN 'needs_review' ELSE 'verified' END AS status,
  CASE WHEN n_nationkey % 7 <> 0 THEN
    'Q' || chr(65 + (n_nationkey // 26) % 26) || chr(65 + n_nationkey % 26) END AS map3,
  CASE WHEN n_nationkey % 8 = 0 THEN 'unresolved' ELSE 'detail' END AS role,
  n_nationkey % 8 = 1 AS is_group,
  CASE WHEN n_nationkey % 11 = 10 THEN 'Awaiting review' END AS note
FROM nation""",
    "t_verified": """
SELECT * FROM t_country WHERE kind = 'country' AND status = 'verified'""",
    "t_hs": """
SELECT e AS hs, cmd, upper(cmd[1]) || lower(cmd[2:]) || ' parts' AS descr
FROM (SELECT DISTINCT p_type AS cmd FROM part), (VALUES ('H4'), ('H5'), ('H6')) x(e)
WHERE e <> 'H5' OR length(cmd) % 2 = 0""",
    "t_world": """
SELECT m, rep, cmd, rev, hs, ing, src, chk, run, period,
  CASE WHEN rep = 'AFRICA' AND month(m) = 8 THEN 0 ELSE t END AS v
FROM (SELECT m, rep, cmd, rev, hs, ing, src, chk, run, period,
    CAST(sum(CASE WHEN rep NOT IN ('ASIA', 'EUROPE')
      OR par IN (SELECT par FROM t_verified) THEN v END) AS BIGINT) AS t
  FROM t_detail WHERE month(m) <> 7 GROUP BY ALL)
WHERE t IS NOT NULL""",
    "t_accepted": """
SELECT * FROM t_detail QUALIFY dense_rank() OVER (PARTITION BY m, rep, cmd
  ORDER BY rev DESC, ing DESC, hs DESC, src DESC) = 1""",
    "t_aworld": """
SELECT * FROM t_world QUALIFY row_number() OVER (PARTITION BY m, rep, cmd
  ORDER BY rev DESC, ing DESC, hs DESC) = 1""",
    "t_fact": """
SELECT a.*, c.name, c.map3, h.descr, h.cmd IS NOT NULL AS hs_hit
FROM t_accepted a JOIN t_verified c USING (par)
LEFT JOIN t_hs h ON a.cmd = h.cmd AND a.hs = h.hs WHERE a.v >= 0""",
    "t_totals": """
SELECT m, rep, cmd, max(hs) AS hs, CAST(sum(v) AS BIGINT) AS v, count(*) AS n,
  sum(pow(CAST(v AS DOUBLE) / 100, 2)) AS sq
FROM t_fact GROUP BY m, rep, cmd""",
    "t_spine": f"""
SELECT CAST(u AS DATE) AS m, rep, cmd
FROM (SELECT rep, cmd FROM t_fact UNION SELECT rep, cmd FROM t_aworld),
  (SELECT unnest({SPINE}) AS u)""",
    "t_month_base": """
SELECT s.m, s.rep, s.cmd, coalesce(w.hs, c.hs) AS hs, w.v AS world, c.v AS cv,
  coalesce(c.n, 0) AS n, """
    + ratio("c.v", "w.v")
    + """ AS cov,
  c.sq / pow(CAST(nullif(w.v, 0) AS DOUBLE) / 100, 2) * 10000 AS raw
FROM t_spine s LEFT JOIN t_aworld w USING (m, rep, cmd) LEFT JOIN t_totals c USING (m, rep, cmd)""",
    "t_monthly": """
SELECT t.*, p.world AS pworld, """
    + growth("t.world", "p.world")
    + """ AS yoy,
  CASE WHEN t.world IS NULL THEN 'missing_world' WHEN t.world <= 0 THEN 'invalid_world'
    WHEN t.n = 0 THEN 'no_countries' WHEN abs(t.cov - 1000000000) > 5000000
    THEN 'insufficient_coverage' ELSE 'ok' END AS status
FROM t_month_base t LEFT JOIN t_month_base p
  ON p.m = t.m - INTERVAL 1 YEAR AND p.rep = t.rep AND p.cmd = t.cmd""",
    "t_partners": """
SELECT f.m, f.rep, f.cmd, f.hs, f.par, f.name, f.map3, f.v, w.world, pm.v AS pmv, py.v AS pyv, """
    + ratio("f.v", "w.world")
    + " AS share, "
    + growth("f.v", "pm.v")
    + " AS mom, "
    + growth("f.v", "py.v")
    + """ AS yoy,
  CASE WHEN w.world IS NULL THEN 'missing_world' WHEN w.world <= 0 THEN 'invalid_world'
    ELSE 'ok' END AS status
FROM t_fact f
LEFT JOIN t_month_base w ON f.m = w.m AND f.rep = w.rep AND f.cmd = w.cmd
LEFT JOIN t_fact pm ON pm.m = f.m - INTERVAL 1 MONTH AND f.rep = pm.rep AND f.cmd = pm.cmd
  AND f.par = pm.par
LEFT JOIN t_fact py ON py.m = f.m - INTERVAL 1 YEAR AND f.rep = py.rep AND f.cmd = py.cmd
  AND f.par = py.par""",
    "t_single": """
SELECT d.*, c.name, c.map3, coalesce(c.kind, 'unknown') AS kind,
  coalesce(c.status, 'needs_review') AS cstatus, coalesce(c.role, 'unresolved') AS role,
  h.descr, c.par IS NOT NULL AS c_hit, h.cmd IS NOT NULL AS h_hit
FROM t_detail d LEFT JOIN t_country c USING (par) LEFT JOIN t_hs h ON d.cmd = h.cmd AND d.hs = h.hs""",
    "t_share": """
SELECT f.*, w.v AS world, pm.v AS pmv, py.v AS pyv, """
    + ratio("f.v", "w.v")
    + " AS share, "
    + growth("f.v", "pm.v")
    + " AS mom, "
    + growth("f.v", "py.v")
    + " AS yoy, "
    + ratio("f.v", "(f.w * 100)")
    + """ AS unit,
  CASE WHEN w.v IS NULL THEN 'missing_world' WHEN w.v <= 0 THEN 'invalid_world' ELSE 'ok' END AS status
FROM t_single f
LEFT JOIN t_world w ON f.m = w.m AND f.rep = w.rep AND f.cmd = w.cmd AND f.hs = w.hs
LEFT JOIN t_single pm ON pm.m = f.m - INTERVAL 1 MONTH AND f.rep = pm.rep AND f.cmd = pm.cmd
  AND f.hs = pm.hs AND f.par = pm.par
LEFT JOIN t_single py ON py.m = f.m - INTERVAL 1 YEAR AND f.rep = py.rep AND f.cmd = py.cmd
  AND f.hs = py.hs AND f.par = py.par""",
    "t_conc": """
SELECT *, CASE WHEN world IS NULL THEN 'missing_world' WHEN world <= 0 THEN 'invalid_world'
    WHEN n = 0 THEN 'no_countries' WHEN unreviewed > 0 THEN 'unreviewed_country'
    WHEN abs(1000000000 - cov) > 5000000 THEN 'insufficient_coverage' ELSE 'ok' END AS status
FROM (SELECT coalesce(c.m, w.m) AS m, coalesce(c.rep, w.rep) AS rep, coalesce(c.cmd, w.cmd) AS cmd,
    coalesce(c.hs, w.hs) AS hs, w.v AS world, c.cv, coalesce(c.n, 0) AS n,
    coalesce(c.unreviewed, 0) AS unreviewed, c.raw, """
    + ratio("c.cv", "w.v")
    + """ AS cov
  FROM (SELECT m, rep, cmd, hs, count(*) FILTER (kind = 'country') AS n,
      count(*) FILTER (kind = 'country' AND cstatus <> 'verified') AS unreviewed,
      CAST(sum(v) FILTER (kind = 'country') AS BIGINT) AS cv,
      sum(pow(CAST(share AS DOUBLE) / 1e9 * 100, 2)) FILTER (kind = 'country') AS raw
    FROM t_share GROUP BY m, rep, cmd, hs) c
  FULL JOIN t_world w ON c.m = w.m AND c.rep = w.rep AND c.cmd = w.cmd AND c.hs = w.hs)""",
    "t_sm": """
SELECT m, rep, CASE WHEN count(*) = 6 AND count(world) = 6 THEN CAST(sum(world) AS BIGINT) END AS world,
  CASE WHEN count(*) = 6 AND count(pworld) = 6 THEN CAST(sum(pworld) AS BIGINT) END AS pworld,
  bool_or(n > 0) AS has_countries
FROM t_monthly GROUP BY m, rep""",
    "t_sp0": """
SELECT m, rep, par, min(name) AS name, min(map3) AS map3, count(*) AS k,
  arg_min(status, cmd) AS status, CAST(sum(v) AS BIGINT) AS v,
  string_agg(DISTINCT hs, '+' ORDER BY hs) AS hs
FROM t_partners GROUP BY m, rep, par""",
    "t_sp": """
SELECT p.*, s.world, CASE WHEN p.k = 6 AND a.k = 6 THEN a.v END AS pmv,
  CASE WHEN p.k = 6 AND b.k = 6 THEN b.v END AS pyv
FROM t_sp0 p LEFT JOIN t_sm s USING (m, rep)
LEFT JOIN t_sp0 a ON a.m = p.m - INTERVAL 1 MONTH AND a.rep = p.rep AND a.par = p.par
LEFT JOIN t_sp0 b ON b.m = p.m - INTERVAL 1 YEAR AND b.rep = p.rep AND b.par = p.par""",
    "t_pair": """
SELECT p.m, p.rep, p.par, min(p.name) AS name, min(p.map3) AS map3, count(*) AS k,
  arg_min(p.status, p.cmd) AS status, CAST(sum(p.v) AS BIGINT) AS v,
  string_agg(DISTINCT p.hs, '+' ORDER BY p.hs) AS hs
FROM t_partners p WHERE p.cmd IN ('LARGE', 'ECONOMY') GROUP BY p.m, p.rep, p.par""",
    "t_pair_world": """
SELECT m, rep, CASE WHEN count(*) = 2 AND count(world) = 2 THEN CAST(sum(world) AS BIGINT) END AS world
FROM t_monthly WHERE cmd IN ('LARGE', 'ECONOMY') GROUP BY m, rep""",
    "t_pair_growth": """
SELECT p.*, s.world, CASE WHEN p.k = 2 AND a.k = 2 THEN a.v END AS pmv,
  CASE WHEN p.k = 2 AND b.k = 2 THEN b.v END AS pyv
FROM t_pair p LEFT JOIN t_pair_world s USING (m, rep)
LEFT JOIN t_pair a ON a.m = p.m - INTERVAL 1 MONTH AND a.rep = p.rep AND a.par = p.par
LEFT JOIN t_pair b ON b.m = p.m - INTERVAL 1 YEAR AND b.rep = p.rep AND b.par = p.par""",
    "t_extracts": """
SELECT m, rep, cmd, rev, hs, period, ing, src, chk, count(*) AS n, CAST(sum(v) AS BIGINT) AS total
FROM t_detail GROUP BY ALL""",
}


def with_tables(sql: str) -> str:
    """Put the sub-queries that ``sql`` needs, directly or not, in front of it."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        for name in set(re.findall(r"\bt_[a-z0-9_]+\b", pending.pop())):
            if name in TABLES and name not in needed:
                needed.add(name)
                pending.append(TABLES[name])
    parts = [f"{name} AS MATERIALIZED ({TABLES[name]})" for name in TABLES if name in needed]
    body = sql.strip()
    if not parts:
        return body
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    rest = body[5:] if joiner == ",\n" else body
    return "WITH " + ",\n".join(parts) + joiner + rest


# Partners and products of the panel by line, in the first tables of the chain.
BY_LINE = (
    ("p_type AS cmd, CAST", "CAST(p_partkey AS VARCHAR) AS cmd, CAST"),
    ("p_type AS cmd,", "CAST(p_partkey AS VARCHAR) AS cmd,"),
    ("CAST(s_nationkey AS VARCHAR)", "CAST(s_suppkey AS VARCHAR)"),
    ("DISTINCT p_type AS cmd", "DISTINCT CAST(p_partkey AS VARCHAR) AS cmd"),
    ("n_name AS name", "'Supplier ' || s_suppkey AS name"),
    ("FROM nation)", "FROM supplier)"),
)


def by_line(sql: str) -> str:
    """The same SQL with suppliers as partners and parts as products."""
    for old, new in BY_LINE:
        sql = sql.replace(old, new)
    head, mark, rest = sql.partition("t_country AS MATERIALIZED (")
    if mark:
        body, end, after = rest.partition("FROM supplier)")
        rest = body.replace("n_nationkey", "CAST(s_suppkey AS INTEGER)") + end + after
    return head + mark + rest
