"""Builders of small raw and reference frames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from monthloom.schemas import COUNTRY_SCHEMA, HS_SCHEMA, RAW_SCHEMA


def raw(spark, rows):
    """Rows as dicts; absent columns get plain defaults."""
    full = []
    for row in rows:
        month = date.fromisoformat(row["month"])
        value, weight = row.get("value"), row.get("weight")
        full.append(
            (
                f"{month:%Y%m}",
                month,
                row.get("reporter", "842"),
                row.get("partner", "0"),
                row.get("flow", "M"),
                row.get("cmd", "8542"),
                row.get("hs", "H6"),
                None if value is None else Decimal(str(value)),
                None if weight is None else Decimal(str(weight)),
                None,
                datetime.fromisoformat(row.get("ingested", "2024-01-01T00:00:00")),
                row.get("file", "f"),
                row.get("checksum", "sha256:x"),
                "run",
                row.get("revision", 1),
            )
        )
    return spark.createDataFrame(full, RAW_SCHEMA)


def countries(spark, rows):
    """(code, type, status) or (code, type, status, map code)."""
    full = []
    for code, kind, status, *rest in rows:
        iso3 = rest[0] if rest else None
        role = "detail" if kind == "country" else "unresolved"
        full.append(
            (code, f"name {code}", "", iso3, kind == "group", kind, status, iso3, role)
            + ("", "", "", None, "", None)
        )
    return spark.createDataFrame(full, COUNTRY_SCHEMA)


def hs_codes(spark, pairs):
    full = [(hs, cmd, f"{cmd} text", 6, "8542", "", "") for hs, cmd in pairs]
    return spark.createDataFrame(full, HS_SCHEMA)


def number(value):
    return None if value is None else float(value)
