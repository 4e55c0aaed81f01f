"""Parameters shared by the plans, and the values fixed by the data contract."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

# Fixed values of the source contract: codes, names, limits and enumerations.
MARKETS = {
    "842": "美國",
    "156": "中國",
    "344": "香港",
    "392": "日本",
    "410": "韓國",
    "702": "新加坡",
    "458": "馬來西亞",
    "276": "德國",
    "528": "荷蘭",
    "704": "越南",
}
PRODUCTS = {
    "854231": "處理器與控制器",
    "854232": "記憶體",
    "854233": "放大器",
    "854239": "其他積體電路",
    "854290": "零件",
}
PARTS_PRODUCT = "854290"
KINDS = ("partner_detail", "world_total")
HS_EDITIONS = ("H0", "H1", "H2", "H3", "H4", "H5", "H6")
SCHEMA_VERSION = "2.0.0"
IMPORT_FLOW = "M"
FREQUENCY = "M"
CUSTOMS_CODE = "C00"
WORLD_CODE = "0"
SPECIAL_CODES = ("0", "490")
FIRST_MONTH = date(2016, 1, 1)
ROW_TARGET = 100_000
RECORD_CAP = 100_000
MAX_RANGE_MONTHS = 180
PAGE_SIZE = 50
MAP_BAND_LIMITS = (1e6, 1e7, 1e8, 1e9)
HHI_STATUSES = (
    "ok",
    "missing_world",
    "invalid_world",
    "no_countries",
    "missing_country_value",
    "negative_country_value",
    "unreviewed_country",
    "insufficient_coverage",
)
SHARE_STATUSES = ("ok", "missing_world", "invalid_world", "missing_value")
ISSUE_TYPES = (
    "missing_reference",
    "classification_needs_review",
    "reconciliation_unresolved",
    "map_unavailable",
)


@dataclass(frozen=True)
class Params:
    """Scope of one build. ``start`` and ``end`` are first-of-month, both inclusive."""

    start: date = FIRST_MONTH
    end: date = date(2026, 9, 1)
    tolerance: Decimal = Decimal("0.005")
    products: tuple[str, ...] = tuple(PRODUCTS)
    reporters: tuple[str, ...] = tuple(MARKETS)
    flow: str = IMPORT_FLOW
    world_code: str = WORLD_CODE
    special_codes: tuple[str, ...] = SPECIAL_CODES

    def __post_init__(self) -> None:
        if self.start.day != 1 or self.end.day != 1:
            raise ValueError("start and end must be the first day of a month")
        if self.start > self.end:
            raise ValueError("start month is after end month")
