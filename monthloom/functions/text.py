"""Exact decimal text, canonical JSON, CSV cells and display strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed display text for an unknown amount.
NO_DATA_TEXT = "資料不足"


def plain_decimal(value: Column) -> Column:
    """No exponent and no trailing zeros; zero is '0'."""
    text = value.cast("decimal(38,9)").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(value == 0, F.lit("0")).otherwise(trimmed)


def is_plain_decimal(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^-?[0-9]+(\.[0-9]+)?\z"), F.lit(False))


def parse_decimal(text: Column) -> Column:
    """Strict reading: NULL for an exponent, spaces, overflow or a tenth digit that is not 0."""
    lossless = ~text.rlike(r"\.[0-9]{9}[0-9]*[1-9]")
    number = F.substring_index(text, ".", 1)
    fraction = F.substring(F.regexp_extract(text, r"\.([0-9]+)", 1), 1, 9)
    cut = F.when(fraction == "", number).otherwise(F.concat(number, F.lit("."), fraction))
    return F.when(is_plain_decimal(text) & lossless, cut.try_cast("decimal(38,9)"))


def parse_decimal_nine(text: Column) -> Column:
    """Interactive-layer reading: at most nine fractional digits may be written at all."""
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]{1,9})?\z"), text.try_cast("decimal(38,9)"))


def namespaced_sha256(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def canonical_json(columns: Sequence[str]) -> Column:
    """Keys in name order, compact, NULL fields kept."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def csv_cell(value: Column) -> Column:
    """Text for a CSV cell; a leading formula sign is quoted away."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"^([=+@-])", "'$1")


def quoted_csv_cell(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(csv_cell(value), F.lit('"'), F.lit('""')), F.lit('"'))


def amount_text(value: Column) -> Column:
    """Thousands separators on the whole part, the fraction as it is."""
    text = plain_decimal(value)
    whole = F.regexp_replace(
        F.substring_index(text, ".", 1), r"\B(?=(?:[0-9]{3})+(?![0-9]))", ","
    )
    fraction = F.regexp_extract(text, r"(\.[0-9]+)$", 1)
    return F.coalesce(F.concat(whole, fraction), F.lit(NO_DATA_TEXT))


def compact_amount_text(value: Column) -> Column:
    """K, M, B or T with at most two digits."""
    size = F.abs(value)
    steps = (("T", "1000000000000"), ("B", "1000000000"), ("M", "1000000"), ("K", "1000"))
    text = F.lit(None).cast("string")
    for unit, limit in steps:
        # 999,995 already shows as 1M, so a unit starts half a cent below its limit.
        floor = F.lit(limit).cast("decimal(38,9)") * F.lit("0.999995").cast("decimal(9,6)")
        scaled = F.round(value.cast("double") / F.lit(float(limit)), 2)
        shown = F.regexp_replace(F.format_string("%.2f", scaled), r"\.?0+$", "")
        text = F.coalesce(text, F.when(size >= floor, F.concat(shown, F.lit(unit))))
    small = F.regexp_replace(
        F.format_string("%.2f", F.round(value.cast("double"), 2)), r"\.?0+$", ""
    )
    shown = F.coalesce(text, small)
    return F.when(value.isNull(), F.lit(NO_DATA_TEXT)).otherwise(shown)


def _hundredths(value: Column) -> Column:
    """A non-negative double in hundredths, rounded by its exact binary value, ties up.

    The fraction is split so that each part times 200 is exact; a guess from plain
    rounding is then moved to the neighbour if the exact comparison asks for it.
    """
    whole = F.floor(value)
    fraction = value - whole
    coarse = F.floor(fraction * float(1 << 20)) / float(1 << 20)
    fine = fraction - coarse
    guess = F.floor(fraction * 100.0 + 0.5)

    def reaches(bound: Column) -> Column:
        return (coarse * 200.0 - bound.cast("double")) + fine * 200.0 >= 0

    settled = (
        F.when(~reaches(guess * 2 - 1), guess - 1)
        .when(reaches(guess * 2 + 1), guess + 1)
        .otherwise(guess)
    )
    return whole * 100 + settled


def percent_text(ratio: Column) -> Column:
    """Two digits after rounding the double ratio times 100."""
    percent = ratio.cast("double") * F.lit(100.0)
    parts = _hundredths(F.abs(percent))
    shown = F.format_string("%d.%02d%%", F.floor(parts / 100), parts % 100)
    signed = F.when(percent < 0, F.concat(F.lit("-"), shown)).otherwise(shown)
    return F.when(ratio.isNull(), F.lit(NO_DATA_TEXT)).otherwise(signed)


def valid_code(code: Column) -> Column:
    return F.coalesce(code.rlike(r"^[0-9]+\z"), F.lit(False))


def valid_iso3(code: Column) -> Column:
    return F.coalesce(code.rlike(r"^[A-Z]{3}\z"), F.lit(False))


def valid_edition(edition: Column) -> Column:
    return F.coalesce(edition.rlike(r"^H[0-6]\z"), F.lit(False))


def valid_run_id(run: Column) -> Column:
    """Letters, digits, hyphens and underscores, 128 at most."""
    return F.coalesce(run.rlike(r"^[A-Za-z0-9_-]{1,128}\z"), F.lit(False))


def search_text(columns: Sequence[Column], query: str) -> Column:
    """Case-insensitive substring over several columns joined by blanks."""
    haystack = F.lower(F.concat_ws(" ", *columns))
    return haystack.contains(query.lower())


def pack_rows(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row as an array of strings in column order; the names travel once."""
    return frame.select(F.array(*[F.col(name).cast("string") for name in columns]).alias("cells"))


def unpack_rows(packed: DataFrame, columns: Sequence[str], cells: str = "cells") -> DataFrame:
    return packed.select(
        *[F.get(F.col(cells), F.lit(place)).alias(name) for place, name in enumerate(columns)]
    )
