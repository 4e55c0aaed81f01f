"""Queries that are also registered on the panel by line, which grows with the data."""

from monthloom.catalog import landing, loading, marts, quality, scalars, steps
from monthloom.catalog.registry import also_by_line

SOURCES = (landing, loading, marts, quality, scalars, steps)
#: They read the raw panel only: acceptance, digests, load decisions, sums, ratios.
NAMES = (
    "raw_detail",
    "accepted_latest_extract",
    "accepted_latest_row",
    "duplicate_grain",
    "mixed_versions",
    "extract_digest",
    "extract_canonical_text",
    "extract_manifest_counts",
    "path_identity",
    "load_decision",
    "reconcile_load",
    "full_source_replace",
    "audit_events",
    "partition_scan",
    "watermark",
    "scalar_ratios",
    "exact_sums",
    "raw_world",
)
for _name in NAMES:
    also_by_line(_name)
