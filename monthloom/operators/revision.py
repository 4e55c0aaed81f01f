"""Which version of an extract counts, and what to do with an incoming one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.operators.joins import null_safe_join

SCOPE = ("period_start_date", "reporter_code", "cmd_code", "flow_code")
NEWEST = ("revision", "ingested_at", "hs_version", "source_file")
IDENTITY = ("reporter_code", "cmd_code", "period", "query_type")


def winning_extracts(
    detail: DataFrame, scope: Sequence[str] = SCOPE, newest: Sequence[str] = NEWEST
) -> DataFrame:
    """The newest version per scope as a struct ``winner``; NULLs rank last.

    Rows are first reduced to distinct versions by a hash aggregate with a map-side
    part, so the struct maximum only sees one row per version.
    """
    versions = detail.select(*scope, *newest).distinct()
    return versions.groupBy(*scope).agg(F.max(F.struct(*newest)).alias("winner"))


def accept_latest_extract(
    detail: DataFrame,
    scope: Sequence[str] = SCOPE,
    newest: Sequence[str] = NEWEST,
    versions: DataFrame | None = None,
    clustered: bool = False,
) -> DataFrame:
    """Every row of the newest extract of each scope, and no row of an older one.

    Ranking rows with a window would sort a whole scope in one task. Joining the
    rows to the winning versions keeps them where they are when the winners are
    small enough to broadcast, and lets Spark split a hot scope when they are not.
    ``versions``, where a load keeps them, name the extracts of the table, so that its
    rows are read once. ``clustered`` says that the rows of a scope lie in one task
    already, as in the panel by line: then a maximum over the scope reads them once and
    moves nothing.
    """
    if clustered:
        version = F.struct(*newest)
        best = F.max(version).over(Window.partitionBy(*scope))
        marked = detail.withColumn("__best", best)
        return marked.where(version.eqNullSafe(F.col("__best"))).drop("__best")
    known = detail if versions is None else versions
    winners = winning_extracts(known, scope, newest).select(
        *scope, *[F.col(f"winner.{name}").alias(name) for name in newest]
    )
    return null_safe_join(detail, winners, (*scope, *newest), "left_semi")


def accept_latest_row(
    world: DataFrame,
    scope: Sequence[str] = SCOPE,
    newest: Sequence[str] = ("revision", "ingested_at", "hs_version"),
    clustered: bool = False,
) -> DataFrame:
    """One row per scope: the newest, ties broken by the remaining columns.

    Versions are counted by hashing and the winners semi-joined; only rows that share
    the winning version of their scope are compared as a whole. Rows that are
    ``clustered`` by scope already are read once, by one maximum where they lie.
    """
    if clustered:
        others = [name for name in world.columns if name not in scope]
        order = [*newest, *[name for name in others if name not in newest]]
        top = world.groupBy(*scope).agg(F.max(F.struct(*order)).alias("kept"))
        return top.select(
            *[F.col(n) if n in scope else F.col(f"kept.{n}").alias(n) for n in world.columns]
        )
    versions = world.groupBy(*scope, *newest).agg(F.count("*").alias("n"))
    best = versions.groupBy(*scope).agg(F.max(F.struct(*newest, "n")).alias("best"))
    winners = best.select(*scope, *[F.col(f"best.{name}").alias(name) for name in (*newest, "n")])
    key = (*scope, *newest)
    single = null_safe_join(world, winners.where("n = 1").drop("n"), key, "left_semi")
    tied = null_safe_join(world, winners.where("n > 1").drop("n"), key, "left_semi")
    rest = [name for name in world.columns if name not in key]
    if not rest:
        return single.unionByName(tied.distinct())
    chosen = tied.groupBy(*key).agg(F.max(F.struct(*rest)).alias("kept"))
    one = chosen.select(
        *[F.col(n) if n in key else F.col(f"kept.{n}").alias(n) for n in world.columns]
    )
    return single.select(*world.columns).unionByName(one)


def latest_manifests(manifests: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """Newest revision per identity with ``copies`` of that revision (1 unless ambiguous).

    Revisions are counted by hashing; manifests are compared as a whole only where several
    share the newest one.
    """
    rest = [name for name in manifests.columns if name not in (*identity, "revision")]
    key = (*identity, "revision")
    counted = manifests.groupBy(*key).agg(F.count("*").alias("copies"))
    best = counted.groupBy(*identity).agg(F.max(F.struct("revision", "copies")).alias("b"))
    newest = best.select(*identity, F.col("b.revision").alias("revision"), F.col("b.copies").alias("copies"))
    order = [*key, *rest, "copies"]
    single = null_safe_join(manifests, newest.where("copies = 1").drop("copies"), key, "left_semi")
    tied = null_safe_join(manifests, newest.where("copies > 1").drop("copies"), key, "left_semi")
    chosen = tied.groupBy(*key).agg(F.count("*").alias("copies"), F.max(F.struct(*rest)).alias("kept"))
    one = chosen.select(*key, *[F.col(f"kept.{name}").alias(name) for name in rest], "copies")
    return single.withColumn("copies", F.lit(1).cast("long")).select(*order).unionByName(one)


def stored_versions(
    raw: DataFrame, key: Sequence[str] = ("period_start_date", "reporter_code", "cmd_code")
) -> DataFrame:
    """What is stored per load unit: revision, checksum, row count and version counts.

    Distinct versions are found on pre-aggregated rows, so a hot unit is combined
    on the map side. The two counts are sizes of sets, no longer than the versions stored
    of one unit: distinct counts side by side would triple the rows and deal them anew.
    """
    versions = raw.groupBy(*key, "revision", "checksum").agg(F.count("*").alias("n"))
    return versions.groupBy(*key).agg(
        F.max("revision").alias("revision"),
        F.max("checksum").alias("checksum"),
        F.sum("n").alias("row_count"),
        F.size(F.collect_set("revision")).cast("long").alias("revisions"),
        F.size(F.collect_set("checksum")).cast("long").alias("checksums"),
    )


def mixed_versions(stored: DataFrame) -> DataFrame:
    return stored.where((F.col("revisions") != 1) | (F.col("checksums") != 1))


def load_decision(incoming: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows with the stored version and ``decision``."""
    known = stored.select(
        *key,
        F.col("revision").alias("stored_revision"),
        F.col("checksum").alias("stored_checksum"),
        F.col("row_count").alias("stored_row_count"),
        F.col("revisions").alias("stored_revisions"),
        F.col("checksums").alias("stored_checksums"),
    )
    new, old = F.col("revision"), F.col("stored_revision")
    same = F.col("checksum") == F.col("stored_checksum")
    decision = (
        F.when(old.isNull() | (new > old), "load")
        .when(new < old, "stale_revision")
        .when(same, "already_loaded")
        .otherwise("conflict")
    )
    return incoming.join(known, list(key), "left").withColumn("decision", decision)


def replay_count_mismatch(decided: DataFrame) -> DataFrame:
    """Already loaded, but with another number of rows."""
    replayed = F.col("decision") == "already_loaded"
    return decided.where(replayed & ~F.col("stored_row_count").eqNullSafe(F.col("row_count")))


def assign_revision(
    requested: DataFrame,
    fetched: DataFrame,
    accepted: DataFrame,
    refresh: bool = True,
    identity: Sequence[str] = IDENTITY,
) -> DataFrame:
    """What each requested identity becomes after a fetch.

    ``fetched`` and ``accepted`` carry a checksum per identity, ``accepted`` also a
    revision. ``action`` is save, unchanged, keep, unavailable or missing_refresh.
    """
    seen = fetched.select(*identity, F.col("checksum").alias("new_checksum"))
    known = accepted.select(
        *identity,
        F.col("revision").alias("old_revision"),
        F.col("checksum").alias("old_checksum"),
    )
    joined = requested.select(*identity).join(seen, list(identity), "left")
    joined = joined.join(known, list(identity), "left")
    had, got = F.col("old_revision").isNotNull(), F.col("new_checksum").isNotNull()
    action = (
        F.when(had & F.lit(not refresh), "keep")
        .when(~got & had, "missing_refresh")
        .when(~got, "unavailable")
        .when(had & (F.col("new_checksum") == F.col("old_checksum")), "unchanged")
        .otherwise("save")
    )
    next_revision = F.coalesce(F.col("old_revision"), F.lit(0)) + 1
    decided = joined.withColumn("action", action)
    return decided.withColumn(
        "revision",
        F.when(F.col("action") == "save", next_revision)
        .when(F.col("action").isin("keep", "unchanged"), F.col("old_revision"))
        .cast("long"),
    )


def require_refreshed(decided: DataFrame) -> None:
    """A refresh that brings nothing for an accepted identity is an error, not a deletion."""
    missing = decided.where(F.col("action") == "missing_refresh").count()
    if missing:
        raise ValueError(f"{missing} accepted extracts are missing from the refresh")


def run_id() -> Column:
    version = F.concat(F.lit("r"), F.col("revision").cast("string"))
    return F.concat_ws("-", F.lit("multi"), "period", "reporter_code", "cmd_code", version)


def stamp_lineage(
    rows: DataFrame, extracts: DataFrame, key: Sequence[str], also: Sequence[str] = ()
) -> DataFrame:
    """Attach run, version and file of the extract a row came from; others drop out."""
    lineage = extracts.select(
        *key, *also, "ingested_at", "source_file", "checksum", "revision"
    )
    return rows.join(lineage, list(key)).withColumn("run_id", run_id())
