"""The batch path as one run: scan, load, transform, publish, verify.

Every stage leaves a record under the run's id and reads that of the stage before, so a run
that stopped goes on where it was. One change token, the number and time of the last success
events of the audit log, is carried from the load to the pointer: whatever another run loads
in between makes the later stages refuse.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from monthloom.functions.calendar import month_frame, to_period
from monthloom.operators.aggregate import watermark
from monthloom.operators.revision import assign_revision, require_refreshed
from monthloom.operators.select import member_or_all
from monthloom.params import KINDS, MARKETS, PRODUCTS, Params
from monthloom.plans import landing, load, publish, quality
from monthloom.plans.multi_market import accepted_world, multi_market_monthly, multi_market_partners
from monthloom.schemas import RAW_SCHEMA
from monthloom.sources.landing import (
    list_folders,
    path_identity,
    present_paths,
    scan_checksums,
    scan_lines,
    scan_manifests,
    scope_paths,
)
from monthloom.sources.raw import path_exists, scan_table

STAGES = ("scan", "load", "transform", "publish", "verify")
RECORD = (
    "scope string, attempt string, events bigint, last_event_at timestamp, months array<string>, "
    "snapshot_id string, note string, written_at timestamp"
)
INDEX = "extract string, bytes bigint, modified_at timestamp, reporter_code string, period string, run_id string"
# Times of records keep their microseconds, as the token is compared exactly.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
# Fixed pattern of a run's id.
RUN_ID = r"[A-Za-z0-9_-]{1,128}"
EXTRACT_KEY = ("reporter_code", "cmd_code", "period", "query_type")


@dataclass(frozen=True)
class Batch:
    """One run over the landed folders of a range of months.

    ``landing`` holds landed extracts, ``tables`` the raw tables, the audit log, the fact, the
    index of loaded folders and the records, ``output`` the snapshots. With ``refresh`` every
    folder of the range is read again and must hold what was accepted before; without it only
    folders that are new or changed are opened. ``full`` rebuilds the fact as a new version.
    """

    spark: SparkSession
    landing: str
    tables: str
    output: str
    run_id: str
    countries: DataFrame
    hs_codes: DataFrame
    params: Params
    refresh: bool = False
    full: bool = False
    markets: dict[str, str] = field(default_factory=lambda: dict(MARKETS))
    products: dict[str, str] = field(default_factory=lambda: dict(PRODUCTS))

    def __post_init__(self) -> None:
        if not re.fullmatch(RUN_ID, self.run_id):
            raise ValueError("invalid run id")
        reporters = self.params.reporters
        if not reporters or len(set(reporters)) != len(reporters):
            raise ValueError("reporters must be there and differ")
        if any(code not in self.markets for code in reporters):
            raise ValueError("unsupported reporter")

    # Records

    def scope(self) -> str:
        """What must be the same in all stages of one run."""
        p = self.params
        settings = {
            "start": p.start.isoformat(),
            "end": p.end.isoformat(),
            "reporters": list(p.reporters),
            "products": list(p.products),
            "refresh": self.refresh,
            "full": self.full,
            "landing": self.landing,
            "output": self.output,
        }
        return json.dumps(settings, sort_keys=True)

    def folder(self, name: str) -> str:
        return f"{self.tables}/runs/{self.run_id}/{name}"

    def record(self, name: str, **values: object) -> None:
        row = {"scope": self.scope(), "attempt": None, "events": None, "last_event_at": None}
        row |= {"months": None, "snapshot_id": None, "note": None, **values}
        names = [part.split()[0] for part in RECORD.split(", ")][:-1]
        kinds = ", ".join(RECORD.split(", ")[:-1])
        frame = self.spark.createDataFrame([tuple(row[n] for n in names)], kinds).coalesce(1)
        frame.withColumn("written_at", F.current_timestamp()).write.mode("append").options(**TIMES).json(self.folder(name))

    def last(self, name: str) -> Row | None:
        """The newest record of a stage of this run, of whatever settings."""
        if not path_exists(self.spark, self.folder(name)):
            return None
        found = self.spark.read.schema(RECORD).options(**TIMES).json(self.folder(name))
        columns = [c for c in found.columns if c != "written_at"]
        return found.agg(F.max(F.struct("written_at", *columns)).alias("r")).first()["r"]

    def upstream(self, name: str) -> Row:
        """The record of the stage before; without one, or of other settings, refuse."""
        found = self.last(name)
        if found is None:
            raise ValueError(f"stage {name} of this run has not succeeded")
        if found["scope"] != self.scope():
            raise ValueError("stage settings differ from those of the run")
        return found

    # The change token

    def token(self) -> tuple[int, datetime | None]:
        path = f"{self.tables}/audit"
        if not path_exists(self.spark, path):
            return 0, None
        row = watermark(load.scan_audit(self.spark, path)).first()
        return row["events"], row["last_event_at"]

    def require_unmoved(self, before: Row, when: str) -> None:
        if self.token() != (before["events"], before["last_event_at"]):
            raise ValueError(f"raw tables changed {when}; transform again")

    # Stages

    def landed(self) -> DataFrame | None:
        """Folders of the range with their identity; refuses what is not safe to read."""
        wanted = month_frame(self.spark, self.params.start, self.params.end, "m").select(to_period(F.col("m")))
        periods = [row[0] for row in wanted.collect()]  # the calendar
        patterns = scope_paths(self.landing, {code: periods for code in self.params.reporters})
        patterns = present_paths(self.spark, patterns)
        if not patterns:
            return None
        identity = path_identity(F.concat("extract", F.lit("/x")))
        found = list_folders(self.spark, patterns).withColumns(
            {name: identity[f"path_{name}"] for name in ("reporter_code", "period")}
        )
        load.require_none(
            {
                "uncommitted source": found.where("manifests = 0"),
                "ambiguous source": found.where("data_files > 1 or manifests > 1"),
                "manifest without data": found.where("data_files = 0"),
            }
        )
        return found

    def unread(self, found: DataFrame) -> DataFrame:
        """Folders that no run has loaded as they are now."""
        if self.refresh or not path_exists(self.spark, f"{self.tables}/index"):
            return found
        index = self.spark.read.schema(INDEX).parquet(f"{self.tables}/index")
        mine = member_or_all(index, "reporter_code", self.params.reporters)
        return found.join(mine, ["extract", "bytes", "modified_at"], "left_anti")

    def patterns(self, folders: DataFrame) -> list[str]:
        """Path patterns of the markets and months that ``folders`` are in."""
        wanted: dict[str, list[str]] = {}
        for code, period in folders.select("reporter_code", "period").distinct().collect():
            wanted.setdefault(code, []).append(period)
        return scope_paths(self.landing, wanted)

    def scan(self) -> str:
        """Check the landed extracts of the range and store the newest of each identity."""
        previous = self.last("scan")
        if previous is not None:
            return self.upstream("scan")["attempt"]
        attempt = uuid.uuid4().hex
        found = self.landed()
        folders = load.cut_lineage(self.unread(found)) if found is not None else None
        if folders is None or folders.isEmpty():
            self.record("scan", attempt=attempt, months=[], note="nothing new")
            return attempt
        folders.withColumn("run_id", F.lit(self.run_id)).select(*[p.split()[0] for p in INDEX.split(", ")]).write.parquet(
            f"{self.folder('folders')}/{attempt}"
        )
        patterns = self.patterns(folders)
        manifests = load.cut_lineage(scan_manifests(self.spark, self.landing, patterns))
        rows = landing.parse_records(scan_lines(self.spark, self.landing, patterns))
        sums = scan_checksums(self.spark, self.landing, patterns)
        products, start = self.params.products, self.params.start
        checked = load.cut_lineage(landing.reconcile(manifests, rows, sums, products, start))
        newest, ambiguous = landing.newest_extracts(landing.accepted(checked))
        load.require_none(
            {
                "unsound extract": checked.where(F.size("reasons") > 0),
                "ambiguous source revision": ambiguous,
            }
        )
        newest = load.cut_lineage(newest)
        if self.refresh:
            self.require_complete(newest)
        newest.write.parquet(f"{self.folder('extracts')}/{attempt}")
        self.record("scan", attempt=attempt, months=[f"{m:%Y%m}" for m in load.months_of(newest)])
        return attempt

    def require_complete(self, newest: DataFrame) -> None:
        """A refresh must bring every identity that the raw tables hold in this range."""
        renamed = newest.withColumnRenamed("kind", "query_type")
        months = load.months_of(month_frame(self.spark, self.params.start, self.params.end, "period_start_date"))
        stored = [
            member_or_all(load.imports(table), "reporter_code", self.params.reporters)
            .groupBy("reporter_code", "cmd_code", "period", "revision", "checksum").agg(F.count("*").alias("n"))
            .withColumn("query_type", F.lit(kind))
            for kind, table in load.stored_tables(self.spark, self.tables, months).items()
        ]
        accepted = stored[0].unionByName(stored[1])
        requested = accepted.select(*EXTRACT_KEY).unionByName(renamed.select(*EXTRACT_KEY)).distinct()
        require_refreshed(assign_revision(requested, renamed, accepted, True, EXTRACT_KEY))

    def load(self) -> dict[str, object]:
        """Load what the scan accepted, mark its folders as read and take the change token."""
        scanned = self.upstream("scan")
        result: dict[str, object] = {"status": "nothing_new", "months": []}
        if scanned["note"] is None:
            extracts = self.spark.read.parquet(f"{self.folder('extracts')}/{scanned['attempt']}")
            rows = landing.parse_records(scan_lines(self.spark, self.landing, self.patterns(extracts)))
            result = load.load_extracts(self.spark, self.tables, extracts, rows)
            folders = self.spark.read.schema(INDEX).parquet(f"{self.folder('folders')}/{scanned['attempt']}")
            folders.write.mode("append").partitionBy("reporter_code").parquet(f"{self.tables}/index")
        events, last = self.token()
        months = [f"{month:%Y%m}" for month in result["months"]]
        self.record("load", attempt=scanned["attempt"], events=events, last_event_at=last, months=months, note=result["status"])
        return result

    def refreshed_until(self) -> datetime | None:
        """Time of the last event that a transform of any run has seen."""
        path = f"{self.tables}/refreshes"
        if not path_exists(self.spark, path):
            return None
        marks = self.spark.read.schema("last_event_at timestamp").options(**TIMES).json(path)
        return marks.agg(F.max("last_event_at")).first()[0]

    def transform(self) -> dict[str, int]:
        """Refresh the fact's months, build and check the marts; refuse if raw tables moved.

        Months come from the audit log since the last refresh, whichever run loaded them.
        """
        self.upstream("load")
        attempt = uuid.uuid4().hex
        self.record("attempt", attempt=attempt)
        events, last = self.token()
        if not events:
            raise ValueError("nothing has been loaded")
        feed = load.months_since(load.scan_audit(self.spark, f"{self.tables}/audit"), self.refreshed_until())
        detail = scan_table(self.spark, f"{self.tables}/{KINDS[0]}", RAW_SCHEMA)
        world_path = f"{self.tables}/{KINDS[1]}"
        world = (
            scan_table(self.spark, world_path, RAW_SCHEMA)
            if path_exists(self.spark, world_path)
            else self.spark.createDataFrame([], RAW_SCHEMA)
        )
        fact_path = f"{self.tables}/fact"
        load.refresh_fact(
            self.spark, fact_path, detail, self.countries, self.hs_codes, self.params, load.months_of(feed), self.full,
            load.scan_versions(self.spark, f"{self.tables}/versions"),
        )
        fact = member_or_all(load.scan_fact(self.spark, fact_path), "reporter_code", self.params.reporters)
        totals = load.cut_lineage(member_or_all(accepted_world(world, self.params), "reporter_code", self.params.reporters))
        marts = self.folder("marts") + f"/{attempt}"
        multi_market_monthly(fact, totals, self.params).write.parquet(f"{marts}/monthly")
        multi_market_partners(fact, totals, self.params).write.parquet(f"{marts}/partners")
        monthly, partners = self.marts(attempt)
        report = load.cut_lineage(quality.check_report(mart_checks(monthly, partners, fact, self.params)))
        quality.require_clean(report)
        before = Row(events=events, last_event_at=last)
        self.require_unmoved(before, "during the transform")
        mark = self.spark.range(1, numPartitions=1).select(F.lit(last).cast("timestamp").alias("last_event_at"))
        mark.write.mode("append").options(**TIMES).json(f"{self.tables}/refreshes")
        self.record("transform", attempt=attempt, events=events, last_event_at=last)
        return {row["failed_check"]: row["violations"] for row in report.collect()}

    def marts(self, attempt: str) -> tuple[DataFrame, DataFrame]:
        folder = self.folder("marts") + f"/{attempt}"
        return self.spark.read.parquet(f"{folder}/monthly"), self.spark.read.parquet(f"{folder}/partners")

    def publish(self) -> str:
        """Publish the marts of the last transform; refuse if it is not the last attempt or raw moved."""
        made = self.upstream("transform")
        if self.last("attempt")["attempt"] != made["attempt"]:
            raise ValueError("the last transform did not succeed; transform again")
        self.require_unmoved(made, "after the transform")
        monthly, partners = self.marts(made["attempt"])
        snapshot = publish.publish_snapshot(
            monthly,
            partners,
            self.output,
            self.params,
            markets=self.markets,
            products=self.products,
            unmoved=lambda: self.require_unmoved(made, "during the publication"),
        )
        self.record("publish", attempt=made["attempt"], events=made["events"], last_event_at=made["last_event_at"], snapshot_id=snapshot)
        return snapshot

    def verify(self) -> str:
        """Verify the current snapshot, which must be the one this run published."""
        published = self.upstream("publish")["snapshot_id"]
        found = publish.verify_snapshot(self.spark, self.output, self.params, self.markets, self.products)
        if found != published:
            raise ValueError("another run has published since")
        self.record("verify", snapshot_id=found)
        return found

    def run(self) -> str:
        """All stages in order; returns the id of the verified snapshot."""
        for name in STAGES:
            getattr(self, name)()
        return self.upstream("verify")["snapshot_id"]


def mart_checks(
    monthly: DataFrame, partners: DataFrame, fact: DataFrame, params: Params
) -> dict[str, DataFrame]:
    """Violating rows by contract of what a transform has built."""
    key = ["month", "reporter_code", "cmd_code", "partner_code"]
    return {
        "detail_contract": quality.multi_market_detail(fact, params.products),
        "monthly_contract": quality.monthly_contract_multi(monthly, partners, params.tolerance),
        "partner_contract": quality.partner_contract_multi(partners, monthly),
        "unique_partner_grain": quality.compound_unique(partners, key),
        "not_null_keys": quality.not_null(partners, key),
        "spine_per_scope": quality.spine_gaps(monthly, params),
        "orphans": quality.orphans(partners, monthly),
    }
