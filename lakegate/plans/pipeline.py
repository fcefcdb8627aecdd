"""Build, gate, publish and replay snapshots."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta
from functools import partial
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate import __version__
from lakegate.bindings import mobility as m
from lakegate.operators import (
    contracts,
    enrich,
    fingerprints,
    history,
    lineage,
    manifests,
    marts,
    profiles,
    quality,
    rollups,
)
from lakegate.sources import feeds, files
from lakegate.sources.staging import together
from lakegate.sources.store import SnapshotStore

Paths = Mapping[str, list[str]]

_REFUSED = {
    "escapes_root": "Replay manifest leaves the raw-data root",
    "missing": "Replay source file is missing",
    "size_mismatch": "Replay source size mismatch",
    "sha_mismatch": "Replay source SHA-256 mismatch",
}


#: Days named in a replay's error; the evidence holds all of them.
_NAMED_DAYS = 5


class SnapshotError(RuntimeError):
    """A candidate that must not be published."""


@dataclass(frozen=True)
class RunSpec:
    days: int
    seed: int
    interval_start: date
    interval_end: date
    source_mode: str = "generated"
    replay_of: str | None = None
    expected_input: str | None = None
    expected_output: str | None = None


@dataclass(frozen=True)
class RunResult:
    run_id: str
    status: str
    published: bool
    counts: dict[str, int]
    input_set_sha256: str
    output_set_sha256: str
    baseline_run_id: str | None
    checks: list[dict] = field(default_factory=list)

    @property
    def failed_checks(self) -> list[str]:
        return [check["check_name"] for check in self.checks if check["status"] != "pass"]


def resolve_interval(
    days: int, as_of: date | None = None, today: date | None = None
) -> tuple[date, date]:
    """Inclusive window of ``days`` days ending on ``as_of``, by default yesterday."""
    if days < 2:
        raise ValueError("days must be at least 2")
    yesterday = (today or datetime.now(UTC).date()) - timedelta(days=1)
    end = as_of or yesterday
    if end > yesterday:
        raise ValueError("as_of cannot be later than yesterday")
    return end - timedelta(days=days - 1), end


def config_hash(days: int, seed: int, interval_end: date) -> str:
    """FIXED FORMAT: SHA-256 of compact JSON with sorted keys."""
    settings = {
        "as_of_date": interval_end.isoformat(),
        "contract_version": m.CONTRACT_VERSION,
        "days": days,
        "seed": seed,
    }
    text = json.dumps(settings, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


class SnapshotPipeline:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.store = SnapshotStore(spark, root)

    # --- entry points ------------------------------------------------------------------

    def run(
        self,
        sources: Paths,
        *,
        days: int,
        seed: int = 0,
        as_of: date | None = None,
        fail_on_quality: bool = True,
    ) -> RunResult:
        """Build a snapshot from CSV files and publish it if every check passes.

        ``fail_on_quality=False`` publishes a failing candidate as ``failed_quality``.
        """
        if set(sources) != set(m.DATASETS):
            raise ValueError(f"sources must name exactly {', '.join(m.DATASETS)}")
        start, end = resolve_interval(days, as_of)
        spec = RunSpec(days, seed, start, end)
        return self._execute(spec, fail_on_quality, lambda _: sources)

    def replay(self, run_id: str, *, fail_on_quality: bool = True) -> RunResult:
        """Rebuild an earlier run from its unchanged files and demand equal hashes."""
        spec = self._replay_spec(run_id)
        return self._execute(spec, fail_on_quality, self._verified_sources)

    # --- replay ------------------------------------------------------------------------

    def _replay_spec(self, run_id: str) -> RunSpec:
        if not run_id.strip():
            raise ValueError("run_id must not be empty")
        rows = self.store.runs().where(F.col("run_id") == run_id).collect()
        if not rows:
            raise LookupError(f"Replay source run does not exist: {run_id}")
        row = rows[0]
        inherited = (
            "days_requested",
            "seed",
            "data_interval_start",
            "data_interval_end",
            "contract_version",
            "config_sha256",
            "input_set_sha256",
            "output_set_sha256",
        )
        if any(row[name] is None for name in inherited):
            raise ValueError(f"Run {run_id} has no complete replay record.")
        if row["contract_version"] != m.CONTRACT_VERSION:
            raise ValueError(f"Run {run_id} was built under {row['contract_version']}.")
        days, seed, end = row["days_requested"], row["seed"], row["data_interval_end"]
        if config_hash(days, seed, end) != row["config_sha256"]:
            raise SnapshotError(f"Recorded configuration hash is invalid for run {run_id}.")
        return RunSpec(
            days,
            seed,
            row["data_interval_start"],
            end,
            source_mode="replay",
            replay_of=run_id,
            expected_input=row["input_set_sha256"],
            expected_output=row["output_set_sha256"],
        )

    def _verified_sources(self, spec: RunSpec) -> Paths:
        """Files of the source run, after checking set, hash, place, size and content."""
        of_run = F.col("run_id") == spec.replay_of
        recorded_sets = self.store.evidence("ingest_files").where(of_run)
        names = [row["dataset_name"] for row in recorded_sets.collect()]  # one per dataset
        if sorted(names) != sorted(m.DATASETS):
            raise SnapshotError(f"Replay needs a complete manifest of run {spec.replay_of}.")
        if _only(manifests.input_set_hash(recorded_sets)) != spec.expected_input:
            raise SnapshotError(
                f"Recorded input manifest fingerprint is invalid for run {spec.replay_of}."
            )
        parts = self.store.evidence("ingest_parts").where(of_run).drop("run_id")
        outside = parts.where(manifests.escapes_root(F.col("source_file"))).take(1)
        if outside:
            raise SnapshotError(f"{_REFUSED['escapes_root']}: {outside[0]['source_file']}")
        folder = F.regexp_replace("source_file", "/?[^/]*$", "")
        folders = [row[0] for row in parts.select(folder).distinct().collect()]
        places = [f"{self.store.raw_root}/{name}".rstrip("/") for name in folders]
        try:
            found = files.file_hashes(self.spark, places)
        except AnalysisException as error:
            raise SnapshotError(f"{_REFUSED['missing']}: {places}") from error
        located = found.withColumn(
            "source_file", files.relative_to(F.col("path"), self.store.raw_root)
        )
        verdicts = manifests.verify_manifest(parts, located, ("source_file",))
        bad = verdicts.where(~F.col("verdict").isin("complete", "unexpected")).take(1)
        if bad:
            raise SnapshotError(f"{_REFUSED[bad[0]['verdict']]}: {bad[0]['source_file']}")
        listed = parts.select("dataset_name", "source_file").collect()
        return {
            name: sorted(
                f"{self.store.raw_root}/{row['source_file']}"
                for row in listed
                if row["dataset_name"] == name
            )
            for name in m.DATASETS
        }

    # --- one run -----------------------------------------------------------------------

    def _execute(self, spec: RunSpec, fail_on_quality: bool, sources_of) -> RunResult:
        run_id = f"{_now():%Y%m%d%H%M%S}-{uuid4().hex[:8]}"
        row = {
            "run_id": run_id,
            "started_at": _now(),
            "status": "running",
            "days_requested": spec.days,
            "seed": spec.seed,
            "data_interval_start": spec.interval_start,
            "data_interval_end": spec.interval_end,
            "source_mode": spec.source_mode,
            "replay_of_run_id": spec.replay_of,
            "parent_run_id": self.store.published_run_id(),
            "code_version": __version__,
            "contract_version": m.CONTRACT_VERSION,
            "config_sha256": config_hash(spec.days, spec.seed, spec.interval_end),
        }
        self.store.append_run(row, 0)
        try:
            result = self._build(run_id, spec, sources_of(spec), row)
        except Exception as error:
            # Evidence written so far stays; the pointer is untouched.
            self._finish(row, status="failed", published=False, error_message=str(error))
            raise
        failed = result.failed_checks
        published = not failed or not fail_on_quality
        status = "failed_quality" if failed else "success"
        message = f"Quality checks failed: {', '.join(failed)}" if failed else None
        self._finish(
            row,
            status=status,
            published=published,
            error_message=None if published else message,
        )
        if not published:
            raise SnapshotError(message)
        return RunResult(**{**result.__dict__, "status": status, "published": True})

    def _finish(self, row: dict, *, status: str, published: bool, error_message: str | None):
        ended = _now()
        row |= {"status": status, "ended_at": ended, "error_message": error_message}
        if published:
            row["published_at"] = ended
        self.store.append_run(row, 1)

    def _build(self, run_id: str, spec: RunSpec, sources: Paths, row: dict) -> RunResult:
        store = self.store
        bronze, input_hash = self._load_bronze(run_id, sources)
        row["input_set_sha256"] = input_hash
        if spec.expected_input not in (None, input_hash):
            raise SnapshotError(
                "Replay input fingerprint mismatch: source bytes changed while loading."
            )

        def judge(feed: str, contract: contracts.Contract) -> DataFrame:
            classified = contracts.apply_contract(bronze[feed], contract)
            store.write_judged(run_id, feed, classified)
            return store.judged(run_id, feed, classified)

        def type_dimension(feed: str, name: str, fields: tuple) -> DataFrame:
            return store.write(run_id, name, contracts.conform(bronze[feed], fields))

        judged = together(
            {
                "trips": lambda: judge("trips", m.TRIP_CONTRACT),
                "payments": lambda: judge("payments", m.PAYMENT_CONTRACT),
                "stations": lambda: type_dimension(
                    "stations", "silver.stations", m.STATION_FIELDS
                ),
                "weather": lambda: type_dimension(
                    "weather", "silver.weather_hourly", m.WEATHER_FIELDS
                ),
            }
        )
        trips = _outcome(judged["trips"], "accepted").drop(contracts.REASON)
        payments = _outcome(judged["payments"], "accepted").drop(contracts.REASON)
        enriched = store.write(
            run_id,
            "silver.trip_enriched",
            enrich.enrich_trips(
                trips, payments, judged["stations"], judged["weather"], m.ENRICHED_COLUMNS
            ),
            partition_by="trip_date",
        )

        gold = {
            "gold.hourly_mobility": marts.hourly_mobility(enriched),
            "gold.daily_station_performance": marts.daily_station_performance(enriched),
            "gold.revenue_by_zone": marts.revenue_by_zone(enriched),
            "gold.dashboard_summary": marts.dashboard_summary(
                enriched,
                _outcome(judged["trips"], "rejected"),
                _outcome(judged["payments"], "rejected"),
            ),
            "gold.lineage_edges": lineage.lineage_edges(self.spark),
        }
        stored = together(
            {
                **{name: partial(store.write, run_id, name, df) for name, df in gold.items()},
                rollups.RELATION: partial(
                    store.write,
                    run_id,
                    rollups.RELATION,
                    rollups.trip_rollup(enriched),
                    partition_by="trip_date",
                ),
            }
        )
        relations = {
            "silver.trips": trips,
            "silver.payments": payments,
            "silver.trip_enriched": enriched,
            **stored,
        }

        measured = store.write_evidence(
            "dataset_profiles",
            run_id,
            profiles.dataset_profiles(
                trips, enriched, stored["gold.hourly_mobility"], spec.days
            ),
        )
        by_day = store.write_evidence(
            "day_fingerprints",
            run_id,
            fingerprints.relation_day_sums(relations, m.FINGERPRINTS, m.FINGERPRINT_DAYS),
        )
        prints = store.write_evidence(
            "relation_fingerprints",
            run_id,
            fingerprints.from_day_sums(by_day, list(m.FINGERPRINTS)),
        )
        output_hash = _only(fingerprints.output_set_hash(prints))
        row["output_set_sha256"] = output_hash
        if spec.expected_output not in (None, output_hash):
            raise SnapshotError(
                "Replay output fingerprint mismatch: the rebuilt snapshot is not equivalent."
                + self._differing_days(spec.replay_of, by_day)
            )

        baseline = history.baseline_for(store.runs(), run_id, spec.days, m.CONTRACT_VERSION)
        baseline_ids = [found["run_id"] for found in baseline.select("run_id").collect()]
        drift = self._drift(run_id, baseline_ids, measured)
        checks = store.write_evidence(
            "quality_results",
            run_id,
            quality.quality_checks(
                judged["trips"],
                judged["payments"],
                enriched,
                spec.interval_end,
                drift=drift if baseline_ids else None,
            ),
        )
        outcome = [found.asDict() for found in checks.orderBy("check_order").collect()]
        values = {check["check_name"]: check["observed_value"] for check in outcome}
        counts = {
            "raw_trips": int(values["raw_trips_loaded"]),
            "silver_trips": int(values["silver_trips_loaded"]),
            "rejected_trips": int(values["trip_contract_rejections"]),
            "gold_hourly_rows": stored["gold.hourly_mobility"].count(),
        }
        passed = sum(check["status"] == "pass" for check in outcome)
        row |= counts
        row |= {"quality_passed": passed, "quality_failed": len(outcome) - passed}
        return RunResult(
            run_id=run_id,
            status="running",
            published=False,
            counts=counts,
            input_set_sha256=input_hash,
            output_set_sha256=output_hash,
            baseline_run_id=baseline_ids[0] if baseline_ids else None,
            checks=outcome,
        )

    def _differing_days(self, source_run: str, rebuilt: DataFrame) -> str:
        """The first days that a replay built otherwise; empty if the source run kept none."""
        stored = self.store.evidence("day_fingerprints").where(F.col("run_id") == source_run)
        compared = fingerprints.compare_days(stored, rebuilt).where(~F.col("equivalent"))
        first = compared.orderBy("relation_name", "partition_key").limit(_NAMED_DAYS).collect()
        named = ", ".join(f"{r['relation_name']} {r['partition_key']}".strip() for r in first)
        return f" Differing: {named}." if named else ""

    def _load_bronze(self, run_id: str, sources: Paths) -> tuple[dict[str, DataFrame], str]:
        """Store the feeds with provenance and record what was read."""
        store = self.store
        raw = {name: feeds.read_feed(self.spark, name, sources[name]) for name in sources}
        origin = files.relative_to(files.plain_path(F.col("_metadata.file_path")), store.raw_root)
        loaded = {
            name: feeds.with_provenance(df, run_id, origin) for name, df in raw.items()
        }
        bronze = together(
            {
                name: partial(store.write, run_id, f"bronze.{name}", df)
                for name, df in loaded.items()
            }
        )
        parts = store.write_evidence(
            "ingest_parts",
            run_id,
            files.file_manifest(self.spark, raw, sources, store.raw_root),
        )
        manifest = store.write_evidence("ingest_files", run_id, files.dataset_manifest(parts))
        return bronze, _only(manifests.input_set_hash(manifest))

    def _drift(self, run_id: str, baseline_ids: list[str], current: DataFrame) -> DataFrame:
        """Nine rows against the baseline; no rows (and none left over) without one."""
        earlier = self.store.evidence("dataset_profiles").where(
            F.col("run_id").isin(baseline_ids) if baseline_ids else F.lit(False)
        )
        pairs = current.select("run_id").limit(1).withColumn(
            "baseline_run_id", F.lit(baseline_ids[0] if baseline_ids else None).cast("string")
        )
        rows = profiles.compare_profiles(pairs, current.unionByName(earlier))
        return self.store.write_evidence(
            "drift_results", run_id, rows if baseline_ids else rows.limit(0)
        )


def _outcome(judged: DataFrame, outcome: str) -> DataFrame:
    return judged.where(F.col("outcome") == outcome).drop("outcome")


def _only(df: DataFrame) -> str:
    return df.collect()[0][0]  # a one-row, one-column frame


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)
