"""Read side: filtered analytics and evidence of the published snapshot."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.operators import evidence, history, marts, profiles, rollups, serving
from lakegate.operators.filters import FactFilter
from lakegate.sources.store import SnapshotStore


class PublishedSnapshot:
    """Queries against the run the pointer names when the object is made.

    Arguments are validated before a job is planned: ``ValueError`` for bad bounds,
    ``LookupError`` for an unknown run or a store without a published snapshot.
    """

    def __init__(self, store: SnapshotStore) -> None:
        run_id = store.published_run_id()
        if run_id is None:
            raise LookupError("No published snapshot exists yet.")
        self.store = store
        self.run_id = run_id

    def _relation(self, name: str) -> DataFrame:
        return self.store.read(self.run_id, name)

    def _rollup(self) -> DataFrame | None:
        """The stored roll-up; a snapshot of an earlier version has none, and the fact is read."""
        held = self.store.present([rollups.RELATION], self.run_id)
        return self._relation(rollups.RELATION) if held else None

    @staticmethod
    def _where(
        start_date: date | None, end_date: date | None, zone_id: str | None, rider_type: str | None
    ) -> FactFilter:
        return FactFilter(start_date, end_date, zone_id, rider_type)

    # --- analytics ---------------------------------------------------------------------

    def summary(
        self,
        start_date: date | None = None,
        end_date: date | None = None,
        zone_id: str | None = None,
        rider_type: str | None = None,
    ) -> DataFrame:
        where = self._where(start_date, end_date, zone_id, rider_type)
        rollup = self._rollup()
        figures = (
            marts.headline(where.apply(self._relation("silver.trip_enriched")))
            if rollup is None
            else rollups.headline(rollup, where)
        )
        return serving.with_context(
            figures,
            self._relation("silver.trip_rejections"),
            self._relation("silver.payment_rejections"),
            self.store.runs(),
        )

    def timeseries(self, start_date=None, end_date=None, zone_id=None, rider_type=None):
        where = self._where(start_date, end_date, zone_id, rider_type)
        rollup = self._rollup()
        if rollup is None:
            return serving.timeseries(self._relation("silver.trip_enriched"), where)
        return rollups.timeseries(rollup, where)

    def zones(self, start_date=None, end_date=None, zone_id=None, rider_type=None):
        where = self._where(start_date, end_date, zone_id, rider_type)
        rollup = self._rollup()
        if rollup is None:
            return serving.zones(self._relation("silver.trip_enriched"), where)
        return rollups.zones(rollup, where)

    def stations(
        self,
        limit: int = m.STATION_LIMIT_DEFAULT,
        start_date=None,
        end_date=None,
        zone_id=None,
        rider_type=None,
    ):
        where = self._where(start_date, end_date, zone_id, rider_type)
        rollup = self._rollup()
        if rollup is None:
            return serving.stations(self._relation("silver.trip_enriched"), where, limit)
        return rollups.stations(rollup, where, limit)

    def filter_window(self) -> DataFrame:
        return serving.filter_window(self._relation("silver.trip_enriched"))

    def filter_zones(self) -> DataFrame:
        return serving.filter_zones(self._relation("silver.trip_enriched"))

    def lineage(self) -> DataFrame:
        return self._relation("gold.lineage_edges")

    def dashboard_summary(self) -> DataFrame:
        return self._relation("gold.dashboard_summary")

    # --- evidence ----------------------------------------------------------------------

    def quality(self, run_id: str | None = None) -> DataFrame:
        checks = self.store.evidence("quality_results").drop("check_order")
        return evidence.quality_by_run(checks, self.store.runs(), run_id)

    def ingest_files(self, run_id: str | None = None) -> DataFrame:
        return evidence.files_by_run(
            self.store.evidence("ingest_files"), self.store.runs(), run_id
        )

    def drift(self, run_id: str | None = None) -> DataFrame:
        """Drift rows of a run, by default the latest started one."""
        if run_id is not None:
            self._known(run_id)
        rows = evidence.drift_by_run(
            self.store.evidence("drift_results"), self.store.runs(), run_id
        )
        return profiles.in_priority_order(rows)

    def drift_summary(self, run_id: str | None = None) -> DataFrame:
        return profiles.drift_rollup(self.drift(run_id))

    def pipeline_runs(self) -> DataFrame:
        return history.recent_runs(self.store.runs())

    def latest_status(self) -> DataFrame:
        return history.latest_status(self.store.runs())

    def run_detail(self, run_id: str) -> dict[str, DataFrame]:
        """The investigation of one run: its wide row and five evidence lists."""
        if not re.fullmatch(m.RUN_ID_PATTERN, run_id):
            raise ValueError("run_id has the wrong format")
        self._known(run_id)

        def rows(table: str, order: str) -> DataFrame:
            of_run = self.store.evidence(table).where(F.col("run_id") == run_id)
            return of_run.drop("run_id").orderBy(order)

        files = self.store.evidence("ingest_files")
        return {
            "run": evidence.run_detail(self.store.runs(), files, run_id),
            "quality": rows("quality_results", "check_name"),
            "manifests": rows("ingest_files", "dataset_name"),
            "profiles": rows("dataset_profiles", "metric_name"),
            "fingerprints": rows("relation_fingerprints", "relation_name"),
            "drift": profiles.in_priority_order(rows("drift_results", "metric_name")),
        }

    def _known(self, run_id: str) -> None:
        if self.store.runs().where(F.col("run_id") == run_id).isEmpty():
            raise LookupError(f"Pipeline run not found: {run_id}")
