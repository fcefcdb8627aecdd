"""Snapshot store on any file system Spark can write to.

Layout below the root::

    raw/runs/<run>/...                   source files of a run, never rewritten
    snapshots/<run>/<layer>/<relation>   one full snapshot per run
    ops/<table>/run_id=<run>             evidence, replaced per run
    ops/pipeline_runs/run_id=<run>/state=<n>   run rows, appended (0 started, 1 ended)

A snapshot becomes visible when its ended row with ``published_at`` is appended. Nothing a
reader uses is overwritten: an earlier pointer keeps naming complete, untouched files.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.operators import contracts, history
from lakegate.sources import feeds
from lakegate.sources.staging import literal_rows

RUN_SCHEMA = pa.schema(
    [
        ("run_id", pa.string()),
        ("started_at", pa.timestamp("us")),
        ("ended_at", pa.timestamp("us")),
        ("status", pa.string()),
        ("days_requested", pa.int32()),
        ("seed", pa.int32()),
        ("raw_trips", pa.int64()),
        ("silver_trips", pa.int64()),
        ("rejected_trips", pa.int64()),
        ("gold_hourly_rows", pa.int64()),
        ("quality_passed", pa.int32()),
        ("quality_failed", pa.int32()),
        ("data_interval_start", pa.date32()),
        ("data_interval_end", pa.date32()),
        ("source_mode", pa.string()),
        ("replay_of_run_id", pa.string()),
        ("parent_run_id", pa.string()),
        ("code_version", pa.string()),
        ("contract_version", pa.string()),
        ("config_sha256", pa.string()),
        ("input_set_sha256", pa.string()),
        ("output_set_sha256", pa.string()),
        ("error_message", pa.string()),
        ("published_at", pa.timestamp("us")),
    ]
)

_RUN_DDL = (
    "run_id string, started_at timestamp_ntz, ended_at timestamp_ntz, status string, "
    "days_requested int, seed int, raw_trips bigint, silver_trips bigint, rejected_trips bigint, "
    "gold_hourly_rows bigint, quality_passed int, quality_failed int, data_interval_start date, "
    "data_interval_end date, source_mode string, replay_of_run_id string, parent_run_id string, "
    "code_version string, contract_version string, config_sha256 string, "
    "input_set_sha256 string, output_set_sha256 string, error_message string, "
    "published_at timestamp_ntz"
)
_FILE_DDL = (
    "run_id string, dataset_name string, source_file string, file_sha256 string, "
    "file_bytes bigint, row_count bigint, loaded_at timestamp"
)

EVIDENCE = {
    "ingest_files": _FILE_DDL,
    "ingest_parts": _FILE_DDL,
    "quality_results": "run_id string, check_order int, check_name string, status string, "
    "observed_value double, threshold string, details string, checked_at timestamp",
    "dataset_profiles": "run_id string, metric_name string, metric_value double, unit string, "
    "recorded_at timestamp",
    "relation_fingerprints": "run_id string, relation_name string, row_count bigint, "
    "fingerprint_sha256 string, recorded_at timestamp",
    "day_fingerprints": "run_id string, relation_name string, partition_key string, "
    "row_count bigint, sum_0 decimal(38,0), sum_1 decimal(38,0), sum_2 decimal(38,0), "
    "sum_3 decimal(38,0), recorded_at timestamp",
    "drift_results": "run_id string, baseline_run_id string, metric_name string, "
    "current_value double, baseline_value double, delta double, delta_kind string, "
    "threshold double, status string, checked_at timestamp",
}


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def raw_root(self) -> str:
        return f"{self.root}/raw"

    def _snapshot_path(self, run_id: str, relation: str) -> str:
        return f"{self.root}/snapshots/{run_id}/{relation.replace('.', '/')}"

    # --- snapshot relations ------------------------------------------------------------

    def write(
        self, run_id: str, relation: str, df: DataFrame, *, partition_by: str | None = None
    ) -> DataFrame:
        """Write one relation of a candidate snapshot and read it back.

        With a partition column the rows are rebalanced on it first: files are neither tiny
        nor does a day with most of the rows end up in one task.
        """
        path = self._snapshot_path(run_id, relation)
        if partition_by:
            df.hint("rebalance", partition_by).write.partitionBy(partition_by).mode(
                "overwrite"
            ).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def write_judged(self, run_id: str, feed: str, judged: DataFrame) -> None:
        """Split accepted from quarantined rows in the one pass that writes them."""
        outcome = F.when(F.col(contracts.REASON).isNull(), "accepted").otherwise("rejected")
        judged.withColumn("outcome", outcome).write.partitionBy("outcome").mode(
            "overwrite"
        ).parquet(self._snapshot_path(run_id, f"silver.{feed}_contract"))

    def judged(self, run_id: str, feed: str, like: DataFrame) -> DataFrame:
        schema = like.withColumn("outcome", F.lit("")).schema
        return (
            self.spark.read.schema(schema)
            .parquet(self._snapshot_path(run_id, f"silver.{feed}_contract"))
            .select(*like.columns, "outcome")
        )

    def read(self, run_id: str, relation: str) -> DataFrame:
        """A stored relation by its logical name, e.g. ``silver.trips``."""
        quarantine = {
            "silver.trips": ("trips", "accepted"),
            "silver.trip_rejections": ("trips", "rejected"),
            "silver.payments": ("payments", "accepted"),
            "silver.payment_rejections": ("payments", "rejected"),
        }
        if relation not in quarantine:
            return self.spark.read.parquet(self._snapshot_path(run_id, relation))
        feed, outcome = quarantine[relation]
        stored = self.spark.read.parquet(self._snapshot_path(run_id, f"silver.{feed}_contract"))
        rows = stored.where(F.col("outcome") == outcome).drop("outcome")
        return rows.drop(contracts.REASON) if outcome == "accepted" else rows

    # --- evidence ----------------------------------------------------------------------

    def write_evidence(self, table: str, run_id: str, rows: DataFrame) -> DataFrame:
        """Replace a run's rows of one table. An empty frame removes the old rows."""
        columns = [field.split()[0] for field in EVIDENCE[table].split(", ")]
        stamped = rows.withColumn(columns[-1], F.current_timestamp())
        stamped.select(*columns[1:]).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/ops/{table}/run_id={run_id}"
        )
        return self.evidence(table).where(F.col("run_id") == run_id)

    def evidence(self, table: str) -> DataFrame:
        return self._read_or_empty(f"{self.root}/ops/{table}", EVIDENCE[table])

    def _read_or_empty(self, path: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    # --- run history -------------------------------------------------------------------

    def append_run(self, row: dict, state: int) -> None:
        values = tuple(row.get(name) for name in RUN_SCHEMA.names)
        frame = literal_rows(self.spark, RUN_SCHEMA, [values]).drop("run_id")
        frame.coalesce(1).write.mode("errorifexists").parquet(
            f"{self.root}/ops/pipeline_runs/run_id={row['run_id']}/state={state}"
        )

    def runs(self) -> DataFrame:
        """Newest row of every run; columns added later read as NULL in older rows."""
        stored = self._read_or_empty(f"{self.root}/ops/pipeline_runs", f"{_RUN_DDL}, state int")
        newest = stored.groupBy("run_id").agg(
            F.max_by(F.struct(*stored.columns), "state").alias("row")
        )
        return newest.select("row.*").drop("state")

    def published_run_id(self) -> str | None:
        rows = history.latest_published(self.runs()).select("run_id").collect()
        return rows[0]["run_id"] if rows else None

    def read_published(self, relation: str) -> DataFrame:
        run_id = self.published_run_id()
        if run_id is None:
            raise LookupError("No published snapshot exists yet.")
        return self.read(run_id, relation)

    # --- readiness ---------------------------------------------------------------------

    def present(
        self, relations: Iterable[str] = m.REQUIRED_RELATIONS, run_id: str | None = None
    ) -> list[str]:
        """Those of the relations that a run has, by default the published one."""
        run_id = run_id or self.published_run_id()
        return [name for name in relations if self._exists(name, run_id)]

    def _exists(self, relation: str, run_id: str | None) -> bool:
        layer, table = relation.split(".")
        path = f"{self.root}/ops/{table}"
        if layer != "ops":
            if run_id is None:
                return False
            path = self._snapshot_path(run_id, relation)
        try:
            self.spark.read.parquet(path)
        except AnalysisException:
            return False
        return True

    def readiness(self) -> DataFrame:
        schema = pa.schema([("relation_name", pa.string())])
        found = set(self.present())
        missing = [(name,) for name in m.REQUIRED_RELATIONS if name not in found]
        return feeds.readiness(literal_rows(self.spark, schema, missing), self.runs())
