"""Evidence rows keyed by run: replacement, default run, roll-ups and the run investigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.functions import temporal
from lakegate.functions.numeric import scaled_round
from lakegate.operators import history, joins, manifests


def upsert(existing: DataFrame, replaced_runs: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Replace the evidence of the given runs. A run with no new rows loses its old ones."""
    return existing.join(replaced_runs.select("run_id"), "run_id", "left_anti").unionByName(
        new_rows
    )


def of_run(rows: DataFrame, pointer: DataFrame) -> DataFrame:
    """Evidence of the run named by a frame of at most one row."""
    return rows.join(F.broadcast(pointer.select("run_id")), "run_id", "left_semi")


def run_or_default(rows: DataFrame, run_id: str | None, default: DataFrame) -> DataFrame:
    return rows.where(F.col("run_id") == run_id) if run_id else of_run(rows, default)


def quality_by_run(checks: DataFrame, runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """Checks of a run, by default the latest published one."""
    return run_or_default(checks, run_id, history.latest_published(runs)).orderBy("check_name")


def files_by_run(files: DataFrame, runs: DataFrame, run_id: str | None = None) -> DataFrame:
    return run_or_default(files, run_id, history.latest_published(runs)).orderBy("dataset_name")


def drift_by_run(drift: DataFrame, runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """Drift rows of a run, by default the latest *started* one, even if it failed."""
    return run_or_default(drift, run_id, history.latest_started(runs))


def finish_runs(runs: DataFrame, finished: DataFrame) -> DataFrame:
    """Apply final values to the runs that ended; ``published_at`` only if published.

    ``finished`` has one row per ended run with the final columns and ``published``.
    """
    values = [name for name in finished.columns if name not in ("run_id", "published")]
    final = finished.select(
        F.col("run_id").alias("__run"),
        "published",
        *[F.col(name).alias(f"__{name}") for name in values],
    )
    is_done = F.col("__run").isNotNull()

    def value(name: str) -> Column:
        if name == "published_at":
            taken = F.when(is_done & F.col("published"), F.col("__ended_at"))
            return F.coalesce(taken, F.col("published_at"))
        if name in values:
            return F.when(is_done, F.col(f"__{name}")).otherwise(F.col(name))
        return F.col(name)

    return runs.join(final, F.col("run_id") == F.col("__run"), "left").select(
        *[value(name).alias(name) for name in runs.columns]
    )


_COMPARED = ("silver_trips", "rejected_trips", "gold_hourly_rows")
_TOTALS = ("source_rows", "source_bytes")


def run_details(runs: DataFrame, files: DataFrame) -> DataFrame:
    """One wide row per run: runtime, pointer flag, previous published run and deltas.

    Manifest totals ride along in the previous run's struct, so they are joined once.
    """
    totals = manifests.manifest_totals(files).withColumnRenamed("run_id", "__totals_run")
    counted = (
        joins.with_row_id(runs)
        .join(totals, F.col("run_id") == F.col("__totals_run"), "left")
        .drop("__totals_run")
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in _TOTALS})
    )
    current = history.latest_published(runs).select("run_id").scalar()
    splits = joins.key_splits(runs, "started_at")
    linked = history.previous_published(counted, (*_COMPARED, *_TOTALS), splits=splits)
    detailed = history.with_deltas(linked).withColumns(
        {
            "runtime_seconds": scaled_round(
                temporal.runtime_seconds(F.col("started_at"), F.col("ended_at")), 3
            ),
            "is_current_snapshot": F.col("run_id") == current,
            "previous_published_run_id": F.col("previous.run_id"),
            **{
                f"{name}_delta": F.col(name) - F.coalesce(F.col(f"previous.{name}"), F.lit(0))
                for name in _TOTALS
            },
        }
    )
    return history.public_runs(detailed).drop("previous", "published")


def run_detail(runs: DataFrame, files: DataFrame, run_id: str) -> DataFrame:
    """The investigation row of one run, without touching the others' history twice."""
    selected = runs.where(F.col("run_id") == run_id)
    started = selected.select("started_at").scalar()
    earlier = history.published(runs).where(F.col("started_at") < started)
    previous = (
        earlier.orderBy(F.desc("published_at"), F.desc("run_id"))
        .limit(1)
        .select(F.struct("published_at", "run_id", *_COMPARED).alias("previous"))
    )
    linked = selected.join(F.broadcast(previous), F.lit(True), "left")  # one row each
    own = manifests.manifest_totals(files.where(F.col("run_id") == run_id), ())
    before = manifests.manifest_totals(of_run(files, previous.select("previous.run_id")), ())
    current = history.latest_published(runs).select("run_id").scalar()
    detailed = history.with_deltas(linked).withColumns(
        {
            "runtime_seconds": scaled_round(
                temporal.runtime_seconds(F.col("started_at"), F.col("ended_at")), 3
            ),
            "is_current_snapshot": F.col("run_id") == current,
            "previous_published_run_id": F.col("previous.run_id"),
            **{name: own.select(name).scalar() for name in _TOTALS},
            **{
                f"{name}_delta": own.select(name).scalar() - before.select(name).scalar()
                for name in _TOTALS
            },
        }
    )
    return history.public_runs(detailed).drop("previous")
