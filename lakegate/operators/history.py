"""Run history: publication pointer, baselines, previous runs and public run rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions import temporal
from lakegate.functions.numeric import ratio, scaled_round
from lakegate.operators import joins, ranges
from lakegate.sources.staging import stage_measured


def published(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("published_at").isNotNull())


def latest_published(runs: DataFrame) -> DataFrame:
    """The run readers see: newest ``published_at``, run id on ties. At most one row."""
    return published(runs).orderBy(F.desc("published_at"), F.desc("run_id")).limit(1)


def latest_started(runs: DataFrame, k: int = 1) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(k)


# --- baselines -------------------------------------------------------------------------

_BASELINE_ORDER = ("published_at", "ended_at", "started_at")


def baseline_for(runs: DataFrame, run_id: str, days: int, contract_version: str) -> DataFrame:
    """Latest other published run with the same window length and contract."""
    candidates = published(runs).where(
        (F.col("run_id") != run_id)
        & (F.col("days_requested") == days)
        & (F.col("contract_version") == contract_version)
    )
    order = [F.desc_nulls_last(name) for name in _BASELINE_ORDER]
    return candidates.orderBy(*order, F.desc("run_id")).limit(1)


def baselines(runs: DataFrame) -> DataFrame:
    """The compatible baseline of every run: (run_id, baseline_run_id).

    Within one (days, contract) group every run shares the same best candidate, except the
    best run itself, which takes the runner-up. Two partially aggregated maxima replace a
    ranking window, whose few groups would each sort in a single task; the per-group results
    go back to the runs by a size-checked lookup.
    """
    group = F.concat(F.col("days_requested").cast("string"), F.lit("/"), "contract_version")
    missing = F.lit("0001-01-01").cast("timestamp_ntz")
    candidate = F.struct(
        *[F.coalesce(F.col(name), missing).alias(name) for name in _BASELINE_ORDER], "run_id"
    )
    grouped = joins.with_row_id(runs).withColumn("__group", group)
    candidates = published(grouped).select(
        "__group", candidate.alias("candidate"), joins.ROW_ID
    )

    def per_group(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
        top = rows.groupBy("__group").agg(F.max("candidate").alias(name))
        flat = top.select(F.col("__group").alias(f"__{name}_group"), f"{name}.run_id")
        return stage_measured(flat.withColumnRenamed("run_id", name), name)

    def attach(rows: DataFrame, top: DataFrame, name: str, size: int) -> DataFrame:
        key = f"__{name}_group"
        splits = None if size <= joins.BROADCAST_LIMIT_BYTES else joins.key_splits(rows, "__group")
        return joins.lookup_join(rows, top, "__group", key, right_bytes=size, splits=splits).drop(key)

    best, best_size = per_group(candidates, "best")
    others = attach(candidates, best, "best", best_size).where(
        F.col("candidate.run_id") != F.col("best")
    )
    second, second_size = per_group(others, "second")
    ranked = attach(attach(grouped, best, "best", best_size), second, "second", second_size)
    chosen = F.when(F.col("run_id") == F.col("best"), F.col("second")).otherwise(F.col("best"))
    return ranked.select("run_id", chosen.alias("baseline_run_id"))


# --- previous published run ------------------------------------------------------------


def previous_published(
    runs: DataFrame,
    carry: Sequence[str] = (),
    *,
    splits: DataFrame | None = None,
) -> DataFrame:
    """For every run, the newest published run among those started strictly earlier.

    Adds ``previous``, a struct of ``published_at``, ``run_id`` and the ``carry`` columns. Runs
    are first reduced to one row per distinct start time, and a running maximum is taken over
    these in ranges of start time; rows are not compared with each other, as a theta join would.
    However the start times lie, on one day or over years, all tasks get about equally many.
    ``splits`` are the heavy start times (:func:`joins.key_splits`), if the caller has them.
    """
    best = F.struct("published_at", "run_id", *carry)
    starts = runs.groupBy("started_at").agg(
        F.max(F.when(F.col("published_at").isNotNull(), best)).alias("__best")
    )
    resolved = ranges.exclusive_scan(starts, "started_at", F.col("__best"), "previous").select(
        F.col("started_at").alias("__start"), "previous"
    )
    if splits is None:
        splits = joins.key_splits(runs, "started_at")
    return joins.salted_left_join(
        joins.with_row_id(runs), resolved, "started_at", "__start", splits
    ).drop("__start", joins.ROW_ID)


_COMPARED = ("silver_trips", "rejected_trips", "gold_hourly_rows")


def with_deltas(current: DataFrame) -> DataFrame:
    """Current minus previous counts; NULL when there is no previous run."""
    deltas = [
        (F.col(name) - F.col(f"previous.{name}")).alias(f"{name}_delta") for name in _COMPARED
    ]
    percent = (
        (F.col("silver_trips") - F.col("previous.silver_trips")).cast("double")
        * F.lit(100.0)
        / F.nullif(F.col("previous.silver_trips").cast("double"), F.lit(0.0))
    )
    return current.select(
        "*", *deltas, scaled_round(percent, 2).alias("silver_trips_delta_percent")
    )


def run_deltas(runs: DataFrame) -> DataFrame:
    linked = previous_published(runs, _COMPARED)
    return with_deltas(linked).select(
        "run_id",
        F.col("previous.run_id").alias("previous_published_run_id"),
        *[f"{name}_delta" for name in _COMPARED],
        "silver_trips_delta_percent",
    )


# --- public run rows -------------------------------------------------------------------


def failure_summary(status: Column, error_message: Column) -> Column:
    """Safe public text for a run's outcome; NULL for a run without a failure."""
    state = F.lower(F.coalesce(status, F.lit("")))
    message = F.lower(F.coalesce(error_message, F.lit("")))
    replayed = message.contains(m.REPLAY_MARKER)
    output_differs = message.contains(m.REPLAY_OUTPUT_MARKER) | (
        replayed & message.contains(m.NOT_EQUIVALENT_MARKER)
    )
    input_differs = (
        replayed | message.contains(m.MANIFEST_MARKER) | message.contains(m.CONFIG_MARKER)
    )
    return (
        F.when((state == "failed_quality") | message.startswith(m.GATE_MESSAGE), m.FAILED_GATE)
        .when(output_differs, m.FAILED_REPLAY_OUTPUT)
        .when(input_differs, m.FAILED_REPLAY_INPUT)
        .when((state == "failed") | (message != ""), m.FAILED_OTHER)
    )


def status_label(status: Column, published_at: Column) -> Column:
    """Short label shown for a run."""
    is_published = published_at.isNotNull()
    pretty = F.initcap(F.replace(F.coalesce(status, F.lit("unknown")), F.lit("_"), F.lit(" ")))
    return (
        F.when((status == "failed_quality") & is_published, "Published with failed gates")
        .when(status == "failed_quality", "Quality failed")
        .when(status == "failed", "Failed")
        .when(status == "running", "Running")
        .when(is_published, "Published")
        .when(status == "success", "Succeeded")
        .otherwise(pretty)
    )


def display_seconds(started: Column, ended: Column) -> Column:
    """Run duration for display: never negative, NULL while running."""
    seconds = scaled_round(temporal.runtime_seconds(started, ended), 3)
    return F.when(seconds.isNotNull(), F.greatest(seconds, F.lit(0.0)))


def public_runs(runs: DataFrame) -> DataFrame:
    """Replace the raw error message by its safe summary."""
    summary = failure_summary(F.col("status"), F.col("error_message"))
    return runs.withColumn("failure_summary", summary).drop("error_message")


RECENT_COLUMNS = (
    "run_id",
    "started_at",
    "ended_at",
    "status",
    "days_requested",
    "seed",
    "data_interval_start",
    "data_interval_end",
    "source_mode",
    "replay_of_run_id",
    "parent_run_id",
    "raw_trips",
    "silver_trips",
    "rejected_trips",
    "gold_hourly_rows",
    "quality_passed",
    "quality_failed",
    "published_at",
    "contract_version",
    "input_set_sha256",
    "output_set_sha256",
    "error_message",
)


def recent_runs(runs: DataFrame, k: int = m.RECENT_RUNS) -> DataFrame:
    return public_runs(latest_started(runs, k).select(*RECENT_COLUMNS))


STATUS_COLUMNS = (
    "run_id",
    "status",
    "started_at",
    "ended_at",
    "published_at",
    "source_mode",
    "replay_of_run_id",
    "data_interval_start",
    "data_interval_end",
    "raw_trips",
    "silver_trips",
    "rejected_trips",
    "quality_passed",
    "quality_failed",
    "contract_version",
)


def latest_status(runs: DataFrame) -> DataFrame:
    """One row on the newest run with shortened set hashes."""
    return latest_started(runs).select(
        *STATUS_COLUMNS,
        *[F.left(name, F.lit(16)).alias(name) for name in ("input_set_sha256", "output_set_sha256")],
    )


def evolve(legacy: DataFrame, current: DataFrame) -> DataFrame:
    """Run rows written before a column existed read as NULL in it."""
    return legacy.unionByName(current, allowMissingColumns=True)


def validation_rate(passed: Column, failed: Column) -> Column:
    return ratio(passed, passed + failed)
