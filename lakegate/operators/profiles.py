"""Snapshot profiles and drift against a compatible earlier snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions import casting
from lakegate.functions.numeric import Measure, exact_aggregate, ratio
from lakegate.operators import joins
from lakegate.sources.staging import stage, stage_measured


def fact_metrics(enriched: DataFrame, days: Column, keys: Sequence[str]) -> DataFrame:
    """Metrics of one pass over the enriched fact. Revenue per trip counts unpaid trips."""
    figures = exact_aggregate(
        enriched,
        {key: key for key in keys},
        [
            Measure("trips", "rows"),
            Measure("revenue", "sum", F.col("total_amount")),
            Measure("avg_duration_min", "mean", F.col("duration_min")),
            Measure("avg_distance_km", "mean", F.col("distance_km")),
            Measure("payment_match_rate", "share", F.col("has_payment")),
            *[Measure(f"{r}_share", "share", F.col("rider_type") == r) for r in m.RIDER_TYPES],
        ],
    )
    revenue = F.coalesce("revenue", F.lit(0.0))
    return figures.select(
        *keys,
        F.col("trips").cast("double").alias("total_trips"),
        (F.col("trips").cast("double") / days).alias("daily_trip_rate"),
        revenue.alias("total_revenue"),
        ratio(revenue, F.col("trips")).alias("revenue_per_trip"),
        "avg_duration_min",
        "avg_distance_km",
        "payment_match_rate",
        *[f"{r}_share" for r in m.RIDER_TYPES],
    )


def dataset_profiles(
    trips: DataFrame,
    enriched: DataFrame,
    hourly: DataFrame,
    days: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """Twelve (metric_name, metric_value, unit) rows, per ``by`` group if one is given.

    ``by`` profiles many snapshots in the same three partially aggregated passes.
    """
    if days <= 0:
        raise ValueError("days must be greater than zero")
    keys = list(by)
    stations = F.count_distinct("start_station_id").cast("double").alias("active_stations")
    hours = F.count(F.lit(1)).cast("double").alias("gold_hourly_rows")
    parts = [
        fact_metrics(enriched, F.lit(float(days)), keys),
        trips.groupBy(*keys).agg(stations),
        hourly.groupBy(*keys).agg(hours),
    ]
    tall = [
        part.unpivot(keys, [c for c in part.columns if c not in keys], "metric_name", "metric_value")
        for part in parts
    ]
    units = F.create_map(*[F.lit(text) for pair in m.PROFILE_UNITS.items() for text in pair])
    return reduce(DataFrame.unionAll, tall).withColumn(
        "unit", F.element_at(units, F.col("metric_name"))
    )


def metric_order(metric: Column) -> Column:
    """Position of a profile metric in reports."""
    names = F.array(*[F.lit(name) for name in m.PROFILE_UNITS])
    return F.array_position(names, metric)


def delta(current: Column, baseline: Column, kind: Column) -> Column:
    """Change against the baseline; NULL when undefined (missing, non-finite, from zero)."""
    usable = casting.is_finite(current) & casting.is_finite(baseline)
    from_zero = F.when(current == 0, F.lit(0.0))
    relative = F.when(baseline == 0, from_zero).otherwise(
        (current - baseline) / F.nullif(F.abs(baseline), F.lit(0.0))
    )
    return F.when(
        usable, F.when(kind == "absolute", current - baseline).otherwise(relative)
    )


def with_drift(compared: DataFrame) -> DataFrame:
    """Add delta and status to rows holding current_value, baseline_value and their rule.

    An undefined delta fails.
    """
    change = delta(F.col("current_value"), F.col("baseline_value"), F.col("delta_kind"))
    within = F.abs(F.col("delta")) <= F.col("threshold")
    return compared.withColumn("delta", change).withColumn(
        "status", F.when(within, "pass").otherwise("fail")
    )


def drift_rules() -> Column:
    """The rule set as an array of structs, for ``explode``."""
    return F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric_name"),
                F.lit(kind).alias("delta_kind"),
                F.lit(threshold).alias("threshold"),
            )
            for metric, kind, threshold in m.DRIFT_RULES
        ]
    )


DRIFT_COLUMNS = (
    "run_id",
    "baseline_run_id",
    "metric_name",
    "current_value",
    "baseline_value",
    "delta",
    "delta_kind",
    "threshold",
    "status",
)


def compare_profiles(
    pairs: DataFrame, profiles: DataFrame, *, limit: int = joins.BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Nine drift rows for every (run_id, baseline_run_id) pair.

    ``profiles`` holds (run_id, metric_name, metric_value). A metric missing on either side
    still yields its row, with an undefined delta. Runs are unique, but very many of them may
    share one baseline: the baselines' profiles are picked out first, and attached by a
    size-checked lookup.
    """
    wanted = pairs.select(F.col("baseline_run_id").alias("run_id")).distinct()
    metric_key = F.concat("run_id", F.lit("/"), "metric_name")
    baseline, size = stage_measured(
        profiles.join(wanted, "run_id", "left_semi").select(
            metric_key.alias("__baseline_key"), F.col("metric_value").alias("baseline_value")
        ),
        "baseline-profiles",
    )
    splits = None
    if size > limit:
        pairs = stage(pairs, "drift-pairs")  # a scan numbers rows alike on every attempt
        shared = joins.key_splits(pairs, "baseline_run_id")
        metrics = F.explode(F.array(*[F.lit(metric) for metric, _, _ in m.DRIFT_RULES]))
        splits = shared.withColumn("metric", metrics).select(
            F.concat("__split_key", F.lit("/"), "metric").alias("__split_key"), "__parts"
        )
    ruled = (
        joins.with_row_id(pairs)
        .withColumn("rule", F.explode(drift_rules()))
        .select("run_id", "baseline_run_id", "rule.*", joins.ROW_ID)
        .withColumn("__key", F.concat("baseline_run_id", F.lit("/"), "metric_name"))
    )
    current = profiles.select(
        F.col("run_id").alias("__run"),
        F.col("metric_name").alias("__metric"),
        F.col("metric_value").alias("current_value"),
    )
    with_baseline = joins.lookup_join(
        ruled, baseline, "__key", "__baseline_key", right_bytes=size, splits=splits, limit=limit
    )
    joined = with_baseline.join(
        current,
        (F.col("run_id") == F.col("__run")) & (F.col("metric_name") == F.col("__metric")),
        "left",
    )
    return with_drift(joined).select(*DRIFT_COLUMNS)


def drift_rollup(drift: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Overall drift state: no_baseline, breached or stable."""
    checked = F.count(F.lit(1))
    failed = F.count_if(F.col("status") != "pass")
    state = (
        F.when(checked == 0, "no_baseline").when(failed > 0, "breached").otherwise("stable")
    )
    return drift.groupBy(*by).agg(
        F.max("baseline_run_id").alias("baseline_run_id"),
        state.alias("status"),
        checked.alias("checked_metrics"),
        failed.alias("failed_metrics"),
    )


def drift_rollup_of_runs(runs: DataFrame, drift: DataFrame) -> DataFrame:
    """The overall drift state of every run; a run without drift rows has ``no_baseline``."""
    return (
        runs.select("run_id")
        .join(drift_rollup(drift, ["run_id"]), "run_id", "left")
        .select(
            "run_id",
            "baseline_run_id",
            F.coalesce("status", F.lit("no_baseline")).alias("status"),
            F.coalesce("checked_metrics", F.lit(0)).alias("checked_metrics"),
            F.coalesce("failed_metrics", F.lit(0)).alias("failed_metrics"),
        )
    )


def in_priority_order(drift: DataFrame, *within: str) -> DataFrame:
    """Failing metrics first, then by name; for many runs, inside each group ``within``."""
    first = F.when(F.col("status") != "pass", 0).otherwise(1)
    return drift.orderBy(*within, first, "metric_name")
