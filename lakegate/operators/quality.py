"""Publication checks: observe, compare, tally, decide."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions.numeric import ratio, share
from lakegate.operators import contracts

OBSERVED = "observed_value"


def observe(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """All checks on one relation in one aggregate pass: (check_name, observed_value)."""
    return df.agg(*[value.cast("double").alias(name) for name, value in measures.items()]).unpivot(
        [], list(measures), "check_name", OBSERVED
    )


def trip_observations(judged_trips: DataFrame) -> DataFrame:
    ok = F.col(contracts.REASON).isNull()
    return observe(
        judged_trips,
        {
            "raw_trips_loaded": F.count(F.lit(1)),
            "silver_trips_loaded": F.count_if(ok),
            "trip_contract_rejections": F.count_if(~ok),
            "invalid_trip_timestamps": F.count_if(
                ok & (F.col("ended_at") <= F.col("started_at"))
            ),
        },
    )


def payment_observations(judged_payments: DataFrame) -> DataFrame:
    ok = F.col(contracts.REASON).isNull()
    gap = contracts.reconciliation_gap(
        "total_amount", "fare_amount", "discount_amount", "tax_amount"
    )
    return observe(
        judged_payments,
        {
            "payment_contract_rejections": F.count_if(~ok),
            "payment_amount_reconciliation": F.count_if(
                ok & (gap > F.lit(m.RECONCILIATION_TOLERANCE))
            ),
        },
    )


def fact_observations(enriched: DataFrame, trips: DataFrame, interval_end: date) -> DataFrame:
    """Cardinality is compared with the accepted trips; the gap is NULL for an empty fact."""
    accepted = trips.agg(F.count(F.lit(1))).scalar()
    counted = enriched.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(share(F.col("has_payment")), F.lit(0.0)).alias("matched"),
        F.count_if(
            F.col("start_station_name").isNull() | F.col("end_station_name").isNull()
        ).alias("unplaced"),
        F.max("trip_date").alias("last_day"),
    )
    return observe(
        counted.withColumn("accepted", accepted),
        {
            "enriched_trip_cardinality": F.max(F.abs(F.col("accepted") - F.col("rows"))),
            "payment_match_rate": F.max("matched"),
            "missing_station_references": F.max("unplaced"),
            "dashboard_summary_ready": F.max("rows"),
            "data_interval_end_gap_days": F.max(
                F.date_diff(F.lit(interval_end), F.col("last_day"))
            ),
        },
    )


def duplicate_observation(trips: DataFrame) -> DataFrame:
    return contracts.duplicate_keys(trips, "trip_id").select(
        F.lit("duplicate_trip_ids").alias("check_name"),
        F.col("duplicate_keys").cast("double").alias(OBSERVED),
    )


def judge(observed: DataFrame, interval_end: date, drift_details: Column) -> DataFrame:
    """Compare observations with their gates; a missing observation fails.

    Every check is listed even if nothing was observed for it.
    """
    specs = F.array(
        *[
            F.struct(
                F.lit(position).alias("check_order"),
                F.lit(check.name).alias("check_name"),
                F.lit(check.gate).alias("gate"),
                F.lit(check.limit).alias("limit"),
                F.lit(check.threshold).alias("threshold"),
                F.lit(check.details).alias("details"),
            )
            for position, check in enumerate(m.CHECKS)
        ]
    )
    by_name = observed.groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("check_name", OBSERVED))).alias("observed")
    )
    rows = by_name.select("observed", F.explode(specs).alias("spec")).select("observed", "spec.*")
    value = F.element_at("observed", F.col("check_name"))
    holds = F.when(F.col("gate") == "zero", F.col(OBSERVED) == 0).otherwise(
        F.col(OBSERVED) >= F.col("limit")
    )
    details = F.replace(
        F.replace("details", F.lit("{interval_end}"), F.lit(interval_end.isoformat())),
        F.lit("{drift_details}"),
        drift_details,
    )
    return (
        rows.withColumn(OBSERVED, value)
        .withColumn("status", F.when(holds, "pass").otherwise("fail"))
        .select("check_order", "check_name", "status", OBSERVED, "threshold", details.alias("details"))
    )


def quality_checks(
    judged_trips: DataFrame,
    judged_payments: DataFrame,
    enriched: DataFrame,
    interval_end: date,
    drift: DataFrame | None = None,
    compared_metrics: int = len(m.DRIFT_RULES),
) -> DataFrame:
    """The thirteen gates. One aggregate pass per relation, thirteen short rows at the end."""
    trips = contracts.accepted(judged_trips)
    trip_part = trip_observations(judged_trips)
    parts = [
        trip_part,
        payment_observations(judged_payments),
        duplicate_observation(trips),
        fact_observations(enriched, trips, interval_end),
    ]
    if drift is None:
        text = F.lit(m.NO_BASELINE_DETAILS)
        none_breached = trip_part.where(F.col("check_name") == "raw_trips_loaded").select(
            F.lit("cross_snapshot_drift").alias("check_name"), F.lit(0.0).alias(OBSERVED)
        )
        parts.append(none_breached)
    else:
        text = F.lit(m.BASELINE_DETAILS.format(compared=compared_metrics))
        parts.append(
            observe(drift, {"cross_snapshot_drift": F.count_if(F.col("status") != "pass")})
        )
    return judge(reduce(DataFrame.unionAll, parts), interval_end, text)


def tally(checks: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    passed = F.count_if(F.col("status") == "pass")
    total = F.count(F.lit(1))
    return checks.groupBy(*by).agg(
        passed.alias("quality_passed"),
        (total - passed).alias("quality_failed"),
        total.alias("quality_total"),
        ratio(passed, total).alias("validation_rate"),
    )


def failed_check_messages(checks: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Names of the failing checks in check order; at most one entry per check."""
    entry = F.struct("check_order", "check_name")
    names = F.transform(
        F.array_sort(F.collect_set(F.when(F.col("status") != "pass", entry))),
        lambda item: item["check_name"],
    )
    listed = checks.groupBy(*by).agg(names.alias("__names"))
    return listed.where(F.size("__names") > 0).select(
        *by,
        F.concat(F.lit("Quality checks failed: "), F.array_join("__names", ", ")).alias(
            "error_message"
        ),
    )


def publish_decision(
    tallies: DataFrame, *, fail_on_quality: bool = True
) -> DataFrame:
    """Status and publication of each candidate from its tally."""
    failed = F.col("quality_failed") > 0
    return tallies.withColumn(
        "status", F.when(failed, "failed_quality").otherwise("success")
    ).withColumn("published", ~failed | F.lit(not fail_on_quality))
