"""Stored roll-up of the fact that answers filtered questions without reading the fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions.numeric import ExactMeasures, Measure, scaled_round
from lakegate.operators import marts
from lakegate.operators.filters import FactFilter

RELATION = "gold.trip_rollup"
#: What a question may filter and group by.
KEYS = (
    "trip_date",
    "trip_hour",
    "start_zone_id",
    "start_zone_name",
    "start_station_id",
    "start_station_name",
    "rider_type",
)


def _exact() -> ExactMeasures:
    """What a question may ask for."""
    return ExactMeasures(
        [
            Measure("trips", "rows"),
            Measure("amount", "sum", F.col("total_amount")),
            Measure("amount_mean", "mean", F.col("total_amount")),
            Measure("duration_mean", "mean", F.col("duration_min")),
            Measure("member_share", "share", F.col("rider_type") == "member"),
            Measure("paid_share", "share", F.col("has_payment")),
            Measure("first_date", "min", F.col("trip_date")),
            Measure("last_date", "max", F.col("trip_date")),
        ]
    )


def trip_rollup(enriched: DataFrame) -> DataFrame:
    """Counts and exact sums per :data:`KEYS`, which can be added further without rounding.

    At most one row per hour, station and rider type (a second one only where values of other
    magnitudes occur), so its size follows the stations and hours, not the trips.
    """
    return _exact().partial(enriched, {key: key for key in KEYS})


def covers(rollup: DataFrame, keys: Mapping[str, str]) -> bool:
    """Can this frame answer a question grouped by ``{output: input}`` keys, under any filter?"""
    exact = _exact()
    needed = {*KEYS, *exact.classes, "rows__n"}
    return needed <= set(rollup.columns) and set(keys.values()) <= set(KEYS)


def answer(rollup: DataFrame, where: FactFilter, keys: Mapping[str, str]) -> DataFrame:
    """The figures of a filtered question; ``ValueError`` if the roll-up does not hold its keys."""
    if not covers(rollup, keys):
        raise ValueError(f"the roll-up does not answer questions by {', '.join(keys.values())}")
    exact = _exact()
    return exact.final(exact.regrouped(where.apply(rollup), keys), list(keys))


def timeseries(rollup: DataFrame, where: FactFilter) -> DataFrame:
    found = answer(rollup, where, {"trip_hour": "trip_hour"})
    revenue = scaled_round(F.col("amount"), 2).alias("revenue")
    return found.select("trip_hour", "trips", revenue).orderBy("trip_hour")


def zones(rollup: DataFrame, where: FactFilter) -> DataFrame:
    found = answer(rollup, where, marts.ZONE_KEYS)
    return marts.in_revenue_order(
        found.select(
            *marts.ZONE_KEYS,
            "trips",
            scaled_round(F.col("amount"), 2).alias("revenue"),
            scaled_round(F.col("amount_mean"), 2).alias("revenue_per_trip"),
            scaled_round(F.col("duration_mean"), 2).alias("avg_duration_min"),
        )
    )


def stations(
    rollup: DataFrame, where: FactFilter, limit: int = m.STATION_LIMIT_DEFAULT
) -> DataFrame:
    """Busiest start stations; ties are broken by station id."""
    if not 1 <= limit <= m.STATION_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {m.STATION_LIMIT_MAX}")
    keys = {
        "station_id": "start_station_id",
        "station_name": "start_station_name",
        "zone_name": "start_zone_name",
    }
    ranked = answer(rollup, where, keys).select(
        *keys,
        F.col("trips").alias("departures"),
        scaled_round(F.col("amount"), 2).alias("revenue"),
        scaled_round(F.col("member_share"), 4).alias("member_trip_share"),
    )
    return ranked.orderBy(F.desc("departures"), "station_id").limit(limit)


def headline(rollup: DataFrame, where: FactFilter) -> DataFrame:
    """The same columns as :func:`marts.headline` of the filtered fact."""
    active = where.apply(rollup).agg(F.count_distinct("start_station_id").alias("n"))
    return answer(rollup, where, {}).select(
        F.col("trips").alias("total_trips"),
        scaled_round(F.col("amount"), 2).alias("total_revenue"),
        active.scalar().alias("active_stations"),
        F.col("first_date").alias("first_trip_date"),
        F.col("last_date").alias("last_trip_date"),
        scaled_round(F.col("duration_mean"), 2).alias("avg_duration_min"),
        scaled_round(F.col("paid_share"), 4).alias("payment_match_rate"),
    )
