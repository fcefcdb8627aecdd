"""Gold marts. Every aggregate is partial first, so a hot group costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions.numeric import Measure, exact_aggregate, scaled_round

ZONE_KEYS = {"zone_id": "start_zone_id", "zone_name": "start_zone_name"}


def row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def rows(name: str) -> Measure:
    return Measure(name, "rows")


def revenue(name: str = "revenue") -> Measure:
    """NULL when no row of the group is paid."""
    return Measure(name, "sum", F.col("total_amount"), lambda x: scaled_round(x, 2))


def mean(column: str, name: str) -> Measure:
    return Measure(name, "mean", F.col(column), lambda x: scaled_round(x, 2))


def rounded_share(condition: Column, name: str) -> Measure:
    return Measure(name, "share", condition, lambda x: scaled_round(x, 4))


def hourly_mobility(enriched: DataFrame) -> DataFrame:
    return exact_aggregate(
        enriched,
        {"trip_hour": "trip_hour", **ZONE_KEYS, "rider_type": "rider_type"},
        [
            rows("trips"),
            revenue(),
            mean("duration_min", "avg_duration_min"),
            mean("distance_km", "avg_distance_km"),
            mean("temp_c", "avg_temp_c"),
            rounded_share(F.col("condition") == m.RAIN, "rainy_trip_share"),
        ],
    )


def daily_station_performance(enriched: DataFrame) -> DataFrame:
    return exact_aggregate(
        enriched,
        {
            "trip_date": "trip_date",
            "station_id": "start_station_id",
            "station_name": "start_station_name",
            "zone_name": "start_zone_name",
        },
        [
            rows("departures"),
            revenue(),
            mean("duration_min", "avg_duration_min"),
            mean("distance_km", "avg_distance_km"),
            rounded_share(F.col("rider_type") == "member", "member_trip_share"),
        ],
    )


def revenue_by_zone(enriched: DataFrame) -> DataFrame:
    """``revenue_per_trip`` averages over paid trips only."""
    return exact_aggregate(
        enriched,
        ZONE_KEYS,
        [
            rows("trips"),
            revenue(),
            mean("total_amount", "revenue_per_trip"),
            mean("duration_min", "avg_duration_min"),
        ],
    )


def headline(enriched: DataFrame) -> DataFrame:
    """One row of key figures."""
    found = exact_aggregate(
        enriched,
        {},
        [
            rows("total_trips"),
            revenue("total_revenue"),
            Measure("first_trip_date", "min", F.col("trip_date")),
            Measure("last_trip_date", "max", F.col("trip_date")),
            mean("duration_min", "avg_duration_min"),
            rounded_share(F.col("has_payment"), "payment_match_rate"),
        ],
    )
    stations = enriched.agg(F.count_distinct("start_station_id").alias("n"))
    return found.select(
        "total_trips",
        "total_revenue",
        stations.scalar().alias("active_stations"),
        "first_trip_date",
        "last_trip_date",
        "avg_duration_min",
        "payment_match_rate",
    )


def with_rejections(
    summary: DataFrame, trip_rejections: DataFrame, payment_rejections: DataFrame
) -> DataFrame:
    """Add the two rejection counts as scalar subqueries."""
    return summary.select(
        "*",
        trip_rejections.agg(row_count("n")).scalar().alias("rejected_trips"),
        payment_rejections.agg(row_count("n")).scalar().alias("rejected_payments"),
    )


def dashboard_summary(
    enriched: DataFrame, trip_rejections: DataFrame, payment_rejections: DataFrame
) -> DataFrame:
    return with_rejections(headline(enriched), trip_rejections, payment_rejections)


# Reading order of the marts; stored files carry no order.
def in_hour_order(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy(
        F.asc_nulls_last("trip_hour"), F.asc_nulls_last("zone_id"), F.asc_nulls_last("rider_type")
    )


def in_day_order(daily: DataFrame) -> DataFrame:
    return daily.orderBy(
        F.desc_nulls_last("trip_date"), F.desc_nulls_last("departures"), "station_id"
    )


def in_revenue_order(zones: DataFrame) -> DataFrame:
    return zones.orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("zone_id"))
