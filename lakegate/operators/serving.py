"""Filtered analytics over the enriched fact, and shapes the console derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions import temporal
from lakegate.functions.numeric import exact_aggregate, exact_sum, ratio, scaled_round
from lakegate.operators import history, marts, ranges
from lakegate.operators.filters import FactFilter


def summary(
    enriched: DataFrame,
    trip_rejections: DataFrame,
    payment_rejections: DataFrame,
    runs: DataFrame,
    where: FactFilter,
) -> DataFrame:
    """Headline numbers of the filtered fact with unfiltered rejections and the latest run."""
    figures = marts.headline(where.apply(enriched))
    return with_context(figures, trip_rejections, payment_rejections, runs)


def with_context(
    figures: DataFrame,
    trip_rejections: DataFrame,
    payment_rejections: DataFrame,
    runs: DataFrame,
) -> DataFrame:
    """Headline figures, from the fact or its roll-up, with rejections and the latest run."""
    figures = figures.withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0.0)))
    latest = history.latest_published(runs).select(
        ratio(
            F.col("quality_passed"), F.col("quality_passed") + F.col("quality_failed")
        ).alias("validation_rate"),
        F.col("run_id").alias("snapshot_run_id"),
        F.col("published_at").alias("snapshot_published_at"),
    )
    timed = history.latest_published(runs.where(F.col("ended_at").isNotNull())).select(
        scaled_round(temporal.runtime_seconds(F.col("started_at"), F.col("ended_at")), 3)
    )
    counted = marts.with_rejections(figures, trip_rejections, payment_rejections)
    return counted.select("*", timed.scalar().alias("latest_runtime_seconds")).join(
        F.broadcast(latest), F.lit(True), "left"  # at most one row
    )


def timeseries(enriched: DataFrame, where: FactFilter) -> DataFrame:
    measures = [marts.rows("trips"), marts.revenue()]
    return exact_aggregate(where.apply(enriched), {"trip_hour": "trip_hour"}, measures).orderBy(
        "trip_hour"
    )


def zones(enriched: DataFrame, where: FactFilter) -> DataFrame:
    return marts.in_revenue_order(marts.revenue_by_zone(where.apply(enriched)))


def stations(
    enriched: DataFrame, where: FactFilter, limit: int = m.STATION_LIMIT_DEFAULT
) -> DataFrame:
    """Busiest start stations; ties are broken by station id."""
    if not 1 <= limit <= m.STATION_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {m.STATION_LIMIT_MAX}")
    ranked = exact_aggregate(
        where.apply(enriched),
        {
            "station_id": "start_station_id",
            "station_name": "start_station_name",
            "zone_name": "start_zone_name",
        },
        [
            marts.rows("departures"),
            marts.revenue(),
            marts.rounded_share(F.col("rider_type") == "member", "member_trip_share"),
        ],
    )
    return ranked.orderBy(F.desc("departures"), "station_id").limit(limit)


def filter_window(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.min("trip_date").alias("start_date"), F.max("trip_date").alias("end_date")
    )


def filter_zones(enriched: DataFrame) -> DataFrame:
    zones = enriched.select(*[F.col(c).alias(name) for name, c in marts.ZONE_KEYS.items()])
    return zones.distinct().orderBy(F.asc_nulls_last("zone_name"), F.asc_nulls_last("zone_id"))


def revenue_share(zone_rows: DataFrame) -> DataFrame:
    """Each listed zone's part of the listed revenue; 0 when there is none."""
    total = exact_sum(zone_rows, "revenue")
    with_total = zone_rows.withColumn("__total", F.coalesce(total, F.lit(0.0)))
    part = F.coalesce(F.col("revenue"), F.lit(0.0)) / F.nullif(F.col("__total"), F.lit(0.0))
    return with_total.withColumn(
        "revenue_share", F.when(F.col("__total") > 0, part).otherwise(F.lit(0.0))
    ).drop("__total")


def sample_points(points: DataFrame, max_points: int, time: str = "trip_hour") -> DataFrame:
    """Every ``ceil(n / max_points)``-th point in time order; all points when they fit."""
    total = points.agg(F.count(F.lit(1))).scalar()
    stride = F.greatest(F.ceil(total / F.lit(float(max_points))).cast("bigint"), F.lit(1))
    indexed = ranges.positions(points, time, "__index").withColumn("__stride", stride)
    return indexed.where(F.pmod(F.col("__index"), F.col("__stride")) == 0).drop(
        "__index", "__stride"
    )
