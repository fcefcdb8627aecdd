"""The wide fact: accepted trips with payment, both stations and the weather of the hour."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.functions import temporal
from lakegate.operators import joins


def renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Pick and rename, so that one dimension can play several roles."""
    return df.select(*[F.col(source).alias(target) for source, target in columns.items()])


def station_role(stations: DataFrame, role: str, extra: tuple[str, ...] = ()) -> DataFrame:
    picked = ("station_id", "station_name", "zone_id", "zone_name", *extra)
    targets = {name: f"{role}_{name}" for name in picked}
    return renamed(stations, {**targets, "station_id": f"__{role}_key"})


def payment_role(payments: DataFrame) -> DataFrame:
    return payments.select(
        F.col("trip_id").alias("__paid_trip"),
        F.col("payment_id").alias("__payment_id"),
        "fare_amount",
        "discount_amount",
        "tax_amount",
        "total_amount",
        "payment_method",
    )


def weather_role(weather: DataFrame) -> DataFrame:
    """Observation time is not truncated: an off-hour observation matches no trip."""
    return weather.select(
        F.col("observed_at").alias("__observed_at"), "temp_c", "rain_mm", "wind_kph", "condition"
    )


def with_trip_time(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_hour", temporal.hour_start(F.col("started_at"))).withColumn(
        "trip_date", F.col("started_at").cast("date")
    )


def join_stations(
    trips: DataFrame, stations: DataFrame, *, stations_bytes: int, splits: Mapping[str, DataFrame]
) -> DataFrame:
    result = trips
    for role, extra in (("start", ("zone_type",)), ("end", ())):
        key = f"{role}_station_id"
        result = joins.lookup_join(
            result,
            station_role(stations, role, extra),
            key,
            f"__{role}_key",
            right_bytes=stations_bytes,
            splits=splits.get(key),
        ).drop(f"__{role}_key")
    return result


def join_payments(trips: DataFrame, payments: DataFrame, *, splits: Mapping[str, DataFrame]) -> DataFrame:
    joined = joins.salted_left_join(
        trips, payment_role(payments), "trip_id", "__paid_trip", splits.get("trip_id")
    )
    return joined.withColumn("has_payment", F.col("__payment_id").isNotNull()).drop(
        "__paid_trip", "__payment_id"
    )


def join_weather(
    trips: DataFrame, weather: DataFrame, *, weather_bytes: int, splits: Mapping[str, DataFrame]
) -> DataFrame:
    return joins.lookup_join(
        trips,
        weather_role(weather),
        "trip_hour",
        "__observed_at",
        right_bytes=weather_bytes,
        splits=splits.get("trip_hour"),
    ).drop("__observed_at")


def enrich_trips(
    trips: DataFrame,
    payments: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    columns: tuple[str, ...],
    *,
    keys: DataFrame | None = None,
    limit: int = joins.BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """All four left joins.

    The payments join shuffles, so it runs first on the narrow trip rows; the dimensions are
    attached afterwards, broadcast when their measured size allows it. Heavy keys are weighed
    only for joins that shuffle; ``keys`` may hold the trips' key columns by a cheaper route.
    """
    sizes = joins.content_bytes(
        {
            "stations": station_role(stations, "start", ("zone_type",)),
            "weather": weather_role(weather),
        }
    )
    shuffled = ["trip_id"]
    shuffled += ["start_station_id", "end_station_id"] if sizes["stations"] > limit else []
    shuffled += ["trip_hour"] if sizes["weather"] > limit else []
    timed = with_trip_time(trips)
    keyed = timed if keys is None else with_trip_time(keys)
    splits = {name: joins.key_splits(keyed, name) for name in shuffled}

    paid = join_payments(joins.with_row_id(timed), payments, splits=splits)
    placed = join_stations(paid, stations, stations_bytes=sizes["stations"], splits=splits)
    full = join_weather(placed, weather, weather_bytes=sizes["weather"], splits=splits)
    return full.select(*columns)
