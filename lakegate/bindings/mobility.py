"""The mobility schema as specs: feeds, contracts, marts' relations, rules and checks.

Everything in this module is a FIXED VALUE: names, codes, thresholds and texts have to be
exactly these for results to agree with existing snapshots.
"""

from __future__ import annotations

from dataclasses import dataclass

from lakegate.operators import contracts as c
from lakegate.operators.contracts import Contract, Field, Rule

CONTRACT_VERSION = "snapshot-v1"
DATASETS = ("payments", "stations", "trips", "weather")

RIDER_TYPES = ("member", "casual", "corporate")
VEHICLE_TYPES = ("e-bike", "classic-bike", "scooter")
PAYMENT_METHODS = ("card", "wallet", "invoice")
RAIN = "rain"
RECONCILIATION_TOLERANCE = 0.02
ZONE_PATTERN = r"^Z\d{2}$"
RUN_ID_PATTERN = r"^\d{14}-[0-9a-f]{8}$"
STATION_LIMIT_DEFAULT = 12
STATION_LIMIT_MAX = 50
RECENT_RUNS = 8

FEED_COLUMNS = {
    "trips": (
        "trip_id",
        "started_at",
        "ended_at",
        "start_station_id",
        "end_station_id",
        "rider_type",
        "vehicle_type",
        "distance_km",
        "duration_min",
    ),
    "payments": (
        "payment_id",
        "trip_id",
        "fare_amount",
        "discount_amount",
        "tax_amount",
        "total_amount",
        "payment_method",
        "paid_at",
    ),
    "stations": (
        "station_id",
        "station_name",
        "zone_id",
        "zone_name",
        "zone_type",
        "latitude",
        "longitude",
        "capacity",
        "opened_at",
    ),
    "weather": ("observed_at", "temp_c", "rain_mm", "wind_kph", "condition"),
}
PROVENANCE = ("loaded_at", "source_file", "source_run_id")

TRIP_CONTRACT = Contract(
    name="trips",
    fields=(
        Field("trip_id", "key"),
        Field("started_at", "timestamp"),
        Field("ended_at", "timestamp"),
        Field("start_station_id", "key"),
        Field("end_station_id", "key"),
        Field("rider_type", "enum"),
        Field("vehicle_type", "enum"),
        Field("distance_km", "number"),
        Field("duration_min", "number"),
    ),
    rules=(
        Rule("missing_trip_id", c.any_null("trip_id")),
        Rule("invalid_timestamp", c.any_null("started_at", "ended_at")),
        Rule("non_positive_trip_window", c.not_after("ended_at", "started_at")),
        Rule("missing_station_id", c.any_null("start_station_id", "end_station_id")),
        Rule("invalid_rider_type", c.outside("rider_type", RIDER_TYPES)),
        Rule("invalid_vehicle_type", c.outside("vehicle_type", VEHICLE_TYPES)),
        Rule("invalid_distance", c.not_positive_number("distance_km")),
        Rule("invalid_duration", c.not_positive_number("duration_min")),
    ),
)

AMOUNTS = ("fare_amount", "discount_amount", "tax_amount", "total_amount")

PAYMENT_CONTRACT = Contract(
    name="payments",
    fields=(
        Field("payment_id", "key"),
        Field("trip_id", "key"),
        *(Field(name, "number") for name in AMOUNTS),
        Field("payment_method", "enum"),
        Field("paid_at", "timestamp"),
    ),
    rules=(
        Rule("missing_payment_id", c.any_null("payment_id")),
        Rule("missing_trip_id", c.any_null("trip_id")),
        Rule("duplicate_payment_id", c.repeated("payment_id")),
        Rule("duplicate_trip_payment", c.repeated("trip_id")),
        Rule("invalid_amount", c.not_number(*AMOUNTS)),
        Rule("negative_amount", c.negative(*AMOUNTS)),
        Rule(
            "amount_reconciliation_failed",
            c.unreconciled(
                "total_amount",
                "fare_amount",
                "discount_amount",
                "tax_amount",
                RECONCILIATION_TOLERANCE,
            ),
        ),
        Rule("invalid_payment_method", c.outside("payment_method", PAYMENT_METHODS)),
        Rule("invalid_paid_at", c.any_null("paid_at")),
    ),
    unique_keys=("payment_id", "trip_id"),
)

STATION_FIELDS = (
    Field("station_id", "string"),
    Field("station_name", "string"),
    Field("zone_id", "string"),
    Field("zone_name", "string"),
    Field("zone_type", "string"),
    Field("latitude", "double"),
    Field("longitude", "double"),
    Field("capacity", "int"),
    Field("opened_at", "date"),
)

WEATHER_FIELDS = (
    Field("observed_at", "timestamp_ntz"),
    Field("temp_c", "double"),
    Field("rain_mm", "double"),
    Field("wind_kph", "double"),
    Field("condition", "string"),
)

ENRICHED_COLUMNS = (
    "trip_id",
    "started_at",
    "ended_at",
    "trip_hour",
    "trip_date",
    "start_station_id",
    "start_station_name",
    "start_zone_id",
    "start_zone_name",
    "start_zone_type",
    "end_station_id",
    "end_station_name",
    "end_zone_id",
    "end_zone_name",
    "rider_type",
    "vehicle_type",
    "distance_km",
    "duration_min",
    "fare_amount",
    "discount_amount",
    "tax_amount",
    "total_amount",
    "payment_method",
    "temp_c",
    "rain_mm",
    "wind_kph",
    "condition",
    "has_payment",
)

HOURLY_COLUMNS = (
    "trip_hour",
    "zone_id",
    "zone_name",
    "rider_type",
    "trips",
    "revenue",
    "avg_duration_min",
    "avg_distance_km",
    "avg_temp_c",
    "rainy_trip_share",
)
DAILY_COLUMNS = (
    "trip_date",
    "station_id",
    "station_name",
    "zone_name",
    "departures",
    "revenue",
    "avg_duration_min",
    "avg_distance_km",
    "member_trip_share",
)
ZONE_COLUMNS = (
    "zone_id",
    "zone_name",
    "trips",
    "revenue",
    "revenue_per_trip",
    "avg_duration_min",
)

# Relation name -> business columns covered by its fingerprint (no provenance).
FINGERPRINTS = {
    "silver.trips": FEED_COLUMNS["trips"],
    "silver.payments": FEED_COLUMNS["payments"],
    "silver.trip_enriched": ENRICHED_COLUMNS,
    "gold.hourly_mobility": HOURLY_COLUMNS,
    "gold.daily_station_performance": DAILY_COLUMNS,
    "gold.revenue_by_zone": ZONE_COLUMNS,
}

# The column that gives a row's day, for fingerprints kept per day.
FINGERPRINT_DAYS = {
    "silver.trips": "started_at",
    "silver.payments": "paid_at",
    "silver.trip_enriched": "trip_date",
    "gold.hourly_mobility": "trip_hour",
    "gold.daily_station_performance": "trip_date",
    "gold.revenue_by_zone": None,
}

# Metric -> unit, in reporting order.
PROFILE_UNITS = {
    "total_trips": "trips",
    "daily_trip_rate": "trips_per_day",
    "total_revenue": "currency",
    "revenue_per_trip": "currency_per_trip",
    "avg_duration_min": "minutes",
    "avg_distance_km": "km",
    "payment_match_rate": "ratio",
    "member_share": "ratio",
    "casual_share": "ratio",
    "corporate_share": "ratio",
    "active_stations": "stations",
    "gold_hourly_rows": "rows",
}

# Metric, delta kind, largest accepted absolute delta.
DRIFT_RULES = (
    ("daily_trip_rate", "relative", 0.25),
    ("revenue_per_trip", "relative", 0.20),
    ("avg_duration_min", "relative", 0.20),
    ("avg_distance_km", "relative", 0.20),
    ("payment_match_rate", "absolute", 0.02),
    ("member_share", "absolute", 0.10),
    ("casual_share", "absolute", 0.10),
    ("corporate_share", "absolute", 0.05),
    ("active_stations", "relative", 0.10),
)


@dataclass(frozen=True)
class Check:
    """Gate on one observed number. ``gate`` is ``zero`` or ``at_least``."""

    name: str
    gate: str
    limit: float
    threshold: str
    details: str


CHECKS = (
    Check("raw_trips_loaded", "at_least", 1.0, ">= 1", "bronze.trips row count"),
    Check("silver_trips_loaded", "at_least", 1.0, ">= 1", "silver.trips row count"),
    Check("trip_contract_rejections", "zero", 0.0, "= 0", "Data defect count"),
    Check("payment_contract_rejections", "zero", 0.0, "= 0", "Data defect count"),
    Check("duplicate_trip_ids", "zero", 0.0, "= 0", "Data defect count"),
    Check("invalid_trip_timestamps", "zero", 0.0, "= 0", "Data defect count"),
    Check("enriched_trip_cardinality", "zero", 0.0, "= 0", "Data defect count"),
    Check("payment_match_rate", "at_least", 0.995, ">= 0.995", "Minimum acceptable value"),
    Check("missing_station_references", "zero", 0.0, "= 0", "Data defect count"),
    Check("payment_amount_reconciliation", "zero", 0.0, "= 0", "Data defect count"),
    Check("dashboard_summary_ready", "at_least", 1.0, ">= 1", "Minimum acceptable value"),
    Check(
        "data_interval_end_gap_days",
        "zero",
        0.0,
        "= 0",
        "Latest accepted trip date must equal the declared interval end {interval_end}",
    ),
    Check("cross_snapshot_drift", "zero", 0.0, "= 0 breached metrics", "{drift_details}"),
)
NO_BASELINE_DETAILS = "No compatible published baseline exists yet"
BASELINE_DETAILS = "Compared {compared} profiled metrics with the compatible baseline"

LINEAGE_EDGES = (
    ("raw.trips.csv", "bronze.trips", "ingest_csv"),
    ("raw.payments.csv", "bronze.payments", "ingest_csv"),
    ("raw.stations.csv", "bronze.stations", "ingest_csv"),
    ("raw.weather.csv", "bronze.weather", "ingest_csv"),
    ("bronze.*", "silver.trip_enriched", "clean_join_cast"),
    ("silver.trip_enriched", "gold.hourly_mobility", "aggregate"),
    ("silver.trip_enriched", "gold.daily_station_performance", "aggregate"),
    ("silver.trip_enriched", "gold.revenue_by_zone", "aggregate"),
    ("gold.*", "FastAPI + dashboard", "serve"),
)

REQUIRED_RELATIONS = (
    "gold.dashboard_summary",
    "gold.hourly_mobility",
    "gold.lineage_edges",
    "ops.dataset_profiles",
    "ops.drift_results",
    "ops.ingest_files",
    "ops.pipeline_runs",
    "ops.quality_results",
    "ops.relation_fingerprints",
    "silver.trip_enriched",
)

# Public failure texts; raw error messages never leave the store.
FAILED_GATE = "Quality gate failure"
FAILED_REPLAY_OUTPUT = "Replay output equivalence failure"
FAILED_REPLAY_INPUT = "Replay source or input integrity failure"
FAILED_OTHER = "Run failed; review operator logs"
# Lower-case markers looked up in the recorded error message.
GATE_MESSAGE = "quality checks failed:"
REPLAY_MARKER = "replay"
REPLAY_OUTPUT_MARKER = "replay output fingerprint mismatch"
NOT_EQUIVALENT_MARKER = "not equivalent"
MANIFEST_MARKER = "recorded input manifest fingerprint"
CONFIG_MARKER = "recorded configuration hash"
