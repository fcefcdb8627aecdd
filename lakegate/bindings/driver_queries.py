"""Registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.bindings import driver as d
from lakegate.bindings import mobility as m
from lakegate.functions import casting, hashing, temporal
from lakegate.functions.numeric import ratio, scaled_round
from lakegate.operators import (
    contracts,
    enrich,
    evidence,
    fingerprints,
    history,
    joins,
    lineage,
    manifests,
    marts,
    profiles,
    quality,
    rollups,
    serving,
)
from lakegate.operators.contracts import Contract, Field, Rule
from lakegate.operators.filters import FactFilter
from lakegate.sources import feeds, files
from lakegate.sources.staging import literal_rows, stage

Query = Callable[[SparkSession, str], DataFrame]

WHERE = FactFilter(date(2024, 1, 5), date(2024, 1, 20), "Z03", "member")
WHERE_DAYS = FactFilter(date(2024, 1, 5), date(2024, 1, 20))
MAX_POINTS = 240

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- sources ---------------------------------------------------------------------------


@query
def bronze_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Provenance columns on every bronze trip (load time is left out of the comparison)."""
    loaded = feeds.with_provenance(
        d.bronze_trips(spark, folder), d.RUN_ID, F.lit("runs/trips.csv")
    )
    return loaded.select("trip_id", "rider_type", "source_file", "source_run_id")


@query
def ingest_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of the files of all tables that the feeds are made from."""
    names = ("customer", "events", "lineitem", "nation", "orders", "region")
    feeds = {name: d.table(spark, folder, name) for name in names}
    paths = {name: [f"{folder}/{name}.parquet"] for name in names}
    return files.file_manifest(spark, feeds, paths, folder)


@query
def source_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return d.relation_counts({name: feed(spark, folder) for name, feed in d.BRONZE.items()})


@query
def evidence_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of open orders are checked again; half of them now have no findings at all."""
    existing = d.quality_results(spark, folder).drop("check_order")
    again = d.runs(spark, folder).where(F.col("status") == "running").select("run_id", "seed")
    fresh = again.where(F.col("seed") > 500).select(
        "run_id",
        F.lit("raw_trips_loaded").alias("check_name"),
        F.lit("pass").alias("status"),
        F.col("seed").cast("double").alias("observed_value"),
    )
    return evidence.upsert(existing, again, fresh)


@query
def run_history_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """Runs before 1998 were written without the later columns."""
    runs = d.runs(spark, folder)
    columns = ["run_id", "started_at", "status", "rejected_trips", "published_at", "contract_version"]
    added = F.lit(date(1998, 1, 1))
    old = runs.where(F.col("data_interval_end") < added).select("run_id", "started_at", "status")
    new = runs.where(F.col("data_interval_end") >= added).select(*columns)
    return history.evolve(old, new).select(*columns)


@query
def lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges with the row counts of the relations they connect."""
    relations = {f"bronze.{name}": feed(spark, folder) for name, feed in d.BRONZE.items()}
    enriched = stage(d.trip_enriched(spark, folder), "enriched")
    relations |= {
        "silver.trip_enriched": enriched,
        "gold.hourly_mobility": marts.hourly_mobility(enriched),
        "gold.daily_station_performance": marts.daily_station_performance(enriched),
        "gold.revenue_by_zone": marts.revenue_by_zone(enriched),
    }
    return lineage.with_row_counts(lineage.lineage_edges(spark), d.relation_counts(relations))


@query
def published_snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the snapshot the pointer names (an order's lines are its snapshot)."""
    lines = d.table(spark, folder, "lineitem").withColumn("run_id", d.run_id_of("l_orderkey"))
    pointer = history.latest_published(d.runs(spark, folder))
    return evidence.of_run(lines, pointer).select(
        "run_id", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )


@query
def readiness(spark: SparkSession, folder: str) -> DataFrame:
    """Required tables against the files present, and whether a run is published."""
    listed = files.file_listing(spark, [f"{folder}/*.parquet"])
    name = F.regexp_extract("path", r"([^/]+)\.parquet$", 1)
    present = listed.select(name.alias("relation_name"))
    required = literal_rows(
        spark, pa.schema([("relation_name", pa.string())]), [(table,) for table in d.TABLES]
    )
    missing = manifests.missing_members(required, present, "relation_name")
    return feeds.readiness(missing, d.runs(spark, folder))


@query
def input_set_hash(spark: SparkSession, folder: str) -> DataFrame:
    return manifests.input_set_hash(d.ingest_files(spark, folder), ["run_id"])


@query
def manifest_verify(spark: SparkSession, folder: str) -> DataFrame:
    recorded = d.recorded_files(spark, folder)
    return manifests.verify_manifest(recorded, d.observed_files(recorded)).select(
        "run_id", "dataset_name", "verdict"
    )


@query
def manifest_replayable(spark: SparkSession, folder: str) -> DataFrame:
    recorded = d.recorded_files(spark, folder)
    verdicts = manifests.verify_manifest(recorded, d.observed_files(recorded))
    return manifests.replayable_runs(d.runs(spark, folder), verdicts)


# --- typing and contracts --------------------------------------------------------------


@query
def silver_stations(spark: SparkSession, folder: str) -> DataFrame:
    return d.silver_stations(spark, folder)


@query
def silver_weather_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return d.silver_weather(spark, folder)


@query
def trips_typed(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.conform(d.bronze_trips(spark, folder), m.TRIP_CONTRACT.fields)


@query
def payments_typed(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.conform(d.bronze_payments(spark, folder), m.PAYMENT_CONTRACT.fields)


@query
def trip_contract(spark: SparkSession, folder: str) -> DataFrame:
    return d.judged_trips(spark, folder)


@query
def trip_contract_null_enum(spark: SparkSession, folder: str) -> DataFrame:
    judged = contracts.apply_contract(
        d.bronze_trips(spark, folder), m.TRIP_CONTRACT, reject_null_enum=True
    )
    return judged.groupBy(contracts.REASON).agg(F.count(F.lit(1)).alias("rows"))


@query
def payment_contract(spark: SparkSession, folder: str) -> DataFrame:
    return d.judged_payments(spark, folder)


@query
def payment_dup_counts(spark: SparkSession, folder: str) -> DataFrame:
    typed = contracts.conform(d.bronze_payments(spark, folder), m.PAYMENT_CONTRACT.fields)
    counted = contracts.attach_key_counts(
        typed, {"payment_id": "payment_id_count", "trip_id": "trip_id_count"}
    )
    return counted.select("payment_id", "trip_id", "payment_id_count", "trip_id_count")


@query
def trips_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.accepted(d.judged_trips(spark, folder))


@query
def trip_rejections(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.rejected(d.judged_trips(spark, folder))


@query
def payments_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.accepted(d.judged_payments(spark, folder))


@query
def payment_rejections(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.rejected(d.judged_payments(spark, folder))


@query
def rejection_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return (
        contracts.rejection_reasons(d.judged_trips(spark, folder))
        .withColumn("feed", F.lit("trips"))
        .unionByName(
            contracts.rejection_reasons(d.judged_payments(spark, folder)).withColumn(
                "feed", F.lit("payments")
            )
        )
    )


_LINE_CONTRACT = Contract(
    name="lines",
    fields=(
        Field("line_key", "key"),
        Field("ordered_at", "timestamp"),
        Field("shipped_at", "timestamp"),
        Field("return_flag", "enum"),
        Field("quantity", "number"),
        Field("price", "number"),
    ),
    rules=(
        Rule("missing_line_key", contracts.any_null("line_key")),
        Rule("missing_order", contracts.any_null("ordered_at")),
        Rule("duplicate_line", contracts.repeated("line_key")),
        Rule("shipped_before_order", contracts.not_after("shipped_at", "ordered_at")),
        Rule("invalid_return_flag", contracts.outside("return_flag", ("a", "n"))),
        Rule("invalid_quantity", contracts.not_positive_number("quantity")),
        Rule("invalid_price", contracts.not_number("price")),
    ),
    unique_keys=("line_key",),
)


@query
def lineitem_contract(spark: SparkSession, folder: str) -> DataFrame:
    """A second feed under its own contract: order lines with their order's date."""
    lines = joins.with_row_id(d.table(spark, folder, "lineitem"))
    orders = d.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    line_key = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key")
    splits = joins.key_splits(lines, "l_orderkey")
    raw = joins.salted_left_join(lines, orders, "l_orderkey", "o_orderkey", splits).select(
        line_key,
        F.col("o_orderdate").alias("ordered_at"),
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        joins.ROW_ID,
    )
    judged = contracts.apply_contract(raw, _LINE_CONTRACT, keys_from=lines.select(line_key))
    return judged.groupBy(contracts.REASON).agg(F.count(F.lit(1)).alias("rows"))


@query
def finite_filter(spark: SparkSession, folder: str) -> DataFrame:
    typed = contracts.conform(d.bronze_trips(spark, folder), m.TRIP_CONTRACT.fields)
    return typed.where(casting.is_finite(F.col("distance_km"))).select("trip_id", "distance_km")


@query
def amount_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    typed = contracts.conform(d.bronze_payments(spark, folder), m.PAYMENT_CONTRACT.fields)
    gap = contracts.reconciliation_gap(
        "total_amount", "fare_amount", "discount_amount", "tax_amount"
    )
    return typed.where(gap > F.lit(m.RECONCILIATION_TOLERANCE)).select("payment_id", "trip_id")


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = d.table(spark, folder, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber").alias("line_key")
    )
    trips = contracts.accepted(d.judged_trips(spark, folder))
    return (
        contracts.duplicate_keys(lines, "line_key")
        .withColumn("relation_name", F.lit("lineitem"))
        .unionByName(
            contracts.duplicate_keys(trips, "trip_id").withColumn(
                "relation_name", F.lit("silver.trips")
            )
        )
    )


@query
def iso_projection(spark: SparkSession, folder: str) -> DataFrame:
    return d.table(spark, folder, "events").select(
        "event_id",
        temporal.iso_text(F.col("ts")).alias("ts_iso"),
        temporal.iso_text(F.col("ts").cast("date")).alias("date_iso"),
    )


@query
def guarded_ratio(spark: SparkSession, folder: str) -> DataFrame:
    runs = d.runs(spark, folder)
    return runs.select(
        "run_id",
        ratio(F.col("raw_trips"), F.col("silver_trips")).alias("raw_per_silver"),
        history.validation_rate(F.col("quality_passed"), F.col("quality_failed")).alias(
            "validation_rate"
        ),
    )


@query
def run_duration(spark: SparkSession, folder: str) -> DataFrame:
    runs = d.runs(spark, folder)
    start, end = F.col("started_at"), F.col("ended_at")
    return runs.select(
        "run_id",
        scaled_round(temporal.runtime_seconds(start, end), 3).alias("runtime_seconds"),
        history.display_seconds(end, start).alias("reversed_display_seconds"),
        history.display_seconds(start, end).alias("display_seconds"),
    )


# --- joins -----------------------------------------------------------------------------


def _accepted_trips(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.with_trip_time(contracts.accepted(d.judged_trips(spark, folder)))


@query
def enrich_stations(spark: SparkSession, folder: str) -> DataFrame:
    trips = _accepted_trips(spark, folder)
    stations = d.silver_stations(spark, folder)
    size = joins.content_bytes({"stations": stations})["stations"]
    joined = enrich.join_stations(
        joins.with_row_id(trips), stations, stations_bytes=size, splits={}
    )
    return joined.select(
        "trip_id", "start_station_name", "start_zone_id", "start_zone_type", "end_station_name",
        "end_zone_id",
    )


@query
def enrich_stations_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The same join by its other route: station tables too large to broadcast."""
    trips = _accepted_trips(spark, folder)
    splits = {key: joins.key_splits(trips, key) for key in ("start_station_id", "end_station_id")}
    joined = enrich.join_stations(
        joins.with_row_id(trips),
        d.silver_stations(spark, folder),
        stations_bytes=joins.BROADCAST_LIMIT_BYTES + 1,
        splits=splits,
    )
    return joined.select(
        "trip_id", "start_station_name", "start_zone_id", "start_zone_type", "end_station_name",
        "end_zone_id",
    )


@query
def enrich_payments(spark: SparkSession, folder: str) -> DataFrame:
    trips = _accepted_trips(spark, folder)
    payments = contracts.accepted(d.judged_payments(spark, folder))
    splits = {"trip_id": joins.key_splits(trips, "trip_id")}
    return enrich.join_payments(joins.with_row_id(trips), payments, splits=splits).select(
        "trip_id", "fare_amount", "total_amount", "payment_method", "has_payment"
    )


@query
def enrich_weather(spark: SparkSession, folder: str) -> DataFrame:
    trips = _accepted_trips(spark, folder)
    weather = d.silver_weather(spark, folder)
    size = joins.content_bytes({"weather": weather})["weather"]
    return enrich.join_weather(
        joins.with_row_id(trips), weather, weather_bytes=size, splits={}
    ).select("trip_id", "trip_hour", "temp_c", "rain_mm", "wind_kph", "condition")


@query
def trip_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return d.trip_enriched(spark, folder)


@query
def previous_published_run(spark: SparkSession, folder: str) -> DataFrame:
    linked = history.previous_published(d.runs(spark, folder))
    return linked.select("run_id", F.col("previous.run_id").alias("previous_published_run_id"))


@query
def missing_members(spark: SparkSession, folder: str) -> DataFrame:
    """Stations that trips end at but no station row describes."""
    wanted = contracts.accepted(d.judged_trips(spark, folder)).select(
        F.col("end_station_id").alias("station_id")
    )
    return manifests.missing_members(wanted, d.silver_stations(spark, folder), "station_id")


# --- marts and serving -----------------------------------------------------------------


@query
def hourly_mobility(spark: SparkSession, folder: str) -> DataFrame:
    return marts.in_hour_order(marts.hourly_mobility(d.trip_enriched(spark, folder)))


@query
def daily_station_performance(spark: SparkSession, folder: str) -> DataFrame:
    return marts.in_day_order(marts.daily_station_performance(d.trip_enriched(spark, folder)))


@query
def revenue_by_zone(spark: SparkSession, folder: str) -> DataFrame:
    return marts.in_revenue_order(marts.revenue_by_zone(d.trip_enriched(spark, folder)))


@query
def dashboard_summary(spark: SparkSession, folder: str) -> DataFrame:
    built = d.snapshot(spark, folder, stage_fact=False)
    return marts.dashboard_summary(built.enriched, *built.rejections)


@query
def filtered_facts(spark: SparkSession, folder: str) -> DataFrame:
    return WHERE.apply(d.trip_enriched(spark, folder)).select(
        "trip_id", "trip_date", "start_zone_id", "rider_type", "total_amount"
    )


@query
def summary_filtered(spark: SparkSession, folder: str) -> DataFrame:
    built = d.snapshot(spark, folder, stage_fact=False)
    return serving.summary(
        built.enriched, *built.rejections, d.runs(spark, folder), WHERE_DAYS
    )


@query
def timeseries_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return serving.timeseries(d.trip_enriched(spark, folder), WHERE_DAYS)


@query
def zones_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return serving.zones(d.trip_enriched(spark, folder), WHERE_DAYS)


@query
def stations_topk(spark: SparkSession, folder: str) -> DataFrame:
    return serving.stations(d.trip_enriched(spark, folder), WHERE_DAYS)


def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The roll-up as a snapshot stores it."""
    return stage(rollups.trip_rollup(d.trip_enriched(spark, folder)), "trip-rollup")


@query
def summary_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The filtered summary again, from the stored roll-up alone; so are the next three."""
    built = d.snapshot(spark, folder, stage_fact=False)
    figures = rollups.headline(_rollup(spark, folder), WHERE_DAYS)
    return serving.with_context(figures, *built.rejections, d.runs(spark, folder))


@query
def timeseries_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.timeseries(_rollup(spark, folder), WHERE_DAYS)


@query
def zones_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.zones(_rollup(spark, folder), WHERE_DAYS)


@query
def stations_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.stations(_rollup(spark, folder), WHERE_DAYS)


@query
def filter_window(spark: SparkSession, folder: str) -> DataFrame:
    return serving.filter_window(d.trip_enriched(spark, folder))


@query
def filter_zones(spark: SparkSession, folder: str) -> DataFrame:
    return serving.filter_zones(d.trip_enriched(spark, folder))


@query
def active_stations(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.accepted(d.judged_trips(spark, folder)).agg(
        F.count_distinct("start_station_id").alias("active_stations")
    )


@query
def zone_revenue_share(spark: SparkSession, folder: str) -> DataFrame:
    zones = stage(serving.zones(d.trip_enriched(spark, folder), WHERE_DAYS), "zones")
    return serving.revenue_share(zones).select("zone_id", "revenue", "revenue_share")


@query
def timeseries_sample(spark: SparkSession, folder: str) -> DataFrame:
    points = stage(serving.timeseries(d.trip_enriched(spark, folder), FactFilter()), "points")
    return serving.sample_points(points, MAX_POINTS)


@query
def total_rejects(spark: SparkSession, folder: str) -> DataFrame:
    trips = contracts.rejected(d.judged_trips(spark, folder))
    payments = contracts.rejected(d.judged_payments(spark, folder))
    counts = trips.agg(marts.row_count("n")).unionAll(payments.agg(marts.row_count("n")))
    return counts.agg(F.sum("n").alias("total_rejects"))


# --- profiles, fingerprints, drift -----------------------------------------------------


@query
def dataset_profiles(spark: SparkSession, folder: str) -> DataFrame:
    built = d.snapshot(spark, folder, stage_feeds=False)
    return profiles.dataset_profiles(
        contracts.accepted(built.trips),
        built.enriched,
        marts.hourly_mobility(built.enriched),
        d.DAYS,
    )


def _weekly_profiles(built: d.Snapshot) -> DataFrame:
    """Profiles of all weekly snapshots together; the snapshot number is the run id."""
    trips = enrich.with_trip_time(contracts.accepted(built.trips))
    hourly = marts.hourly_mobility(built.enriched)
    return profiles.dataset_profiles(
        trips.withColumn("snapshot", d.snapshot_of(F.col("trip_date"))),
        built.enriched.withColumn("snapshot", d.snapshot_of(F.col("trip_date"))),
        hourly.withColumn("snapshot", d.snapshot_of(F.col("trip_hour").cast("date"))),
        d.SNAPSHOT_DAYS,
        by=["snapshot"],
    )


@query
def snapshot_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return _weekly_profiles(d.snapshot(spark, folder, stage_feeds=False))


def _weekly_drift(built: d.Snapshot) -> DataFrame:
    run_id = F.col("snapshot").cast("string")
    weekly = stage(_weekly_profiles(built).withColumn("run_id", run_id), "weekly-profiles")
    later = (F.col("metric_name") == "total_trips") & (F.col("snapshot") > 0)
    pairs = weekly.where(later).select(
        "run_id", (F.col("snapshot") - 1).cast("string").alias("baseline_run_id")
    )
    return profiles.compare_profiles(pairs, weekly)


@query
def drift_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Each weekly snapshot against the one before it."""
    return _weekly_drift(d.snapshot(spark, folder, stage_feeds=False))


@query
def drift_compare_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every run against its compatible baseline, with metrics missing on either side."""
    pairs = history.baselines(d.runs(spark, folder)).where(F.col("baseline_run_id").isNotNull())
    return profiles.compare_profiles(pairs, stage(d.run_profiles(spark, folder), "profiles"))


@query
def drift_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.drift_rollup_of_runs(d.runs(spark, folder), d.drift_results(spark, folder))


@query
def drift_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.in_priority_order(d.drift_results(spark, folder), "run_id").select(
        "run_id", "metric_name", "delta", "delta_kind", "threshold", "status"
    )


@query
def relation_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    relations = d.snapshot(spark, folder).relations()
    return fingerprints.relation_fingerprints(relations, m.FINGERPRINTS)


def _day_sums(relations: dict[str, DataFrame]) -> DataFrame:
    return fingerprints.relation_day_sums(relations, m.FINGERPRINTS, m.FINGERPRINT_DAYS)


@query
def day_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every day of every relation."""
    sums = _day_sums(d.snapshot(spark, folder).relations())
    return sums.select(
        "relation_name",
        "partition_key",
        "row_count",
        hashing.sums_digest().alias("fingerprint_sha256"),
    )


@query
def fingerprints_from_days(spark: SparkSession, folder: str) -> DataFrame:
    """The relations' fingerprints put together from their days."""
    sums = _day_sums(d.snapshot(spark, folder).relations())
    return fingerprints.from_day_sums(sums, list(m.FINGERPRINTS))


@query
def changed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which the fact differs from a build with dearer trips on the first of each month.

    The stored sums of the changed days alone are taken anew.
    """
    name, fact = "silver.trip_enriched", d.snapshot(spark, folder).enriched
    columns, day = m.FINGERPRINTS[name], m.FINGERPRINT_DAYS[name]
    stored = stage(fingerprints.day_sums(fact, name, columns, day), "day-sums")
    first = F.dayofmonth(day) == 1
    dearer = F.when(first, F.col("total_amount") + F.lit(1.0)).otherwise(F.col("total_amount"))
    rebuilt = fact.withColumn("total_amount", dearer)
    days = [r[0] for r in stored.where(F.substring("partition_key", 9, 2) == "01").select("partition_key").collect()]
    again = fingerprints.refreshed(stored, rebuilt, name, columns, day, days)
    return fingerprints.compare_days(stored, again).where(~F.col("equivalent")).drop("equivalent")


@query
def output_set_hash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.output_set_hash(relation_fingerprints(spark, folder))


@query
def replay_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """Two builds of the same input, the second from differently partitioned feeds."""
    rebuilt = d.snapshot(
        spark,
        folder,
        raw_trips=d.bronze_trips(spark, folder).repartition(13),
        raw_payments=d.bronze_payments(spark, folder).repartition(7),
    )
    compared = fingerprints.compare_fingerprints(
        relation_fingerprints(spark, folder),
        fingerprints.relation_fingerprints(rebuilt.relations(), m.FINGERPRINTS),
    )
    return compared.select("relation_name", "row_count", "source_sha256", "equivalent")


# --- checks ----------------------------------------------------------------------------


@query
def quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    """All thirteen gates on the whole snapshot, drift taken from the weekly comparison."""
    built = d.snapshot(spark, folder)
    return quality.quality_checks(
        built.trips,
        built.payments,
        built.enriched,
        d.INTERVAL_END,
        drift=_weekly_drift(built),
    ).drop("details")


@query
def quality_checks_no_baseline(spark: SparkSession, folder: str) -> DataFrame:
    built = d.snapshot(spark, folder, stage_fact=False)
    return quality.quality_checks(built.trips, built.payments, built.enriched, d.INTERVAL_END)


def _single_check(name: str) -> Query:
    """One gate on its own: only the relation it looks at is computed."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        if name in ("payment_contract_rejections", "payment_amount_reconciliation"):
            observed = quality.payment_observations(d.judged_payments(spark, folder))
        elif name == "duplicate_trip_ids":
            observed = quality.duplicate_observation(
                contracts.accepted(d.judged_trips(spark, folder))
            )
        elif name == "cross_snapshot_drift":
            failed = F.count_if(F.col("status") != "pass")
            observed = quality.observe(drift_compare(spark, folder), {name: failed})
        elif name in (
            "raw_trips_loaded",
            "silver_trips_loaded",
            "trip_contract_rejections",
            "invalid_trip_timestamps",
        ):
            observed = quality.trip_observations(d.judged_trips(spark, folder))
        else:
            built = d.snapshot(spark, folder, stage_fact=False)
            observed = quality.fact_observations(
                built.enriched, contracts.accepted(built.trips), d.INTERVAL_END
            )
        wanted = observed.where(F.col("check_name") == name)
        judged = quality.judge(wanted, d.INTERVAL_END, F.lit(""))
        return judged.where(F.col("check_name") == name).select(
            "check_name", "status", "observed_value", "threshold"
        )

    return run


for _check in m.CHECKS:
    _REGISTRY[f"qc_{_check.name}"] = _single_check(_check.name)


@query
def quality_tally(spark: SparkSession, folder: str) -> DataFrame:
    return quality.tally(d.quality_results(spark, folder))


@query
def failed_check_message(spark: SparkSession, folder: str) -> DataFrame:
    return quality.failed_check_messages(d.quality_results(spark, folder))


@query
def publish_decision(spark: SparkSession, folder: str) -> DataFrame:
    tallies = quality.tally(d.quality_results(spark, folder))
    strict = quality.publish_decision(tallies).withColumnRenamed("published", "strictly")
    return quality.publish_decision(strict, fail_on_quality=False).select(
        "run_id",
        "status",
        F.col("strictly").alias("published"),
        F.col("published").alias("published_by_override"),
    )


# --- run evidence ----------------------------------------------------------------------


@query
def latest_published_run(spark: SparkSession, folder: str) -> DataFrame:
    return history.latest_published(d.runs(spark, folder)).select(
        "run_id", "published_at", "status"
    )


@query
def compatible_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return history.baselines(d.runs(spark, folder))


@query
def run_deltas(spark: SparkSession, folder: str) -> DataFrame:
    return history.run_deltas(d.runs(spark, folder))


@query
def recent_runs(spark: SparkSession, folder: str) -> DataFrame:
    return history.recent_runs(d.runs(spark, folder))


@query
def run_failure_summary(spark: SparkSession, folder: str) -> DataFrame:
    return d.runs(spark, folder).select(
        "run_id",
        history.failure_summary(F.col("status"), F.col("error_message")).alias("failure_summary"),
    )


@query
def run_status_label(spark: SparkSession, folder: str) -> DataFrame:
    return d.runs(spark, folder).select(
        "run_id", history.status_label(F.col("status"), F.col("published_at")).alias("label")
    )


@query
def latest_run_status(spark: SparkSession, folder: str) -> DataFrame:
    return history.latest_status(d.runs(spark, folder))


@query
def quality_by_run(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.quality_by_run(
        d.quality_results(spark, folder), d.runs(spark, folder)
    ).select("run_id", "check_name", "status", "observed_value")


@query
def files_by_run(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.files_by_run(d.ingest_files(spark, folder), d.runs(spark, folder))


@query
def drift_by_run(spark: SparkSession, folder: str) -> DataFrame:
    rows = evidence.drift_by_run(d.drift_results(spark, folder), d.runs(spark, folder))
    return profiles.in_priority_order(rows)


@query
def run_finish(spark: SparkSession, folder: str) -> DataFrame:
    """Every running run ends with the outcome its recorded checks and files give."""
    runs = d.runs(spark, folder)
    decided = quality.publish_decision(quality.tally(d.quality_results(spark, folder)))
    running = runs.where(F.col("status") == "running").select("run_id", "started_at")
    finished = running.join(decided, "run_id").select(
        "run_id",
        "published",
        temporal.plus_seconds(F.col("started_at"), F.lit(90)).alias("ended_at"),
        "status",
        F.col("quality_passed").cast("int").alias("quality_passed"),
        F.col("quality_failed").cast("int").alias("quality_failed"),
    )
    columns = ("run_id", "status", "ended_at", "quality_passed", "quality_failed", "published_at")
    return evidence.finish_runs(runs, finished).select(*columns)


@query
def run_detail(spark: SparkSession, folder: str) -> DataFrame:
    detail = evidence.run_details(d.runs(spark, folder), d.ingest_files(spark, folder))
    return detail.select(
        "run_id",
        "failure_summary",
        "runtime_seconds",
        "is_current_snapshot",
        "previous_published_run_id",
        "source_rows",
        "source_bytes",
        "source_rows_delta",
        "source_bytes_delta",
        "silver_trips_delta",
        "rejected_trips_delta",
        "gold_hourly_rows_delta",
        "silver_trips_delta_percent",
    )
