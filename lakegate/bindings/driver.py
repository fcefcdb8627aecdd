"""The driver's tables seen as mobility feeds and as run evidence.

Every relation is derived from whole tables. Defects are injected by the row's key, so that
each contract rule meets rows; the same derivation is written in SQL in ``oracle_sql``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.functions import temporal
from lakegate.functions.numeric import scaled_round
from lakegate.operators import contracts, enrich, marts, profiles
from lakegate.sources.staging import stage, together

INTERVAL_END = date(2024, 1, 30)
FIRST_DAY = date(2024, 1, 1)
DAYS = 30
SNAPSHOT_DAYS = 7
RUN_ID = "20240131000000-0badcafe"


# FIXED VALUES: columns and types of the tables that are read. Giving the schema saves the
# inference job of every read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def choose(selector: Column, cases: dict, otherwise: Column) -> Column:
    """Value by selector; anything not listed takes ``otherwise``."""
    branches = None
    for key, value in cases.items():
        literal = F.lit(value) if not isinstance(value, Column) else value
        branch = F.when if branches is None else branches.when
        branches = branch(selector == key, literal)
    return branches.otherwise(otherwise)


def _padded(text: Column, width: int) -> Column:
    """Zero-padded on the left; longer text is kept whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _numbered(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), _padded(column.cast("string"), 8))


# --- feeds -----------------------------------------------------------------------------


def bronze_trips(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    number, value, user = F.col("event_id"), F.col("value"), F.col("user_id")
    defect = number % 101
    started = F.col("ts").cast("string")
    ended = temporal.plus_seconds(F.col("ts"), value * 60).cast("string")
    rider = choose(
        F.col("event_type"),
        {"click": "member", "view": "casual", "purchase": "corporate", "signup": " Member "},
        F.lit("guest"),
    )
    vehicle = choose(number % 3, {0: "e-bike", 1: " Classic-Bike"}, F.lit("scooter"))
    return events.select(
        choose(defect, {1: "  "}, _numbered("T", number)).alias("trip_id"),
        choose(defect, {2: "not-a-time"}, started).alias("started_at"),
        choose(defect, {3: started}, ended).alias("ended_at"),
        choose(defect, {4: "   "}, user.cast("string")).alias("start_station_id"),
        (user * 11 + number % 13).cast("string").alias("end_station_id"),
        choose(defect, {5: F.lit(None).cast("string")}, rider).alias("rider_type"),
        choose(defect, {6: "boat"}, vehicle).alias("vehicle_type"),
        choose(defect, {7: "inf", 8: "0"}, (value / F.lit(10.0)).cast("string")).alias(
            "distance_km"
        ),
        choose(defect, {9: "nan", 10: "x", 11: "5d"}, value.cast("string")).alias("duration_min"),
    )


def bronze_payments(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    number, price = F.col("o_orderkey"), F.col("o_totalprice")
    defect = number % 103
    paid_trip = number - F.when(number % 7 == 3, 1).otherwise(0)
    method = choose(
        F.substring("o_orderpriority", 1, 1),
        {"1": "card", "2": "wallet", "3": "invoice", "4": " Card"},
        F.lit("WALLET"),
    )
    copies = F.when(number % 211 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return orders.select(
        choose(defect, {1: " "}, _numbered("P", number)).alias("payment_id"),
        choose(defect, {2: ""}, _numbered("T", paid_trip)).alias("trip_id"),
        choose(defect, {3: "abc", 4: "inf", 5: "-1"}, price.cast("string")).alias("fare_amount"),
        F.lit("0.0").alias("discount_amount"),
        F.lit("0.0").alias("tax_amount"),
        choose(
            defect, {5: "0", 6: (price + F.lit(0.05)).cast("string")}, price.cast("string")
        ).alias("total_amount"),
        choose(defect, {7: "cash"}, method).alias("payment_method"),
        choose(defect, {8: "never"}, F.col("o_orderdate").cast("string")).alias("paid_at"),
        F.explode(copies).alias("__copy"),
    ).drop("__copy")


def bronze_stations(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    number = F.col("c_custkey")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            number.cast("string").alias("station_id"),
            F.col("c_name").alias("station_name"),
            F.format_string("Z%02d", F.col("n_nationkey")).alias("zone_id"),
            F.col("n_name").alias("zone_name"),
            F.col("r_name").alias("zone_type"),
            (F.lit(59.3) + (number % 120) / F.lit(1000.0)).cast("string").alias("latitude"),
            (F.lit(18.0) + (number % 160) / F.lit(1000.0)).cast("string").alias("longitude"),
            (number % 31 + 14).cast("string").alias("capacity"),
            F.date_add(F.lit(date(1995, 1, 1)), (number % 365).cast("int"))
            .cast("string")
            .alias("opened_at"),
        )
    )


def bronze_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly readings from the events of the hour; some are taken at half past."""
    hourly = (
        table(spark, folder, "events")
        .groupBy(temporal.hour_start(F.col("ts")).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    late = F.when(F.col("n") % 5 == 0, 1800).otherwise(0)
    return hourly.select(
        temporal.plus_seconds(F.col("hour"), late).cast("string").alias("observed_at"),
        scaled_round(F.col("high") / F.lit(20.0), 1).cast("string").alias("temp_c"),
        scaled_round(F.col("n").cast("double") / F.lit(5.0), 2).cast("string").alias("rain_mm"),
        scaled_round(F.col("low") / F.lit(10.0), 1).cast("string").alias("wind_kph"),
        choose(F.col("n") % 3, {0: "rain", 1: "cloudy"}, F.lit("clear")).alias("condition"),
    )


BRONZE = {
    "trips": bronze_trips,
    "payments": bronze_payments,
    "stations": bronze_stations,
    "weather": bronze_weather,
}


# --- silver ----------------------------------------------------------------------------


def judged_trips(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.apply_contract(bronze_trips(spark, folder), m.TRIP_CONTRACT)


def judged_payments(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.apply_contract(bronze_payments(spark, folder), m.PAYMENT_CONTRACT)


def silver_stations(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.conform(bronze_stations(spark, folder), m.STATION_FIELDS)


def silver_weather(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.conform(bronze_weather(spark, folder), m.WEATHER_FIELDS)


def enriched_from(
    spark: SparkSession,
    folder: str,
    trips: DataFrame,
    payments: DataFrame,
    keys: DataFrame | None = None,
) -> DataFrame:
    return enrich.enrich_trips(
        contracts.accepted(trips),
        contracts.accepted(payments),
        silver_stations(spark, folder),
        silver_weather(spark, folder),
        m.ENRICHED_COLUMNS,
        keys=keys,
    )


def trip_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as one plan from the raw feeds, for queries that read it once."""
    keys = contracts.conform(bronze_trips(spark, folder), m.TRIP_CONTRACT.fields, once=False)
    return enriched_from(
        spark, folder, judged_trips(spark, folder), judged_payments(spark, folder), keys
    )


@dataclass(frozen=True)
class Snapshot:
    """The silver layer as staged tables, for queries that read it several times.

    Like a published snapshot, each relation is computed once and read column by column.
    """

    trips: DataFrame
    payments: DataFrame
    enriched: DataFrame

    @property
    def rejections(self) -> tuple[DataFrame, DataFrame]:
        return contracts.rejected(self.trips), contracts.rejected(self.payments)

    def relations(self) -> dict[str, DataFrame]:
        """The fingerprinted relations."""
        return {
            "silver.trips": contracts.accepted(self.trips),
            "silver.payments": contracts.accepted(self.payments),
            "silver.trip_enriched": self.enriched,
            "gold.hourly_mobility": marts.hourly_mobility(self.enriched),
            "gold.daily_station_performance": marts.daily_station_performance(self.enriched),
            "gold.revenue_by_zone": marts.revenue_by_zone(self.enriched),
        }


def snapshot(
    spark: SparkSession,
    folder: str,
    *,
    raw_trips: DataFrame | None = None,
    raw_payments: DataFrame | None = None,
    stage_feeds: bool = True,
    stage_fact: bool = True,
) -> Snapshot:
    """Build the silver layer; parts with a single reader need not be staged."""
    raw_trips = bronze_trips(spark, folder) if raw_trips is None else raw_trips
    raw_payments = bronze_payments(spark, folder) if raw_payments is None else raw_payments
    if not stage_feeds:
        trips = contracts.apply_contract(raw_trips, m.TRIP_CONTRACT)
        payments = contracts.apply_contract(raw_payments, m.PAYMENT_CONTRACT)
        keys = contracts.conform(raw_trips, m.TRIP_CONTRACT.fields, once=False)
        fact = enriched_from(spark, folder, trips, payments, keys)
        return Snapshot(trips, payments, stage(fact, "enriched"))
    judged = together(
        {
            "trips": lambda: stage(contracts.apply_contract(raw_trips, m.TRIP_CONTRACT), "trips"),
            "payments": lambda: stage(
                contracts.apply_contract(raw_payments, m.PAYMENT_CONTRACT), "payments"
            ),
        }
    )
    fact = enriched_from(spark, folder, **judged)
    return Snapshot(**judged, enriched=stage(fact, "enriched") if stage_fact else fact)


def snapshot_of(day: Column) -> Column:
    """Weekly snapshot number of a trip date."""
    return F.floor(F.date_diff(day, F.lit(FIRST_DAY)) / F.lit(SNAPSHOT_DAYS)).cast("int")


# --- run history and evidence ----------------------------------------------------------


def run_id_of(number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    decimal, hexadecimal = number.cast("string"), F.lower(F.hex(number))
    return F.concat_ws("-", _padded(decimal, 14), _padded(hexadecimal, 8))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One run per order."""
    number, price = F.col("o_orderkey"), F.col("o_totalprice")
    started = temporal.plus_seconds(F.col("o_orderdate"), number % 86400)
    status = choose(
        F.col("o_orderstatus"),
        {
            "F": "success",
            "O": F.when(number % 3 == 0, "failed").otherwise("failed_quality"),
        },
        F.when(number % 2 == 0, "running").otherwise("success"),
    )
    days = F.when(number % 2 == 0, 7).otherwise(5)
    interval_end = F.col("o_orderdate").cast("date")
    base = table(spark, folder, "orders").select(
        "o_orderkey",
        run_id_of(number).alias("run_id"),
        started.alias("started_at"),
        F.when(status != "running", temporal.plus_seconds(started, price / F.lit(1000.0))).alias(
            "ended_at"
        ),
        status.alias("status"),
        days.cast("int").alias("days_requested"),
        F.col("o_custkey").cast("bigint").alias("seed"),
        F.floor(price).cast("int").alias("raw_trips"),
        (number % 50).cast("int").alias("rejected_trips"),
        (F.col("o_custkey") % 720).cast("int").alias("gold_hourly_rows"),
        F.date_sub(interval_end, days - 1).alias("data_interval_start"),
        interval_end.alias("data_interval_end"),
        F.when(number % 9 == 0, "replay").otherwise("generated").alias("source_mode"),
        F.when((number % 9 == 0) & (number > 0), run_id_of(number - 1)).alias("replay_of_run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.when(number % 5 == 0, "snapshot-v0").otherwise("snapshot-v1").alias("contract_version"),
        F.sha2(F.concat(F.lit("in"), number.cast("string")), 256).alias("input_set_sha256"),
        F.sha2(F.concat(F.lit("out"), number.cast("string")), 256).alias("output_set_sha256"),
    )
    broken = (number % 3 + 1).cast("int")
    state = F.col("status")
    failures = choose(
        number % 4,
        {
            0: "Replay source SHA-256 mismatch: trips",
            1: "Replay output fingerprint mismatch; not equivalent",
            2: "Recorded configuration hash is invalid",
        },
        F.lit("Permission denied: /secret/path"),
    )
    published = (state == "success") | ((state == "failed_quality") & (number % 4 == 0))
    judged = state.isin("success", "failed_quality")
    return base.withColumns(
        {
            "silver_trips": F.when(number % 97 == 0, F.lit(0)).otherwise(
                F.col("raw_trips") - F.col("rejected_trips")
            ),
            "quality_failed": F.when(
                judged, F.when(state == "failed_quality", broken).otherwise(F.lit(0))
            ),
            "published_at": F.when(published, F.col("ended_at")),
            "error_message": F.when(state == "failed", failures).when(
                state == "failed_quality", "Quality checks failed: cross_snapshot_drift"
            ),
        }
    ).withColumn("quality_passed", F.lit(13) - F.col("quality_failed")).drop("o_orderkey")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("run_id", run_id_of(F.col("l_orderkey")))


def ingest_files(spark: SparkSession, folder: str) -> DataFrame:
    """File manifest rows: the lines of an order, grouped into four datasets."""
    dataset = choose(
        F.col("l_linenumber") % 4,
        {0: "payments", 1: "stations", 2: "trips"},
        F.lit("weather"),
    )
    return (
        _lines(spark, folder)
        .groupBy("run_id", dataset.alias("dataset_name"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("row_count"),
            F.sum(F.floor("l_extendedprice").cast("bigint")).alias("file_bytes"),
        )
        .select(
            "run_id",
            "dataset_name",
            F.concat_ws("/", F.lit("runs"), "run_id", F.concat("dataset_name", F.lit(".csv")))
            .alias("source_file"),
            F.sha2(
                F.concat_ws(":", "run_id", "dataset_name", F.col("file_bytes").cast("string")), 256
            ).alias("file_sha256"),
            "file_bytes",
            "row_count",
        )
    )


def observed_files(recorded: DataFrame) -> DataFrame:
    """What a later look at the files finds: some are gone (NULL), resized or rewritten."""
    size = F.col("file_bytes")
    found = F.when(size % 13 == 0, size + 1).otherwise(size)
    return recorded.select(
        "run_id",
        "dataset_name",
        F.when(size % 17 != 0, found).alias("file_bytes"),
        F.when(size % 11 == 0, F.sha2("file_sha256", 256)).otherwise(F.col("file_sha256")).alias(
            "file_sha256"
        ),
    )


def recorded_files(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows of which some carry a path that leaves the root."""
    size, path = F.col("file_bytes"), F.col("source_file")
    return ingest_files(spark, folder).withColumn(
        "source_file",
        F.when(size % 19 == 0, F.concat(F.lit("runs/../../"), path))
        .when(size % 23 == 0, F.concat(F.lit("runs/../"), path))
        .otherwise(path),
    )


def quality_results(spark: SparkSession, folder: str) -> DataFrame:
    """Check outcomes: each line votes on one check of its order's run."""
    position = F.pmod(F.col("l_partkey"), F.lit(len(m.CHECKS))).cast("int")
    names = F.array(*[F.lit(check.name) for check in m.CHECKS])
    failed = F.col("l_returnflag") == "R"
    return (
        _lines(spark, folder)
        .groupBy("run_id", position.alias("check_order"))
        .agg(
            F.max(F.when(failed, 1).otherwise(0)).alias("__failed"),
            F.count_if(failed).cast("double").alias("observed_value"),
        )
        .select(
            "run_id",
            "check_order",
            F.get(names, F.col("check_order")).alias("check_name"),
            F.when(F.col("__failed") == 1, "fail").otherwise("pass").alias("status"),
            "observed_value",
        )
    )


def run_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """(run_id, metric_name, metric_value) with gaps: an order's lines cover some metrics."""
    names = F.array(*[F.lit(rule[0]) for rule in m.DRIFT_RULES])
    position = F.pmod(F.col("l_suppkey"), F.lit(len(m.DRIFT_RULES))).cast("int")
    return (
        _lines(spark, folder)
        .groupBy("run_id", position.alias("__position"))
        .agg(F.max("l_quantity").alias("metric_value"))
        .select("run_id", F.get(names, F.col("__position")).alias("metric_name"), "metric_value")
    )


def drift_results(spark: SparkSession, folder: str) -> DataFrame:
    """Drift rows: largest against smallest price of an order's lines per metric."""
    rules = profiles.drift_rules()
    position = F.pmod(F.col("l_suppkey"), F.lit(len(m.DRIFT_RULES))).cast("int")
    grouped = (
        _lines(spark, folder)
        .groupBy("run_id", "l_orderkey", position.alias("__position"))
        .agg(
            F.max("l_extendedprice").alias("current_value"),
            F.min("l_extendedprice").alias("baseline_value"),
        )
    )
    ruled = grouped.withColumn("rule", F.get(rules, F.col("__position"))).select(
        "run_id",
        F.when(F.col("l_orderkey") > 0, run_id_of(F.col("l_orderkey") - 1)).alias(
            "baseline_run_id"
        ),
        "current_value",
        "baseline_value",
        "rule.*",
    )
    return profiles.with_drift(ruled).select(*profiles.DRIFT_COLUMNS)


def relation_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Row count per relation in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("relation_name"), "row_count"
        )
        for name, df in relations.items()
    ]
    return reduce(DataFrame.unionAll, parts)
