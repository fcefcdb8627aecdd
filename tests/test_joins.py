from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lakegate.operators import contracts, enrich, joins


def _facts(spark):
    """A third of the rows share one key, some have none, and copies are exact."""
    rows = ["hot"] * 3000 + [None] * 500 + [f"k{i % 700}" for i in range(5500)]
    return spark.createDataFrame([(key,) for key in rows], "key string").repartition(6)


def _dim(spark):
    """One hot key has two rows; some keys are missing."""
    rows = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 700, 2)]
    return spark.createDataFrame(rows, "dim_key string, value int")


@contextmanager
def _plain_shuffles(spark, tasks):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(tasks),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _weighted(spark):
    """One key with half of all rows, one with 0.5 %, others even; a tenth has none."""
    rows = ["half"] * 20_000 + ["small"] * 200 + [None] * 4_000 + [f"k{i}" for i in range(15_800)]
    return spark.createDataFrame([(key,) for key in rows], "key string").repartition(5)


@pytest.mark.parametrize("tasks,parts", [(4, {"half": 8}), (40, {"half": 80}), (200, {"half": 400, "small": 4})])
def test_keys_get_parts_by_their_weight(spark, tasks, parts):
    with _plain_shuffles(spark, tasks):
        found = joins.key_splits(_weighted(spark), "key").collect()
        assert {r["__split_key"]: r["__parts"] for r in found} == parts
        assert joins.key_splits(_weighted(spark).limit(0), "key").collect() == []


def _largest_share(df) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / (sum(sizes) / 40)


def test_no_task_gets_much_more_than_its_share(spark):
    """Largest task against the average, on the routes that shuffle by a key."""
    with _plain_shuffles(spark, 40):
        facts = joins.with_row_id(_weighted(spark))
        keys = [r["key"] for r in facts.select("key").distinct().collect() if r["key"]]
        dim = spark.createDataFrame([(k, 1) for k in keys], "dim_key string, value int")
        splits = joins.key_splits(facts, "key")
        joined = joins.salted_left_join(facts, dim, "key", "dim_key", splits)
        assert joined.count() == 40_000 and joined.where("key IS NOT NULL AND value IS NULL").count() == 0
        assert _largest_share(joined) < 3
        assert _largest_share(joins.salted_left_join(facts, dim, "key", "dim_key")) > 15

        looked = joins.lookup_join(facts, dim, "key", "dim_key", right_bytes=9, splits=splits, limit=1)
        assert _largest_share(looked) < 3

        counted = contracts.attach_key_counts(facts, {"key": "n"}, limit=-1)
        assert _largest_share(counted) < 3
        got = {(r["key"], r["n"]) for r in counted.select("key", "n").distinct().collect()}
        assert {("half", 20_000), ("small", 200), (None, None), ("k7", 1)} <= got

        payments = spark.createDataFrame(
            [(k, f"p{i}", 1.0) for i, k in enumerate(keys)], "trip_id string, payment_id string, x double"
        ).select("trip_id", "payment_id", *[F.col("x").alias(c) for c in (
            "fare_amount", "discount_amount", "tax_amount", "total_amount")], F.lit("card").alias("payment_method"))
        trips = facts.withColumnRenamed("key", "trip_id")
        assert _largest_share(enrich.join_payments(trips, payments, splits={"trip_id": splits})) < 3


@pytest.mark.parametrize("split", [False, True])
def test_salted_join_equals_plain_join(spark, split):
    facts, dim = joins.with_row_id(_facts(spark)), _dim(spark)
    plain = facts.join(dim, F.col("key") == F.col("dim_key"), "left")
    splits = joins.key_splits(facts, "key") if split else None
    salted = joins.salted_left_join(facts, dim, "key", "dim_key", splits)

    def bag(df):
        return Counter((row["key"], row["value"]) for row in df.select("key", "value").collect())

    assert bag(salted) == bag(plain)
    assert sum(bag(salted).values()) == 9000 + 3000


def test_lookup_join_broadcasts_by_size(spark):
    facts, dim = joins.with_row_id(_facts(spark)), _dim(spark)
    size = joins.content_bytes({"dim": dim})["dim"]
    assert size == sum(16 + len(row["dim_key"]) for row in dim.collect())

    def plan(limit):
        joined = joins.lookup_join(
            facts, dim, "key", "dim_key", right_bytes=size, limit=limit
        )
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(size)
    assert "strategy=broadcast" not in plan(size - 1)


@pytest.mark.parametrize("limit", [joins.BROADCAST_LIMIT_BYTES, -1])
def test_enrichment_is_the_same_on_both_routes(spark, limit):
    trips = spark.createDataFrame(
        [
            ("t1", "2024-01-01 10:20:00", "a", "b"),
            ("t1", "2024-01-01 10:20:00", "a", "b"),
            ("t2", "2024-01-01 11:59:59.9", "a", "zz"),
            ("t3", "2024-01-01 12:00:00", None, "b"),
        ],
        "trip_id string, started_at string, start_station_id string, end_station_id string",
    ).withColumn("started_at", F.col("started_at").cast("timestamp_ntz"))
    payments = spark.createDataFrame(
        [("t1", "p1", 1.0, 0.0, 0.0, 1.0, "card")],
        "trip_id string, payment_id string, fare_amount double, discount_amount double, "
        "tax_amount double, total_amount double, payment_method string",
    )
    stations = spark.createDataFrame(
        [("a", "A", "Z01", "One", "x"), ("b", "B", "Z02", "Two", "y")],
        "station_id string, station_name string, zone_id string, zone_name string, "
        "zone_type string",
    )
    weather = spark.createDataFrame(
        [("2024-01-01 10:00:00", 5.0), ("2024-01-01 11:30:00", 6.0)], "observed_at string, t double"
    ).select(
        F.col("observed_at").cast("timestamp_ntz").alias("observed_at"),
        F.col("t").alias("temp_c"),
        F.lit(0.0).alias("rain_mm"),
        F.lit(1.0).alias("wind_kph"),
        F.lit("rain").alias("condition"),
    )
    columns = (
        "trip_id", "trip_hour", "start_zone_id", "end_station_name", "total_amount", "temp_c",
        "has_payment",
    )
    rows = enrich.enrich_trips(trips, payments, stations, weather, columns, limit=limit).collect()
    seen = sorted((r["trip_id"], r["trip_hour"].hour, r["start_zone_id"], r["end_station_name"],
                   r["total_amount"], r["temp_c"], r["has_payment"]) for r in rows)
    assert seen == [
        ("t1", 10, "Z01", "B", 1.0, 5.0, True),
        ("t1", 10, "Z01", "B", 1.0, 5.0, True),
        ("t2", 11, "Z01", None, None, None, False),
        ("t3", 12, None, "B", None, None, False),
    ]
