from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.operators import (
    evidence,
    fingerprints,
    history,
    joins,
    lineage,
    manifests,
    profiles,
    quality,
    serving,
)


def test_profiles_of_three_trips(spark):
    enriched = spark.createDataFrame(
        [
            ("t1", "member", 10.0, 10.0, 2.0, True),
            ("t2", "casual", None, 20.0, 4.0, False),
            ("t3", "corporate", 20.0, 30.0, 6.0, True),
        ],
        "trip_id string, rider_type string, total_amount double, duration_min double, "
        "distance_km double, has_payment boolean",
    )
    trips = spark.createDataFrame(
        [("t1", "s1"), ("t2", "s2"), ("t3", "s1")], "trip_id string, start_station_id string"
    )
    rows = profiles.dataset_profiles(trips, enriched, spark.range(2), days=2).collect()
    values = {row["metric_name"]: row["metric_value"] for row in rows}
    assert values == pytest.approx(
        {
            "total_trips": 3,
            "daily_trip_rate": 1.5,
            "total_revenue": 30,
            "revenue_per_trip": 10,
            "avg_duration_min": 20,
            "avg_distance_km": 4,
            "payment_match_rate": 2 / 3,
            "member_share": 1 / 3,
            "casual_share": 1 / 3,
            "corporate_share": 1 / 3,
            "active_stations": 2,
            "gold_hourly_rows": 2,
        }
    )
    assert {row["metric_name"]: row["unit"] for row in rows} == m.PROFILE_UNITS
    empty = profiles.dataset_profiles(
        trips.limit(0), enriched.limit(0), spark.range(0), days=2
    ).collect()
    nothing = {row["metric_name"]: row["metric_value"] for row in empty}
    assert nothing["total_revenue"] == 0 and nothing["payment_match_rate"] is None
    with pytest.raises(ValueError):
        profiles.dataset_profiles(trips, enriched, spark.range(2), days=0)


@pytest.mark.parametrize("limit", [joins.BROADCAST_LIMIT_BYTES, -1])
def test_drift_thresholds(spark, limit):
    values = {
        "daily_trip_rate": (100.0, 126.0),
        "revenue_per_trip": (10.0, 12.0),
        "avg_duration_min": (15.0, 15.0),
        "avg_distance_km": (4.0, None),
        "payment_match_rate": (0.98, 0.94),
        "member_share": (0.50, 0.60),
        "casual_share": (0.0, 0.0),
        "active_stations": (0.0, 89.0),
    }
    rows = [("base", name, pair[0]) for name, pair in values.items()]
    rows += [("cur", name, pair[1]) for name, pair in values.items()]
    stored = spark.createDataFrame(rows, "run_id string, metric_name string, metric_value double")
    pairs = spark.createDataFrame([("cur", "base")], "run_id string, baseline_run_id string")
    found = {r["metric_name"]: r for r in profiles.compare_profiles(pairs, stored, limit=limit).collect()}
    assert len(found) == 9
    assert {name: row["status"] for name, row in found.items()} == {
        "daily_trip_rate": "fail",
        "revenue_per_trip": "pass",
        "avg_duration_min": "pass",
        "avg_distance_km": "fail",
        "payment_match_rate": "fail",
        "member_share": "pass",
        "casual_share": "pass",
        "corporate_share": "fail",
        "active_stations": "fail",
    }
    assert found["daily_trip_rate"]["delta"] == pytest.approx(0.26)
    assert found["active_stations"]["delta"] is None
    assert found["corporate_share"]["current_value"] is None


def _sample(spark):
    return spark.createDataFrame(
        [("a", 1.5, True, "x"), ("a", 1.5, True, "y"), ("b", -0.0, None, "z"), (None, 1e300, False, "z")],
        "k string, v double, f boolean, loaded string",
    )


def test_fingerprint_is_of_the_bag(spark):
    columns = ["k", "v", "f"]

    def sha(df, name="r"):
        return fingerprints.relation_fingerprint(df, name, columns).first()["fingerprint_sha256"]

    df = _sample(spark)
    base = sha(df)
    assert sha(df.repartition(7).orderBy(F.desc("k"))) == base
    assert sha(df.withColumn("loaded", F.lit("later"))) == base
    assert sha(df.withColumn("v", F.when(F.col("v") == 0, 0.0).otherwise(F.col("v")))) == base
    assert sha(df.union(df.limit(1))) != base
    assert sha(df.union(df)) != base
    assert sha(df.dropDuplicates(columns)) != base
    assert sha(df.withColumn("v", F.col("v") + 1e-9)) != base
    assert sha(df.withColumn("k", F.coalesce("k", F.lit("n")))) != base
    assert sha(df.limit(0)) == sha(df.where("false"))


def test_text_cells_cannot_run_together(spark):
    ddl = "a string, b string"
    left = spark.createDataFrame([("x|s1:y", "z")], ddl)
    right = spark.createDataFrame([("x", "y|s1:z")], ddl)
    assert (
        fingerprints.relation_fingerprint(left, "r", ["a", "b"]).first()
        != fingerprints.relation_fingerprint(right, "r", ["a", "b"]).first()
    )


def test_output_set_hash_ignores_order(spark):
    import hashlib

    rows = [("b", 2, "22"), ("a", 1, "11"), ("c", 3, "33")]
    ddl = "relation_name string, row_count bigint, fingerprint_sha256 string"
    expected = hashlib.sha256(b"a:1:11\nb:2:22\nc:3:33").hexdigest()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, ddl)
        assert fingerprints.output_set_hash(df).first()[0] == expected
    changed = spark.createDataFrame([("b", 2, "22"), ("a", 1, "12")], ddl)
    compared = fingerprints.compare_fingerprints(spark.createDataFrame(rows, ddl), changed)
    assert {r["relation_name"]: r["equivalent"] for r in compared.collect()} == {
        "a": False, "b": True, "c": False
    }


RUNS_DDL = (
    "run_id string, started_at timestamp_ntz, ended_at timestamp_ntz, "
    "published_at timestamp_ntz, days_requested int, contract_version string, "
    "silver_trips bigint, rejected_trips bigint, gold_hourly_rows bigint"
)


def _runs(spark):
    def run(name, day, days, contract, published=True, ended=True):
        at = datetime(2026, 1, day)
        return (name, at, at if ended else None, at if published else None, days, contract,
                day * 10, day, day)

    rows = [
        run("old", 1, 7, "v1"),
        run("latest", 2, 7, "v1"),
        run("wrong-days", 3, 8, "v1"),
        run("wrong-contract", 4, 7, "v0"),
        run("unpublished", 5, 7, "v1", published=False),
        run("current", 6, 7, "v1", published=False, ended=False),
    ]
    return spark.createDataFrame(rows, RUNS_DDL)


def test_baseline_choice(spark):
    runs = _runs(spark)
    assert history.baseline_for(runs, "current", 7, "v1").first()["run_id"] == "latest"
    assert history.baseline_for(runs, "current", 30, "v1").isEmpty()
    every = {r["run_id"]: r["baseline_run_id"] for r in history.baselines(runs).collect()}
    assert every == {
        "old": "latest",
        "latest": "old",
        "wrong-days": None,
        "wrong-contract": None,
        "unpublished": "latest",
        "current": "latest",
    }


def test_previous_run_against_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(400):
        start = datetime(2026, 1, rng.randint(1, 9), rng.choice([0, 0, 0, 5]), rng.randint(0, 2))
        shown = datetime(2026, 2, rng.randint(1, 28), rng.randint(0, 23)) if i % 3 else None
        rows.append((f"r{i:03d}", start, start, shown, 7, "v1", i, i, i))
    runs = spark.createDataFrame(rows, RUNS_DDL)
    found = {
        r["run_id"]: r["previous_published_run_id"] for r in history.run_deltas(runs).collect()
    }
    for run_id, start, *_ in rows:
        earlier = [(r[3], r[0]) for r in rows if r[3] and r[1] < start]
        assert found[run_id] == (max(earlier)[1] if earlier else None)


def test_single_and_bulk_run_detail_agree(spark):
    runs = _runs(spark).withColumns(
        {"status": F.lit("success"), "error_message": F.lit(None).cast("string")}
    )
    files = spark.createDataFrame(
        [("old", "trips", 5, 50), ("latest", "trips", 7, 40), ("latest", "weather", 1, 1)],
        "run_id string, dataset_name string, row_count bigint, file_bytes bigint",
    )
    names = (
        "previous_published_run_id", "source_rows", "source_rows_delta", "source_bytes_delta",
        "silver_trips_delta", "silver_trips_delta_percent", "is_current_snapshot",
        "runtime_seconds",
    )
    bulk = {r["run_id"]: r for r in evidence.run_details(runs, files).collect()}
    for run_id in ("old", "latest", "wrong-days", "current"):
        one = evidence.run_detail(runs, files, run_id).first()
        assert [one[n] for n in names] == [bulk[run_id][n] for n in names], run_id
    assert bulk["latest"]["source_rows_delta"] == 3
    assert bulk["old"]["silver_trips_delta"] is None


@pytest.mark.parametrize(
    ("status", "message", "expected"),
    [
        ("failed_quality", "Quality checks failed: drift", m.FAILED_GATE),
        ("failed", "Replay source SHA-256 mismatch: /data/x", m.FAILED_REPLAY_INPUT),
        ("failed", "Replay output fingerprint mismatch; not equivalent to source",
         m.FAILED_REPLAY_OUTPUT),
        ("failed", "Permission denied: /secret", m.FAILED_OTHER),
        ("failed", None, m.FAILED_OTHER),
        ("success", None, None),
    ],
)
def test_failure_summary(spark, status, message, expected):
    df = spark.createDataFrame([(status, message)], "status string, error_message string")
    public = history.public_runs(df).first()
    assert public["failure_summary"] == expected and "error_message" not in public


def test_status_labels(spark):
    at = datetime(2026, 1, 1)
    cases = [
        ("failed_quality", at, "Published with failed gates"),
        ("failed_quality", None, "Quality failed"),
        ("failed", None, "Failed"),
        ("running", None, "Running"),
        ("success", at, "Published"),
        ("success", None, "Succeeded"),
        ("on_hold", None, "On Hold"),
        (None, None, "Unknown"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "status string, published_at timestamp_ntz")
    labels = df.select(history.status_label(F.col("status"), F.col("published_at"))).collect()
    assert [row[0] for row in labels] == [c[2] for c in cases]


def test_manifest_verification(spark):
    ddl = "run_id string, dataset_name string, source_file string, file_sha256 string, file_bytes bigint"
    recorded = spark.createDataFrame(
        [
            ("r", "trips", "runs/r/trips.csv", "aa", 1),
            ("r", "payments", "runs/../../p.csv", "bb", 2),
            ("r", "stations", "runs/r/s.csv", "cc", 3),
            ("r", "weather", "runs/x/../r/w.csv", "dd", 4),
            ("q", "trips", "/abs.csv", "ee", 5),
            ("q", "weather", "w.csv", "ff", 6),
        ],
        ddl,
    )
    observed = spark.createDataFrame(
        [("r", "trips", "", "aa", 1), ("r", "payments", "", "bb", 2), ("r", "stations", "", "xx", 3),
         ("r", "weather", "", "dd", 9), ("q", "trips", "", "ee", 5), ("q", "extra", "", "ee", 5)],
        ddl,
    ).drop("source_file")
    verdicts = manifests.verify_manifest(recorded, observed)
    seen = {(r["run_id"], r["dataset_name"]): r["verdict"] for r in verdicts.collect()}
    assert seen == {
        ("r", "trips"): "complete",
        ("r", "payments"): "escapes_root",
        ("r", "stations"): "sha_mismatch",
        ("r", "weather"): "size_mismatch",
        ("q", "trips"): "escapes_root",
        ("q", "weather"): "missing",
        ("q", "extra"): "unexpected",
    }
    assert not any(r["replayable"] for r in manifests.replayable(verdicts).collect())


def test_quality_evidence_operators(spark):
    ddl = "run_id string, check_order int, check_name string, status string"
    checks = spark.createDataFrame(
        [("a", 2, "two", "fail"), ("a", 1, "one", "fail"), ("a", 3, "three", "pass"),
         ("b", 1, "one", "pass")],
        ddl,
    )
    tally = {r["run_id"]: r for r in quality.tally(checks).collect()}
    assert tally["a"]["quality_failed"] == 2 and tally["b"]["validation_rate"] == 1.0
    message = quality.failed_check_messages(checks).collect()
    assert [(r["run_id"], r["error_message"]) for r in message] == [
        ("a", "Quality checks failed: one, two")
    ]
    decided = quality.publish_decision(quality.tally(checks))
    assert {r["run_id"]: (r["status"], r["published"]) for r in decided.collect()} == {
        "a": ("failed_quality", False), "b": ("success", True)
    }
    replaced = evidence.upsert(
        checks, spark.createDataFrame([("a",)], "run_id string"), checks.limit(0)
    )
    assert {r["run_id"] for r in replaced.collect()} == {"b"}


def test_sampling_and_shares(spark):
    start = datetime(2026, 1, 1)
    points = spark.range(100).select(
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int")))
        .alias("trip_hour"),
        F.col("id"),
    ).repartition(5)
    kept = sorted(r["id"] for r in serving.sample_points(points, 30).collect())
    assert kept == list(range(0, 100, 4))
    assert serving.sample_points(points, 100).count() == 100
    zones = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 1.0)], "z string, revenue double")
    shares = {r["z"]: r["revenue_share"] for r in serving.revenue_share(zones).collect()}
    assert shares == {"a": 0.75, "b": 0.0, "c": 0.25}
    none = serving.revenue_share(zones.where("z = 'b'")).first()
    assert none["revenue_share"] == 0.0


def test_lineage(spark):
    edges = lineage.lineage_edges(spark)
    assert [tuple(r) for r in edges.collect()] == list(m.LINEAGE_EDGES)
