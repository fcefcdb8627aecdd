from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import feeds
import pytest
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.operators import profiles
from lakegate.plans.pipeline import SnapshotError, SnapshotPipeline, config_hash, resolve_interval
from lakegate.plans.published import PublishedSnapshot


def _run(pipeline: SnapshotPipeline, name: str, data=None, **options):
    root = Path(pipeline.store.root)
    paths = feeds.write(root, name, data or feeds.rows())
    return pipeline.run(paths, days=feeds.DAYS, as_of=options.pop("as_of", feeds.END), **options)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """One published snapshot shared by the read-only tests."""
    pipeline = SnapshotPipeline(spark, str(tmp_path_factory.mktemp("store")))
    return pipeline, _run(pipeline, "first", seed=7)


def test_publishes_a_clean_snapshot(built):
    pipeline, result = built
    assert result.published and result.status == "success" and not result.failed_checks
    assert result.counts == {
        "raw_trips": 72,
        "silver_trips": 72,
        "rejected_trips": 0,
        "gold_hourly_rows": pipeline.store.read_published("gold.hourly_mobility").count(),
    }
    run = pipeline.store.runs().collect()[0]
    assert run["status"] == "success" and run["published_at"] == run["ended_at"]
    assert run["config_sha256"] == config_hash(feeds.DAYS, 7, feeds.END)
    assert (run["quality_passed"], run["quality_failed"]) == (13, 0)
    for relation in ("silver.trips", "silver.trip_enriched", "gold.daily_station_performance"):
        assert pipeline.store.read_published(relation).count() > 0


def test_ids_keep_leading_zeros_and_files_are_recorded(built):
    pipeline, result = built
    stations = pipeline.store.read_published("silver.stations")
    assert {row[0] for row in stations.select("station_id").collect()} == {
        "001", "002", "003", "004"
    }
    trips = pipeline.store.read_published("silver.trips").first()
    assert trips["source_file"] == "runs/first/trips.csv"
    assert trips["source_run_id"] == result.run_id
    files = {
        row["dataset_name"]: row for row in pipeline.store.evidence("ingest_files").collect()
    }
    assert sorted(files) == sorted(m.DATASETS)
    path = Path(pipeline.store.raw_root) / files["trips"]["source_file"]
    assert files["trips"]["file_bytes"] == path.stat().st_size
    assert files["trips"]["row_count"] == 72


def test_input_hash_is_the_hash_of_the_sorted_manifest(built):
    import hashlib
    import json

    pipeline, result = built
    rows = pipeline.store.evidence("ingest_files").orderBy("dataset_name").collect()
    names = ("dataset_name", "file_bytes", "file_sha256", "row_count")
    text = json.dumps([{n: row[n] for n in names} for row in rows], separators=(",", ":"))
    assert hashlib.sha256(text.encode()).hexdigest() == result.input_set_sha256


def test_served_queries(built):
    pipeline, result = built
    served = PublishedSnapshot(pipeline.store)
    summary = served.summary().first()
    assert summary["total_trips"] == 72 and summary["snapshot_run_id"] == result.run_id
    assert summary["total_revenue"] == pytest.approx(72 * 5.2)
    assert summary["validation_rate"] == 1.0
    one_zone = served.summary(zone_id="Z01", rider_type="member").first()
    assert 0 < one_zone["total_trips"] < 72
    assert served.summary(start_date=date(2030, 1, 1)).first()["total_revenue"] == 0
    assert served.timeseries().count() == 12
    assert served.zones().count() == 2
    assert served.stations(limit=3).count() == 3
    assert served.filter_window().first()["end_date"] == feeds.END
    assert [row["zone_name"] for row in served.filter_zones().collect()] == ["Centre", "Harbour"]
    assert served.quality().count() == 13
    assert served.ingest_files().count() == 4
    assert served.lineage().count() == 9
    assert served.drift_summary().first()["status"] == "no_baseline"
    detail = served.run_detail(result.run_id)
    wide = detail["run"].first()
    assert wide["is_current_snapshot"] and wide["previous_published_run_id"] is None
    assert wide["source_rows_delta"] == wide["source_rows"] == 72 + 72 + 4 + 48
    assert wide["silver_trips_delta"] is None and "error_message" not in wide
    assert detail["fingerprints"].count() == 6 and detail["profiles"].count() == 12


@pytest.mark.parametrize(
    "call",
    [
        lambda s: s.stations(limit=0),
        lambda s: s.stations(limit=51),
        lambda s: s.summary(start_date=date(2024, 3, 2), end_date=date(2024, 3, 1)),
        lambda s: s.zones(zone_id="ZZ1"),
        lambda s: s.timeseries(rider_type="guest"),
        lambda s: s.run_detail("nonsense"),
    ],
)
def test_bad_arguments_are_refused(built, call):
    with pytest.raises(ValueError):
        call(PublishedSnapshot(built[0].store))


def test_unknown_run_and_empty_store(built, spark, tmp_path):
    with pytest.raises(LookupError):
        PublishedSnapshot(built[0].store).run_detail("20240101000000-deadbeef")
    empty = SnapshotPipeline(spark, str(tmp_path))
    with pytest.raises(LookupError):
        PublishedSnapshot(empty.store)
    state = empty.store.readiness().first()
    assert state["status"] == "not_ready" and "silver.trip_enriched" in state["missing_tables"]
    ready = built[0].store.readiness().first()
    assert ready["status"] == "ready" and ready["missing_tables"] == ""


def test_failing_gate_keeps_the_old_snapshot(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    good = _run(pipeline, "good")
    data = feeds.rows()
    data["trips"][0]["ended_at"] = data["trips"][0]["started_at"]
    with pytest.raises(SnapshotError, match="trip_contract_rejections"):
        _run(pipeline, "bad", data)
    assert pipeline.store.published_run_id() == good.run_id
    newest = PublishedSnapshot(pipeline.store).pipeline_runs().first()
    assert newest["status"] == "failed_quality" and newest["published_at"] is None
    assert newest["failure_summary"] == m.FAILED_GATE
    checks = {
        row["check_name"]: row
        for row in PublishedSnapshot(pipeline.store).quality(newest["run_id"]).collect()
    }
    assert len(checks) == 13
    assert checks["trip_contract_rejections"]["observed_value"] == 1
    assert checks["data_interval_end_gap_days"]["status"] == "pass"

    lenient = _run(pipeline, "override", data, fail_on_quality=False)
    assert lenient.status == "failed_quality" and lenient.published
    assert pipeline.store.published_run_id() == lenient.run_id


def test_drift_blocks_publication(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    good = _run(pipeline, "good")
    data = feeds.rows(shift_days=1)
    for trip in data["trips"]:
        trip["rider_type"] = "member"
    with pytest.raises(SnapshotError, match="cross_snapshot_drift"):
        _run(pipeline, "shift", data, as_of=feeds.END + timedelta(days=1))
    assert pipeline.store.published_run_id() == good.run_id
    served = PublishedSnapshot(pipeline.store)
    rows = served.drift().collect()
    assert len(rows) == 9 and rows[0]["status"] == "fail"
    failed = {row["metric_name"] for row in rows if row["status"] == "fail"}
    assert failed == {"member_share", "casual_share", "corporate_share"}
    rollup = profiles.drift_rollup(served.drift()).first()
    assert (rollup["status"], rollup["failed_metrics"]) == ("breached", 3)


def test_replay_reproduces_the_snapshot(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    first = _run(pipeline, "first")
    again = pipeline.replay(first.run_id)
    assert again.run_id != first.run_id
    assert again.input_set_sha256 == first.input_set_sha256
    assert again.output_set_sha256 == first.output_set_sha256
    assert again.baseline_run_id == first.run_id
    run = pipeline.store.runs().where(F.col("run_id") == again.run_id).first()
    assert (run["source_mode"], run["replay_of_run_id"]) == ("replay", first.run_id)
    assert PublishedSnapshot(pipeline.store).run_id == again.run_id


def test_replay_refuses_changed_files(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    first = _run(pipeline, "first")
    trips = tmp_path / "raw" / "runs" / "first" / "trips.csv"
    original = trips.read_bytes()

    trips.write_bytes(original + b"\n")
    with pytest.raises(SnapshotError, match="size mismatch"):
        pipeline.replay(first.run_id)
    trips.write_bytes(original.replace(b"12.0", b"13.0", 1))
    with pytest.raises(SnapshotError, match="SHA-256 mismatch"):
        pipeline.replay(first.run_id)
    trips.write_bytes(original)
    assert pipeline.store.published_run_id() == first.run_id
    newest = PublishedSnapshot(pipeline.store).pipeline_runs().first()
    assert newest["failure_summary"] == m.FAILED_REPLAY_INPUT
    with pytest.raises(LookupError):
        pipeline.replay("20240101000000-deadbeef")


def test_empty_accepted_set_fails_the_gap_check(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    data = feeds.rows()
    for trip in data["trips"]:
        trip["ended_at"] = trip["started_at"]
    with pytest.raises(SnapshotError):
        _run(pipeline, "bad", data)
    checks = {row["check_name"]: row for row in pipeline.store.evidence("quality_results").collect()}
    assert len(checks) == 13
    gap = checks["data_interval_end_gap_days"]
    assert gap["observed_value"] is None and gap["status"] == "fail"
    assert checks["payment_match_rate"]["observed_value"] == 0


def test_interval_bounds():
    today = date(2024, 3, 10)
    assert resolve_interval(3, None, today) == (date(2024, 3, 7), date(2024, 3, 9))
    with pytest.raises(ValueError):
        resolve_interval(3, today, today)
    with pytest.raises(ValueError):
        resolve_interval(1, None, today)


def test_evidence_of_an_empty_set_removes_old_rows(built, spark):
    store = built[0].store
    rows = spark.createDataFrame(
        [("b", "m", 1.0, 1.0, 0.0, "absolute", 0.1, "pass")],
        "baseline_run_id string, metric_name string, current_value double, "
        "baseline_value double, delta double, delta_kind string, threshold double, status string",
    )
    assert store.write_evidence("drift_results", "20200101000000-00000001", rows).count() == 1
    assert store.write_evidence("drift_results", "20200101000000-00000001", rows.limit(0)).count() == 0


def test_many_files_per_dataset(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    data = feeds.rows()
    first = feeds.write(tmp_path, "a", {**data, "trips": data["trips"][:30]})
    rest = feeds.write(tmp_path, "b", {"trips": data["trips"][30:]})
    sources = {**first, "trips": [*first["trips"], *rest["trips"]]}
    result = pipeline.run(sources, days=feeds.DAYS, as_of=feeds.END)
    assert result.published and result.counts["raw_trips"] == 72
    assert pipeline.store.evidence("ingest_parts").count() == 5
    assert pipeline.replay(result.run_id).output_set_sha256 == result.output_set_sha256
