from __future__ import annotations

import feeds
import pytest
from pyspark.sql import functions as F

from lakegate.operators import fingerprints
from lakegate.plans.pipeline import SnapshotError, SnapshotPipeline

COLUMNS = ("trip_id", "revenue", "trip_date")


def _fact(spark, parts=3):
    rows = [(f"t{i}", i / 3, f"2024-01-{i % 5 + 1:02d}") for i in range(200)] + [("t0", 0.0, "2024-01-01"), ("x", None, None)]
    df = spark.createDataFrame(rows, "trip_id string, revenue double, trip_date string")
    return df.withColumn("trip_date", F.col("trip_date").cast("date")).repartition(parts)


def _sums(df):
    return fingerprints.day_sums(df, "fact", COLUMNS, "trip_date")


def test_days_add_up_to_the_relation(spark):
    fact = _fact(spark)
    whole = fingerprints.relation_fingerprint(fact, "fact", COLUMNS).collect()
    days = _sums(_fact(spark, 7))
    assert {r["partition_key"] for r in days.collect()} == {"", *(f"2024-01-0{i}" for i in range(1, 6))}
    assert fingerprints.from_day_sums(days, ["fact"]).collect() == whole
    none = fingerprints.from_day_sums(days.limit(0), ["fact"]).collect()
    assert none == fingerprints.relation_fingerprint(fact.limit(0), "fact", COLUMNS).collect()


def test_a_changed_revenue_names_its_day(spark):
    stored = _sums(_fact(spark))
    changed = _fact(spark).withColumn("revenue", F.when(F.col("trip_id") == "t7", -1.0).otherwise(F.col("revenue")))
    compared = fingerprints.compare_days(stored, _sums(changed)).where("NOT equivalent").collect()
    assert [(r["partition_key"], r["source_rows"], r["rebuilt_rows"]) for r in compared] == [("2024-01-03", 40, 40)]
    gone = fingerprints.compare_days(stored, _sums(_fact(spark).where("trip_date IS DISTINCT FROM DATE'2024-01-05'")))
    assert [(r["partition_key"], r["rebuilt_rows"]) for r in gone.where("NOT equivalent").collect()] == [("2024-01-05", None)]


def test_only_changed_days_are_read_again(spark, tmp_path):
    path = str(tmp_path / "fact")
    changed = _fact(spark).withColumn("revenue", F.when(F.col("trip_id") == "t7", -1.0).otherwise(F.col("revenue")))
    changed.write.partitionBy("trip_date").parquet(path)
    fact = spark.read.parquet(path).select(*COLUMNS)
    again = fingerprints.refreshed(_sums(_fact(spark)), fact, "fact", COLUMNS, "trip_date", ["2024-01-03"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in _sums(changed).collect()}
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trip_date" in plan and "trip_date" in plan.split("PartitionFilters:")[1]


def test_a_replay_names_the_day_that_differs(spark, tmp_path, monkeypatch):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    sources = feeds.write(tmp_path, "first", feeds.rows())
    first = pipeline.run(sources, days=feeds.DAYS, as_of=feeds.END)
    from lakegate.operators import enrich

    plain = enrich.enrich_trips

    def dearer(*args, **kwargs):
        fact = plain(*args, **kwargs)
        raised = F.when(F.col("trip_id") == "T00000001", F.col("total_amount") + 1.0)
        return fact.withColumn("total_amount", raised.otherwise(F.col("total_amount"))).select(*fact.columns)

    monkeypatch.setattr(enrich, "enrich_trips", dearer)
    with pytest.raises(SnapshotError, match="Differing: .*silver.trip_enriched 2024-03-01"):
        pipeline.replay(first.run_id)
