from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakegate.operators import history, ranges


@pytest.mark.parametrize("n", [0, 1, 500])
def test_positions_and_running_sum(spark, n):
    keys = random.Random(5).sample(range(10 * n + 1), n)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k int, v int").repartition(3)
    got = {r["k"]: r["at"] for r in ranges.positions(df, "k", "at").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    summed = ranges.exclusive_scan(df, "k", F.col("v"), "s", function=F.sum, combine=ranges.add)
    total, want = 0, {}
    for k in sorted(keys):
        want[k] = total
        total += k % 7
    assert {r["k"]: r["s"] for r in summed.collect()} == want


def _runs(spark, n: int):
    """All runs start on one day, some at the same moment, some never published, one without a start."""
    rng, day = random.Random(9), datetime(2024, 3, 1)
    rows = [
        (f"r{i:04}", day + timedelta(seconds=rng.randrange(n)), day + timedelta(seconds=rng.randrange(10 * n)) if rng.random() < 0.4 else None)
        for i in range(n)
    ]
    rows.append(("none", None, day + timedelta(days=9)))
    schema = "run_id string, started_at timestamp_ntz, published_at timestamp_ntz"
    return rows, spark.createDataFrame(rows, schema).repartition(4)


def test_previous_published_on_one_day(spark):
    rows, df = _runs(spark, 400)
    got = {r["run_id"]: r["previous"] for r in history.previous_published(df).collect()}
    assert len(got) == len(rows)
    for run_id, start, _ in rows:
        earlier = [(p, r) for r, s, p in rows if p and start and (s is None or s < start)]
        want = max(earlier, default=None)
        assert (got[run_id] and (got[run_id]["published_at"], got[run_id]["run_id"])) == want, run_id


def test_starts_of_one_day_are_dealt_over_all_tasks(spark):
    _, df = _runs(spark, 2000)
    starts = df.select("started_at").distinct()
    sizes = [
        r["count"]
        for r in starts.repartitionByRange(ranges.tasks(df), "started_at")
        .groupBy(F.spark_partition_id()).count().collect()
    ]
    assert len(sizes) == ranges.tasks(df) and max(sizes) < 2 * sum(sizes) / len(sizes)
