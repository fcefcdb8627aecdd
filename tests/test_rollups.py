from __future__ import annotations

from datetime import date, datetime, timedelta

import feeds
import pytest
from pyspark.sql import functions as F

from lakegate.operators import marts, rollups, serving
from lakegate.operators.filters import FactFilter
from lakegate.plans.pipeline import SnapshotPipeline
from lakegate.plans.published import PublishedSnapshot

FILTERS = [
    FactFilter(),
    FactFilter(date(2024, 1, 2), date(2024, 1, 3)),
    FactFilter(zone_id="Z01", rider_type="member"),
    FactFilter(start_date=date(2025, 1, 1)),
]


def _fact(spark):
    rows = []
    for i in range(600):
        at = datetime(2024, 1, 1) + timedelta(minutes=11 * i)
        amount = None if i % 7 == 0 else (i * 37 % 1000) / 100 if i % 50 else 1e12 + i
        zone = None if i % 41 == 0 else f"Z{i % 3 + 1:02d}"
        rows.append((at.date(), at.replace(minute=0), zone, zone and f"Zone {zone}", f"s{i % 5}", f"Stop {i % 5}",
                     ("member", "casual", "corporate")[i % 3], amount, i % 9 + 0.1, amount is not None))
    schema = ("trip_date date, trip_hour timestamp_ntz, start_zone_id string, start_zone_name string, start_station_id string, "
              "start_station_name string, rider_type string, total_amount double, duration_min double, has_payment boolean")
    return spark.createDataFrame(rows, schema).repartition(5)


def _bag(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("where", FILTERS)
def test_the_rollup_answers_like_the_fact(spark, where):
    fact = _fact(spark)
    rollup = rollups.trip_rollup(fact).repartition(3)
    assert rollups.timeseries(rollup, where).collect() == serving.timeseries(fact, where).collect()
    assert _bag(rollups.zones(rollup, where)) == _bag(serving.zones(fact, where))
    assert rollups.stations(rollup, where, 3).collect() == serving.stations(fact, where, 3).collect()
    assert rollups.headline(rollup, where).collect() == marts.headline(where.apply(fact)).collect()


def test_what_a_rollup_covers(spark):
    rollup = rollups.trip_rollup(_fact(spark))
    assert rollups.covers(rollup, {"zone": "start_zone_id"})
    assert not rollups.covers(rollup, {"end": "end_zone_id"})
    assert not rollups.covers(rollup.drop("rider_type"), {})
    with pytest.raises(ValueError, match="end_zone_id"):
        rollups.answer(rollup, FactFilter(), {"end": "end_zone_id"})
    with pytest.raises(ValueError):
        rollups.stations(rollup, FactFilter(), 51)


def test_served_questions_do_not_read_the_fact(spark, tmp_path):
    pipeline = SnapshotPipeline(spark, str(tmp_path))
    pipeline.run(feeds.write(tmp_path, "first", feeds.rows()), days=feeds.DAYS, as_of=feeds.END)
    served = PublishedSnapshot(pipeline.store)
    fact = pipeline.store.read_published("silver.trip_enriched")
    where = FactFilter(feeds.END, feeds.END, "Z01")
    asked = dict(start_date=feeds.END, end_date=feeds.END, zone_id="Z01")
    for found, want in (
        (served.timeseries(**asked), serving.timeseries(fact, where)),
        (served.zones(**asked), serving.zones(fact, where)),
        (served.stations(**asked), serving.stations(fact, where)),
        (served.summary(**asked).select("total_trips", "total_revenue", "active_stations"), None),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        read = found.inputFiles()
        assert any("gold/trip_rollup/" in f for f in read) and not any("trip_enriched" in f for f in read)
        assert "PartitionFilters: [isnotnull(trip_date" in plan
        if want is not None:
            assert found.collect() == want.collect()
    assert served.summary(**asked).first()["total_trips"] == where.apply(fact).count()
    # A snapshot without a roll-up is answered from the fact.
    del asked["zone_id"]
    served._rollup = lambda: None
    assert served.zones(**asked).collect() == serving.zones(fact, FactFilter(feeds.END, feeds.END)).collect()
