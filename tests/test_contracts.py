from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.operators import contracts, joins

TRIP = {
    "trip_id": " T1 ",
    "started_at": "2026-07-01 08:14:00",
    "ended_at": "2026-07-01 08:29:12.345678",
    "start_station_id": "S1",
    "end_station_id": "S2",
    "rider_type": " Member",
    "vehicle_type": "SCOOTER ",
    "distance_km": "2.31",
    "duration_min": " 15.2 ",
}
PAYMENT = {
    "payment_id": "P1",
    "trip_id": "T1",
    "fare_amount": "5.00",
    "discount_amount": "0.40",
    "tax_amount": "0.60",
    "total_amount": "5.20",
    "payment_method": "card",
    "paid_at": "2026-07-01 08:31:00",
}


def _frame(spark, base: dict, changes: list[dict]):
    ddl = ", ".join(f"{name} string" for name in base)
    return spark.createDataFrame([tuple({**base, **change}.values()) for change in changes], ddl)


TRIP_CASES = [
    ({}, None),
    ({"trip_id": "  "}, "missing_trip_id"),
    ({"trip_id": None, "started_at": "x"}, "missing_trip_id"),
    ({"started_at": "not a time"}, "invalid_timestamp"),
    ({"started_at": "2026"}, "invalid_timestamp"),
    ({"ended_at": "10:00"}, "invalid_timestamp"),
    ({"ended_at": TRIP["started_at"]}, "non_positive_trip_window"),
    ({"end_station_id": " "}, "missing_station_id"),
    ({"rider_type": "guest"}, "invalid_rider_type"),
    ({"rider_type": ""}, "invalid_rider_type"),
    ({"rider_type": None}, None),
    ({"vehicle_type": "boat", "distance_km": "x"}, "invalid_vehicle_type"),
    ({"distance_km": "inf"}, "invalid_distance"),
    ({"distance_km": "1d"}, "invalid_distance"),
    ({"distance_km": "1,000"}, "invalid_distance"),
    ({"distance_km": "0"}, "invalid_distance"),
    ({"duration_min": "-inf"}, "invalid_duration"),
    ({"duration_min": "nan"}, "invalid_duration"),
    ({"duration_min": "1e1"}, None),
]


def test_trip_reasons(spark):
    raw = _frame(spark, TRIP, [change for change, _ in TRIP_CASES])
    judged = contracts.apply_contract(raw, m.TRIP_CONTRACT).coalesce(1).collect()
    assert [row[contracts.REASON] for row in judged] == [reason for _, reason in TRIP_CASES]
    first = judged[0]
    assert (first["trip_id"], first["rider_type"], first["vehicle_type"]) == (
        "T1", "member", "scooter"
    )
    assert first["duration_min"] == 15.2


def test_reject_null_enum_option(spark):
    raw = _frame(spark, TRIP, [{"rider_type": None}])
    judged = contracts.apply_contract(raw, m.TRIP_CONTRACT, reject_null_enum=True)
    assert judged.first()[contracts.REASON] == "invalid_rider_type"


PAYMENT_CASES = [
    ({}, None),
    ({"payment_id": " ", "trip_id": "a"}, "missing_payment_id"),
    ({"payment_id": "p2", "trip_id": ""}, "missing_trip_id"),
    ({"payment_id": "dup", "trip_id": "b"}, "duplicate_payment_id"),
    ({"payment_id": " dup", "trip_id": "c", "fare_amount": "x"}, "duplicate_payment_id"),
    ({"payment_id": "p3", "trip_id": "same"}, "duplicate_trip_payment"),
    ({"payment_id": "p4", "trip_id": "same "}, "duplicate_trip_payment"),
    ({"payment_id": "p5", "trip_id": "d", "fare_amount": "abc"}, "invalid_amount"),
    ({"payment_id": "p6", "trip_id": "e", "tax_amount": "inf"}, "invalid_amount"),
    ({"payment_id": "p7", "trip_id": "f", "discount_amount": "-1"}, "negative_amount"),
    ({"payment_id": "p8", "trip_id": "g", "total_amount": "5.23"}, "amount_reconciliation_failed"),
    ({"payment_id": "p9", "trip_id": "h", "payment_method": "cash"}, "invalid_payment_method"),
    ({"payment_id": "p10", "trip_id": "i", "paid_at": None}, "invalid_paid_at"),
    ({"payment_id": "p11", "trip_id": "j", "payment_method": None}, None),
]


@pytest.mark.parametrize("limit", [joins.BROADCAST_LIMIT_BYTES, -1])
def test_payment_reasons_on_both_join_routes(spark, monkeypatch, limit):
    original = contracts.attach_key_counts
    monkeypatch.setattr(
        contracts,
        "attach_key_counts",
        lambda df, counts, **options: original(df, counts, **{**options, "limit": limit}),
    )
    raw = _frame(spark, PAYMENT, [change for change, _ in PAYMENT_CASES])
    judged = contracts.apply_contract(raw, m.PAYMENT_CONTRACT).collect()
    assert Counter(row[contracts.REASON] for row in judged) == Counter(
        reason for _, reason in PAYMENT_CASES
    )
    split = contracts.apply_contract(raw, m.PAYMENT_CONTRACT)
    assert contracts.accepted(split).count() + contracts.rejected(split).count() == len(judged)
    assert contracts.REASON not in contracts.accepted(split).columns


@pytest.mark.parametrize("limit", [joins.BROADCAST_LIMIT_BYTES, -1])
def test_key_counts_match_a_plain_count(spark, limit):
    keys = ["hot"] * 500 + [None] * 300 + [f"k{i % 40}" for i in range(60)] + ["one"]
    df = spark.createDataFrame([(key, i) for i, key in enumerate(keys)], "k string, i int")
    counted = contracts.attach_key_counts(df.repartition(5), {"k": "n"}, limit=limit)
    expected = Counter(keys)
    rows = counted.collect()
    assert len(rows) == len(keys) and sorted(row["i"] for row in rows) == list(range(len(keys)))
    assert all(row["n"] == (expected[row["k"]] if row["k"] else None) for row in rows)


def test_strict_cast_raises(spark):
    stations = spark.createDataFrame([("1", "many")], "station_id string, capacity string")
    fields = [f for f in m.STATION_FIELDS if f.name in ("station_id", "capacity")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        contracts.conform(stations, fields).collect()


def test_filter_does_not_copy_the_parsing(spark):
    raw = _frame(spark, TRIP, [{}])
    plan = contracts.accepted(contracts.apply_contract(raw, m.TRIP_CONTRACT))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_cast(started_at") == 1
    assert "PythonUDF" not in text


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("c",)], "k string")
    assert contracts.duplicate_keys(df, "k").first()["duplicate_keys"] == 2
    assert contracts.rejection_reasons(
        df.withColumn(contracts.REASON, F.col("k"))
    ).count() == 3


def _join_inputs(node) -> list[str]:
    """The columns of the left side of each join of a plan."""
    found = [node.left().output().mkString(",")] if node.nodeName() == "Join" else []
    children = node.children()
    return found + [x for i in range(children.size()) for x in _join_inputs(children.apply(i))]


def test_reasons_alone_take_no_other_field_through_the_join_with_the_counts(spark, monkeypatch):
    """With a set of repeated keys too large to be broadcast; rules keep their order."""
    cases = [{}, {}, {"payment_id": "P2", "trip_id": "T1"}, {"payment_id": "P3", "trip_id": "T3", "total_amount": "9"}]
    cases += [{"payment_id": None}, {"payment_id": "P4", "trip_id": "T4", "fare_amount": "x"}]
    cases += [{"payment_id": "P1", "trip_id": "T5", "fare_amount": "x"}, {"payment_id": "P6", "trip_id": "T6"}]
    raw = _frame(spark, PAYMENT, cases)
    attach = contracts.attach_key_counts
    monkeypatch.setattr(contracts, "attach_key_counts", lambda *a, **k: attach(*a, **k, limit=0))
    judged = contracts.apply_contract(raw, m.PAYMENT_CONTRACT)
    assert judged.columns == raw.columns + [contracts.REASON]
    counts = {key: f"{key}_count" for key in m.PAYMENT_CONTRACT.unique_keys}
    typed = attach(contracts.conform(raw, m.PAYMENT_CONTRACT.fields), counts)
    plain = contracts.classify(typed, m.PAYMENT_CONTRACT, contracts.RuleContext(counts=counts)).drop(*counts.values())
    assert Counter(map(tuple, judged.collect())) == Counter(map(tuple, plain.collect()))
    reasons = judged.groupBy(contracts.REASON).agg(F.count("*").alias("rows"))
    joined = _join_inputs(reasons._jdf.queryExecution().optimizedPlan())
    assert joined and not any("amount" in columns for columns in joined)
