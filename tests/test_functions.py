from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakegate.functions import casting, numeric, temporal


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scaled_round(spark):
    cases = {1.005: 1.0, 2.675: 2.68, -1.125: -1.13, 0.125: 0.13, 1e15: 1e15}
    for value, expected in cases.items():
        assert _one(spark, numeric.scaled_round(F.lit(value), 2)) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_does_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_ntz'2024-03-10 02:30:15.25' a, timestamp_ntz'2024-03-10 03:00:00.0011' b,"
            "timestamp_ntz'2024-03-10 03:00:00.0009' c"
        )
        row = df.select(
            temporal.hour_start(F.col("a")).cast("string").alias("hour"),
            temporal.runtime_seconds(F.col("a"), F.col("b")).alias("seconds"),
            temporal.runtime_seconds(F.col("c"), F.col("b")).alias("tick"),
            temporal.iso_text(F.col("a")).alias("iso"),
            temporal.iso_text(F.col("a").cast("date")).alias("day"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["hour"] == "2024-03-10 02:00:00"
    assert row["seconds"] == 1784.751
    assert row["tick"] == 0.001  # millisecond boundaries, not whole milliseconds
    assert (row["iso"], row["day"]) == ("2024-03-10T02:30:15.250000", "2024-03-10")


def test_numbers_from_text(spark):
    texts = {"1d": None, "1.5f": None, "inf": float("inf"), "1e5": 1e5, " 2 ": 2.0, "": None}
    for text, expected in texts.items():
        assert _one(spark, casting.safe_number(F.lit(text))) == expected
    assert _one(spark, casting.is_finite(F.lit(float("nan")))) is False
