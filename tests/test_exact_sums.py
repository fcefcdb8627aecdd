from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakegate.functions import numeric
from lakegate.functions.numeric import Measure


def _nearest(values: list[float]) -> float:
    total = sum(map(Fraction, values), Fraction(0))
    return float(total)


def _random(rng: random.Random, low: int, high: int) -> float:
    return math.ldexp(rng.random() + 1, rng.randint(low, high - 1)) * rng.choice((1, -1))


def _sums(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
    measures = [
        Measure("s", "sum", F.col("v")),
        Measure("m", "mean", F.col("v")),
        Measure("n", "rows"),
        Measure("up", "share", F.col("v") > 0),
        Measure("least", "min", F.col("v")),
        Measure("most", "max", F.col("v")),
    ]
    found = numeric.exact_aggregate(df, {"k": "k"}, measures).collect()
    return {r["k"]: r for r in found}


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_sums_are_the_nearest_double_of_the_exact_sum(spark, parts):
    rng = random.Random(3)
    groups = {
        0: [0.1, 0.2, 0.3, -0.6, 1e-7] * 40,
        1: [_random(rng, -28, 24) for _ in range(300)],
        2: [round(rng.uniform(-1e6, 1e6), 2) for _ in range(300)] + [0.0, -0.0],
        3: [1e300, 1.0, -1e300, 1e-15, 2.0**24, 2.0**-28],
        4: [5e-324] * 9 + [-5e-324],
        5: [1.7976931348623157e308, -1.7976931348623157e308, 3.5],
        6: [2.0**23 + 0.5] * 250 + [2.0**-27],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [(7, None), (1, None)]
    got = _sums(spark, rows, parts)
    for k in (0, 1, 2, 4, 5, 6):
        assert got[k]["s"] == _nearest(groups[k]), k
        assert got[k]["m"] == _nearest(groups[k]) / len(groups[k])
    # Three classes: 1e300 and its opposite cancel exactly, the rest is 2**24 + 1 and what rounds away.
    assert got[3]["s"] == _nearest(groups[3])
    assert got[7]["s"] is None and got[7]["m"] is None and got[7]["n"] == 1
    assert got[1]["n"] == 301 and got[1]["least"] == min(groups[1]) and got[1]["most"] == max(groups[1])
    assert got[2]["up"] == sum(v > 0 for v in groups[2]) / len(groups[2])


@pytest.mark.parametrize("parts", [1, 7])
def test_infinities_and_nan(spark, parts):
    inf = math.inf
    rows = [(0, inf), (0, 1.0), (1, -inf), (1, 1e300), (2, inf), (2, -inf), (3, math.nan), (3, 2.0)]
    got = _sums(spark, rows, parts)
    assert (got[0]["s"], got[1]["s"]) == (inf, -inf)
    assert math.isnan(got[2]["s"]) and math.isnan(got[3]["s"])


def test_every_binary_exponent_is_kept(spark):
    values = [math.ldexp(1 + 2.0**-52, e) for e in range(-1021, 1023, 7)] + [math.ldexp(1, e) for e in range(-1074, 1023, 13)]
    rows = [(i, v) for i, v in enumerate(values)]
    got = _sums(spark, rows, 3)
    assert all(got[i]["s"] == v for i, v in rows)


def test_one_row_without_keys_for_an_empty_frame(spark):
    empty = spark.createDataFrame([], "v double")
    got = numeric.exact_aggregate(empty, {}, [Measure("s", "sum", F.col("v")), Measure("n", "rows")]).collect()
    assert [tuple(r) for r in got] == [(None, 0)]
