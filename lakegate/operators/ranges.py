"""Running aggregates in a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.operators.joins import tasks
from lakegate.sources.staging import stage

_RANGE = "__range"

Combine = Callable[[Column, Column], Column]


def add(one: Column, other: Column) -> Column:
    return F.coalesce(one, F.lit(0)) + F.coalesce(other, F.lit(0))


def exclusive_scan(
    df: DataFrame,
    order: str,
    value: Column,
    output: str,
    *,
    function: Callable[[str], Column] = F.max,
    combine: Combine = F.greatest,
) -> DataFrame:
    """Add ``output``: the aggregate of ``value`` over all rows before this one by ``order``.

    Order keys must be unique. Rows are dealt in ranges of the order key, about equally many in
    each, and staged with the number of their range, so that it stays the same for both readers:
    one aggregates inside the ranges, the other makes one carry per range (as many rows as a
    shuffle has tasks), which is aggregated over the ranges and added back. NULL keys come first.
    """
    ranged = df.withColumn("__value", value).repartitionByRange(tasks(df), order)
    staged = stage(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    inside = function("__value").over(
        Window.partitionBy(_RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    carries = staged.groupBy(_RANGE).agg(function("__value").alias("__carry"))
    before = carries.select(
        F.col(_RANGE).alias("__of_range"),
        function("__carry")
        .over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
        .alias("__before"),
    )
    return (
        staged.withColumn("__inside", inside)
        .join(F.broadcast(before), F.col(_RANGE) == F.col("__of_range"))
        .withColumn(output, combine(F.col("__inside"), F.col("__before")))
        .drop(_RANGE, "__of_range", "__value", "__inside", "__before")
    )


def positions(df: DataFrame, order: str, output: str) -> DataFrame:
    """Add the 0-based position in the order of a unique key."""
    return exclusive_scan(
        df, order, F.lit(1).cast("bigint"), output, function=F.sum, combine=add
    )
