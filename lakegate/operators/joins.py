"""Left joins that stay balanced: size-checked broadcast, otherwise keys split by their weight."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.sources.staging import content_size

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: What ``freqItems`` accepts.
_LEAST_SUPPORT = 1e-4
#: Parts a task gets on average of a key that holds all rows; they fall on tasks by hash, and more
#: of them lie more evenly.
PARTS_PER_TASK = 4
ROW_ID = "__row_id"


def with_row_id(df: DataFrame) -> DataFrame:
    """Row number used only to spread rows of hot keys.

    Add it before the first shuffle: over a file scan it is the same on a retried task.
    Hashing the row instead would keep exact copies together.
    """
    return df if ROW_ID in df.columns else df.withColumn(ROW_ID, F.monotonically_increasing_id())


def content_bytes(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Measured size of each frame, in one job."""
    parts = [
        df.agg(content_size(df).alias("bytes")).select(F.lit(name).alias("name"), "bytes")
        for name, df in frames.items()
    ]
    rows = reduce(DataFrame.unionAll, parts).collect()  # one row per frame
    return {row["name"]: row["bytes"] for row in rows}


def tasks(df: DataFrame) -> int:
    """Tasks of a shuffle in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def parts_of(n: Column, rows: Column, tasks: int) -> Column:
    """Into how many parts a key with ``n`` of all ``rows`` is dealt."""
    return F.greatest(F.ceil(n * F.lit(float(PARTS_PER_TASK * tasks)) / rows), F.lit(1)).cast("int")


def key_splits(df: DataFrame, column: str | Column, rows: DataFrame | None = None) -> DataFrame:
    """(``__split_key``, ``__parts``) of the keys too heavy for one task, by their exact counts.

    A key is heavy if it has more than a quarter of what a task gets on average, so there are at
    most four times as many as tasks, whatever the data; all others, and NULL, have no row here. Candidates
    come from one pass without a shuffle (frequent items, which misses no heavy key), and only
    they are counted, with partial sums. The exact counts decide, so the table is the same
    whenever it is computed. ``rows`` may give a frame that counts the rows more cheaply.
    """
    keys = df.select((F.col(column) if isinstance(column, str) else column).alias("__key"))
    dealt = tasks(df)
    support = max(_LEAST_SUPPORT, min(1.0, 1 / (PARTS_PER_TASK * dealt)))
    candidates = keys.freqItems(["__key"], support).select(
        F.explode("__key_freqItems").alias("__split_key")
    )
    counted = keys.join(F.broadcast(candidates), F.col("__key") == F.col("__split_key"))
    total = (keys if rows is None else rows).agg(F.count(F.lit(1))).scalar()
    weighed = counted.groupBy("__split_key").agg(F.count(F.lit(1)).alias("__n"))
    return splits_from_counts(weighed, "__split_key", "__n", total, dealt)


def splits_from_counts(
    counts: DataFrame, key: str, n: str, rows: Column, dealt: int
) -> DataFrame:
    """The same table from key counts that are there already."""
    return counts.select(
        F.col(key).alias("__split_key"), parts_of(F.col(n), rows, dealt).alias("__parts")
    ).where(F.col("__parts") > 1)


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    splits: DataFrame | None = None,
) -> DataFrame:
    """Left equi-join in which heavy left keys are dealt in parts, and NULL keys over all tasks.

    ``splits`` is :func:`key_splits` of the left side; both sides look the number of parts up in
    it (it has at most four rows a task, so it is broadcast). Only right rows of heavy keys are
    replicated, once per part, so every left row still meets each of its right rows exactly once.
    The left frame must carry :data:`ROW_ID`.
    """
    key = F.col(left_key)
    parts = F.lit(1)
    if splits is not None:
        parts = F.coalesce("__parts", F.lit(1))
        left = left.join(F.broadcast(splits), key == F.col("__split_key"), "left")
        right = right.join(
            F.broadcast(splits), F.col(right_key) == F.col("__split_key"), "left"
        ).drop("__split_key")
    dealt = F.when(key.isNull(), F.lit(PARTS_PER_TASK * tasks(left))).otherwise(parts)
    salted = left.withColumn("__salt", F.pmod(F.col(ROW_ID), dealt).cast("int"))
    if splits is not None:
        salted = salted.drop("__split_key", "__parts")
        right = right.withColumn("__right_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
        right = right.drop("__parts")
    else:
        right = right.withColumn("__right_salt", F.lit(0))
    on = (key == F.col(right_key)) & (F.col("__salt") == F.col("__right_salt"))
    return salted.join(right, on, "left").drop("__salt", "__right_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    right_bytes: int,
    splits: DataFrame | None = None,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Broadcast the right side only when its measured size is below ``limit``."""
    if right_bytes <= limit:
        return left.join(F.broadcast(right), F.col(left_key) == F.col(right_key), "left")
    return salted_left_join(left, right, left_key, right_key, splits)
