"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar
from uuid import uuid4

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Result = TypeVar("Result")

#: Spark deletes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for recoverable intermediate data.

    If it is unset, a session in one process gets a temporary one; a cluster is refused, as its
    executors would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lakegate-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of any executor.

    The written table stands for the shuffles that made it, so their files go at once and not
    when the driver's next garbage collection comes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lakegate-stage/{label}-{uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Stage a frame and return the size of its values, observed by the same write.

    A retried task may be counted twice, so the size is an upper bound.
    """
    size = Observation()
    staged = stage(df.observe(size, content_size(df).alias("bytes")), label)
    return staged, size.get["bytes"]


def content_size(df: DataFrame) -> Column:
    """Aggregate over a frame's rows: text by its length, any other value as 8 bytes."""
    width = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return F.coalesce(F.sum(width), F.lit(0))


def together(jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Start independent Spark jobs at once, so that one's last tasks leave no idle cores."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        started = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in started.items()}


def literal_rows(spark: SparkSession, schema: pa.Schema, rows: Sequence[tuple]) -> DataFrame:
    """A small configuration relation (rules, specs, one run row) as a local relation."""
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [
        pa.array(list(values), type=field.type)
        for values, field in zip(columns, schema, strict=True)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))
