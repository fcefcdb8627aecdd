"""Raw CSV feeds as text, provenance columns and the readiness report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.bindings import mobility as m
from lakegate.operators import history


def text_schema(dataset: str) -> T.StructType:
    """Every raw column is text: inference costs a pass and drops leading zeros of ids."""
    return T.StructType([T.StructField(name, T.StringType()) for name in m.FEED_COLUMNS[dataset]])


def read_feed(spark: SparkSession, dataset: str, paths: list[str]) -> DataFrame:
    """Header CSV; columns are matched by position to the feed's schema."""
    return (
        spark.read.schema(text_schema(dataset))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(paths)
    )


def with_provenance(raw: DataFrame, run_id: str, source_file: Column) -> DataFrame:
    return raw.withColumns(
        {
            "loaded_at": F.current_timestamp(),
            "source_file": source_file,
            "source_run_id": F.lit(run_id),
        }
    )


def readiness(missing: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: ready only when nothing is missing and a run is published.

    ``missing`` is a subset of the short list of required relations.
    """
    names = missing.agg(F.array_sort(F.collect_list("relation_name")).alias("missing_tables"))
    pointer = history.latest_published(runs).select("run_id").scalar()
    ready = (F.size("missing_tables") == 0) & F.col("snapshot_run_id").isNotNull()
    return names.withColumn("snapshot_run_id", pointer).select(
        F.when(ready, "ready").otherwise("not_ready").alias("status"),
        F.array_join("missing_tables", ",").alias("missing_tables"),
        "snapshot_run_id",
    )
