"""Lineage edges as a relation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m
from lakegate.sources.staging import literal_rows

_SCHEMA = pa.schema(
    [(name, pa.string()) for name in ("source_node", "target_node", "transform_type")]
)


def lineage_edges(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, _SCHEMA, m.LINEAGE_EDGES)


def with_row_counts(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """Edges with the size of both ends, where an end is a counted relation."""
    result = edges
    for side in ("source", "target"):
        sized = counts.select(
            F.col("relation_name").alias("__relation"), F.col("row_count").alias(f"{side}_rows")
        )
        result = result.join(
            sized, F.col(f"{side}_node") == F.col("__relation"), "left"
        ).drop("__relation")
    return result
