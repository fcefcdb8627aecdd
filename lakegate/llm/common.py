"""What the operators share: input columns, staging, code shipping."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Mapping
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.sources.staging import stage

__all__ = ["content", "give_back", "partitions", "pick", "ship", "stage"]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names.

    Taking them first keeps extra columns, whatever they are called, out of the operator.
    """
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def content(column: str = "text") -> Column:
    """The text as UTF-8 bytes, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for operators that fix a number themselves."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def literal_map(values: Mapping[int, int], key: Column, kind: str = "bigint") -> Column:
    """Look a small driver-side mapping up in an expression (no join, no Python)."""
    pairs = [F.lit(x).cast(kind if i % 2 else "int") for kv in values.items() for i, x in enumerate(kv)]
    return F.element_at(F.create_map(*pairs), key.cast("int"))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that Python tasks can import it anywhere.

    Once per Spark application; where the package is installed on the workers it changes nothing.
    """
    context = spark.sparkContext
    if getattr(context, "_lakegate_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="lakegate-code-")) / "lakegate_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(str(archive))
    context._lakegate_shipped = True


def give_back() -> None:
    """Return what a Python task has freed to the system, as its worker stays for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
