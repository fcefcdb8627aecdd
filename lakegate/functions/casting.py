"""Safe and strict casts for raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark reads "1d" and "1.5f" as numbers (Java literal suffixes); a data feed must not.
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"
# Spark completes "2026" to a timestamp; a feed has to give the whole date.
_WHOLE_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def key_text(column: Column) -> Column:
    """Trimmed identifier, empty text as NULL."""
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def enum_text(column: Column) -> Column:
    """Trimmed lower-case code; empty text stays empty so that the enum rule rejects it."""
    return F.lower(F.trim(column.cast("string")))


def safe_number(column: Column, *, is_text: bool = True) -> Column:
    """Double or NULL. Infinities and NaN pass: finiteness is a contract rule."""
    parsed = column.try_cast("double")
    return F.when(~column.rlike(_JAVA_SUFFIX), parsed) if is_text else parsed


def safe_timestamp(column: Column, *, is_text: bool = True, whole_date: bool = True) -> Column:
    """Zone-free timestamp or NULL."""
    parsed = column.try_cast("timestamp_ntz")
    return F.when(column.rlike(_WHOLE_DATE), parsed) if is_text and whole_date else parsed


def is_finite(column: Column) -> Column:
    """False for NaN and both infinities, NULL for NULL."""
    return ~F.isnan(column) & (F.abs(column) < F.lit(float("inf")))
