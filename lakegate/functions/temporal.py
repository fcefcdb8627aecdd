"""Time arithmetic on zone-free timestamps; nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_start(column: Column) -> Column:
    """Start of the hour. ``date_trunc`` would detour over the session zone and its DST gaps."""
    inside = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(column), F.extract(F.lit("SECOND"), column)
    )
    return column - inside


def plus_seconds(column: Column, seconds: Column) -> Column:
    return column + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def epoch_millis(column: Column) -> Column:
    """Whole milliseconds since 1970, rounded down."""
    in_minute = F.floor(F.extract(F.lit("SECOND"), column) * 1000).cast("bigint")
    return (
        F.unix_date(column.cast("date")).cast("bigint") * 86_400_000
        + F.hour(column) * 3_600_000
        + F.minute(column) * 60_000
        + in_minute
    )


def runtime_seconds(started: Column, ended: Column) -> Column:
    """Seconds between two instants, counted in millisecond boundaries."""
    return (epoch_millis(ended) - epoch_millis(started)) / F.lit(1000.0)


def iso_text(column: Column) -> Column:
    """ISO 8601 text: ``T`` separator, six fraction digits only when there is a fraction."""
    text = F.replace(column.cast("string"), F.lit(" "), F.lit("T"))
    padded = F.concat(
        F.substring_index(text, ".", 1),
        F.lit("."),
        F.rpad(F.substring_index(text, ".", -1), 6, "0"),
    )
    return F.when(F.contains(text, F.lit(".")), padded).otherwise(text)
