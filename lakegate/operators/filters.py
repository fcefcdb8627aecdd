"""Optional, validated conjunctive filter over the enriched fact."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m


@dataclass(frozen=True)
class FactFilter:
    """Every bound is optional; date bounds are inclusive. Validated before a job is planned."""

    start_date: date | None = None
    end_date: date | None = None
    zone_id: str | None = None
    rider_type: str | None = None

    def __post_init__(self) -> None:
        if self.start_date and self.end_date and self.start_date > self.end_date:
            raise ValueError("start_date must be on or before end_date.")
        if self.zone_id is not None and not re.fullmatch(m.ZONE_PATTERN, self.zone_id):
            raise ValueError(f"zone_id must match {m.ZONE_PATTERN}")
        if self.rider_type is not None and self.rider_type not in m.RIDER_TYPES:
            raise ValueError(f"rider_type must be one of {', '.join(m.RIDER_TYPES)}")

    def apply(self, enriched: DataFrame) -> DataFrame:
        """Bounds on ``trip_date`` prune partitions of the stored fact."""
        result = enriched
        if self.start_date:
            result = result.where(F.col("trip_date") >= F.lit(self.start_date))
        if self.end_date:
            result = result.where(F.col("trip_date") <= F.lit(self.end_date))
        if self.zone_id:
            result = result.where(F.col("start_zone_id") == self.zone_id)
        if self.rider_type:
            result = result.where(F.col("rider_type") == self.rider_type)
        return result
