"""Time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_millis(started: Column, ended: Column) -> Column:
    """Whole milliseconds between two zone-free timestamps.

    Taken from the day-time interval itself, so no session time zone (and no
    daylight-saving gap) is involved.
    """
    gap = ended - started
    return (
        F.extract(F.lit("DAY"), gap) * F.lit(86_400_000).cast("bigint")
        + F.extract(F.lit("HOUR"), gap) * F.lit(3_600_000)
        + F.extract(F.lit("MINUTE"), gap) * F.lit(60_000)
        + F.floor(F.extract(F.lit("SECOND"), gap) * F.lit(1000)).cast("bigint")
    )


def elapsed_seconds(started: Column, ended: Column) -> Column:
    """Elapsed seconds, rounded half up."""
    return F.floor(elapsed_millis(started, ended) / F.lit(1000.0) + F.lit(0.5))
