"""Event time as epoch milliseconds and as TIMESTAMP."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_millis(ntz: Column) -> Column:
    """Milliseconds since the epoch of a zone-less timestamp, sub-millisecond digits cut off.

    Worked out from the difference of two zone-less timestamps: casts to TIMESTAMP and
    ``timestampdiff`` go through the session zone and move times inside its DST gaps.
    """
    since = ntz - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), since)

    whole = part("DAY").cast("bigint") * 86_400_000 + part("HOUR") * 3_600_000 + part("MINUTE") * 60_000
    return whole + F.floor(part("SECOND") * 1000).cast("bigint")


def event_time(millis: Column) -> Column:
    """TIMESTAMP of epoch milliseconds: what ``window`` and ``withWatermark`` work on."""
    return F.timestamp_millis(millis)
