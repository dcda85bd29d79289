"""Records that a source delivers more than once (S1, S2, S5: at-least-once).

A topic's record is named by its partition and offset, so a second delivery is told from a second record with
the same content, whichever file or micro-batch it comes in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD = ("partition", "offset")


def once(records: DataFrame, delay: str, keys: Sequence[str] = RECORD, time_col: str = "event_time") -> DataFrame:
    """Each record once; those without a name all stay.

    Batch: one shuffle by record name, map-side first. Streams: a record's name is remembered until the watermark,
    ``delay`` behind the latest event time, has passed its time by ``delay``; a repeat that comes later than that is
    late for every window with no more grace, and dropped as such. So state is bounded by time, not by the
    topic's length. The result carries this watermark: aggregate it as it is, without another one.
    """
    if records.isStreaming:
        return records.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))
    # Nulls are equal to each other there, and would stand for one record.
    named = " AND ".join(f"`{key}` IS NOT NULL" for key in keys)
    unnamed = records.filter(~F.expr(named))
    return records.filter(named).dropDuplicates(list(keys)).unionByName(unnamed)
