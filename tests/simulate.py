"""Record-at-a-time windowing, one record after the other: what replay has to agree with."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from moodtide.operators.windows import Hop


class Record(NamedTuple):
    partition: int
    offset: int
    user_id: str | None
    timestamp: int
    score: float


def window_starts(timestamp: int, hop: Hop) -> list[int]:
    last = timestamp - timestamp % hop.advance_ms
    return [s for s in range(last, timestamp - hop.size_ms, -hop.advance_ms) if s >= 0]


def simulate(records: Iterable[Record], hop: Hop):
    """(kept pairs, late pairs, updates with seq 0 and 1)."""
    kept, late, updates = [], [], []
    stream_time: dict[int, int] = {}
    sums: dict[tuple, float] = {}
    counts: dict[tuple, int] = {}
    for r in sorted(records, key=lambda r: (r.partition, r.offset)):
        if r.user_id is None:
            continue
        now = stream_time[r.partition] = max(stream_time.get(r.partition, r.timestamp), r.timestamp)
        for start in window_starts(r.timestamp, hop):
            pair = (r.partition, r.offset, r.user_id, start)
            if start + hop.size_ms + hop.grace_ms <= now:
                late.append((*pair, now))
                continue
            kept.append(pair)
            group = (r.user_id, start)
            # The sum is updated first and meets the count of before, then the count follows.
            sums[group] = sums.get(group, 0.0) + r.score
            if group in counts:
                updates.append((*group, r.offset, 0, counts[group], round(sums[group] / counts[group], 6)))
            counts[group] = counts.get(group, 0) + 1
            updates.append((*group, r.offset, 1, counts[group], round(sums[group] / counts[group], 6)))
    return kept, late, updates
