"""The open chunk of one topic partition, fed with batches of message sizes.

This is the small helper that runs inside Spark tasks. It sees offsets, sizes
and arrival times only, never payloads, and one Arrow batch at a time, so its
memory does not depend on how long a partition is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from logstow.model import ChunkRule


class MessageOrderError(ValueError):
    """Offsets of a topic partition repeat or go back."""


@dataclass
class OpenChunk:
    """start and end offset, messages and bytes so far, and the commit timer.

    last_commit: time of the last commit, or of the last timer tick.
    clock: latest arrival seen; a message never arrives before its predecessor.
    """

    start: int
    end: int
    count: int = 0
    size: int = 0
    last_commit: int = 0
    clock: int = 0

    @classmethod
    def at(cls, offset: int, rule: ChunkRule) -> OpenChunk:
        return cls(offset, offset, 0, 0, rule.run_start_ms, rule.run_start_ms)

    def is_empty(self) -> bool:
        return self.start == self.end

    def close(self, reason: str) -> tuple[int, int, int, int, str]:
        row = (self.start, self.end, self.count, self.size, reason)
        self.start, self.count, self.size = self.end, 0, 0
        return row


def check_offsets(offsets: np.ndarray, before: int) -> None:
    if len(offsets) and (offsets[0] <= before or np.any(np.diff(offsets) <= 0)):
        raise MessageOrderError(
            f"offsets must be unique and lie above {before}, got "
            f"{offsets[0]}..{offsets[-1]}"
        )


def ticks_before(time, last_commit, interval):
    """Move the commit time on by whole intervals to the last tick before `time`."""
    return last_commit + (time - last_commit - 1) // interval * interval


def running_clock(arrivals, n: int, before: int) -> np.ndarray:
    """Arrival times made monotone; constant where arrivals are not looked at."""
    if arrivals is None:
        return np.full(n, before, dtype=np.int64)
    return np.maximum.accumulate(np.maximum(arrivals, before))


def feed(chunk: OpenChunk, offsets, sizes, arrivals, rule: ChunkRule):
    """Append a batch to the chunk; returns rows for the chunks it closes."""
    check_offsets(offsets, chunk.end)
    n = len(offsets)
    total = np.cumsum(sizes, dtype=np.int64)
    clock = running_clock(arrivals, n, chunk.clock)
    closed = []
    first, base = 0, -chunk.size
    while first < n:
        over = timer = n
        if rule.max_bytes is not None:
            over = int(np.searchsorted(total, base + rule.max_bytes, side="right"))
        if rule.interval_ms is not None:
            deadline = chunk.last_commit + rule.interval_ms
            timer = int(np.searchsorted(clock, deadline, side="right"))
        if min(over, timer) >= n:
            break
        # The timer fires before the message is appended, a full chunk closes after.
        last = timer if timer <= over else over + 1
        if last > first:
            chunk.end = int(offsets[last - 1])
            chunk.count += last - first
            chunk.size = int(total[last - 1]) - base
            base = int(total[last - 1])
        elif last == 0:
            base = 0
        if timer <= over:
            if not chunk.is_empty():
                closed.append(chunk.close("interval"))
            chunk.count = chunk.size = 0
            chunk.last_commit = int(
                ticks_before(clock[timer], chunk.last_commit, rule.interval_ms)
            )
        else:
            closed.append(chunk.close("size"))
            chunk.last_commit = int(clock[over])
        first = last
    if n:
        if n > first:
            chunk.end = int(offsets[-1])
            chunk.count += n - first
            chunk.size = int(total[-1]) - base
        chunk.clock = int(clock[-1])
    return closed


def timer_due(chunk: OpenChunk, rule: ChunkRule) -> bool:
    return (
        rule.interval_ms is not None
        and rule.now_ms is not None
        and rule.now_ms - chunk.last_commit > rule.interval_ms
    )


def finish(chunk: OpenChunk, rule: ChunkRule):
    """Row for what is left at the end of a partition, if anything is."""
    if chunk.is_empty():
        return []
    return [chunk.close("interval" if timer_due(chunk, rule) else "open")]
