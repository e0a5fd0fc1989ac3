"""Chunk planning for partitions too long for one task.

A hot partition is cut into slices by offset. Offsets are unique, so a slice
is bounded however skewed the topics are. What one slice hands to the next is
the state of the open chunk: its start, its bytes, and the commit timer.

1. Every slice is summarised without knowing the state it will be entered
   with. The first chunk to close in a slice must close within the first
   `max_bytes` of it, at some message m; from m on everything is determined.
   So the slice is folded once for all such m together, and the summary lists,
   for each m, the state the slice is left with.
2. The summaries of neighbouring slices are combined into one for the group,
   so that no task has to read all summaries of a partition.
3. The real state is followed over the groups, and then over the slices within
   all groups at once. A summary cannot tell what happens where the timer is
   due before the first chunk is full, unless it still runs from the start of
   the run. Such a slice is folded with its real state, and the pass goes on
   behind it. If the next slice is another one, the rest of its group is
   summarised once more for the timer as it runs now.
4. Now that every slice's entry state is known, all slices are folded in
   parallel, and the pieces of chunks that span slices are added up.

The driver holds one small row per slice, never messages or chunks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstow.model import ChunkRule, Slicing
from logstow.operators.chunking import (
    CLOSED_ARROW,
    CLOSED_SQL,
    arrow_rows,
    key_runs,
    long_column,
    part_of,
    sizes_and_arrivals,
)
from logstow.operators.open_chunk import OpenChunk, feed, finish, running_clock, ticks_before
from logstow.shared_dir import shared_dir

FAR = 2**61
# A slice is named by one number: its partition's times this, plus its own.
SLICES = 2**32


@dataclass(frozen=True)
class HotPartition:
    start_offset: int
    first_offset: int
    slice_width: int


@dataclass(frozen=True)
class SliceStats:
    """Facts about a slice, or a group of them, however it is entered.

    first_clock: latest arrival in the (first) slice.
    bytes: None for a group under a size limit, whose summary only covers chunks
        that close in its first slice. Without one, a group's facts are those of
        all its slices, `first_clock` too.
    """

    slice: int
    bytes: int | None
    last_offset: int
    first_clock: int
    last_clock: int
    previous_offset: int
    previous_clock: int


def measure_hot_partitions(
    sizes: DataFrame,
    counts: dict[int, int],
    starts: dict[int, int],
    rule: ChunkRule,
    slicing: Slicing,
) -> dict[int, HotPartition]:
    """Offset ranges and slice widths of the partitions."""
    measured = sizes.groupBy("id").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.sum("size").alias("bytes")
    )
    hot = {}
    for r in measured.collect():
        rows = slicing.rows
        if rule.max_bytes is not None and r.bytes > 0:
            rows = max(rows, slicing.chunks * rule.max_bytes * counts[r.id] // r.bytes)
        width = max(1, (r.high - r.low + 1) * rows // counts[r.id])
        hot[r.id] = HotPartition(starts[r.id], r.low, width)
    return hot


def _write_slices(
    sizes: DataFrame, hot: dict[int, HotPartition], rule: ChunkRule, path: str
) -> DataFrame:
    """Sizes with their slice, written sorted so that single slices are found fast."""
    spark = sizes.sparkSession
    table = spark.createDataFrame(
        [(i, h.first_offset, h.slice_width) for i, h in hot.items()],
        "id int, low long, width long",
    )
    named = sizes.join(F.broadcast(table), "id").select(
        F.expr(f"id * {SLICES} + (offset - low) div width").alias("slice_id"),
        "offset",
        "size",
        *(["arrival_ms"] if rule.interval_ms is not None else []),
    )
    _per_slice(named).write.parquet(path)
    return spark.read.schema(named.schema).parquet(path)


def _slice_stats(
    slices: DataFrame, hot: dict[int, HotPartition], rule: ChunkRule
) -> dict[int, list[SliceStats]]:
    arrival = F.max("arrival_ms") if rule.interval_ms is not None else F.lit(rule.run_start_ms)
    rows = (
        slices.groupBy("slice_id")
        .agg(F.sum("size").alias("b"), F.max("offset").alias("o"), arrival.alias("t"))
        .collect()
    )
    stats = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.slice_id):
        hot_id, slice_no = divmod(r.slice_id, SLICES)
        before = stats[hot_id][-1] if stats[hot_id] else None
        offset = before.last_offset if before else hot[hot_id].start_offset
        clock = before.last_clock if before else rule.run_start_ms
        latest = max(r.t, clock)
        stats[hot_id].append(SliceStats(slice_no, r.b, r.o, latest, latest, offset, clock))
    return dict(stats)


def _per_slice(slices: DataFrame) -> DataFrame:
    return slices.repartition("slice_id").sortWithinPartitions("slice_id", "offset")


def _slice_runs(batches: Iterator[pa.RecordBatch], rule: ChunkRule):
    """(hot_id, slice), offsets, sizes, arrivals of each stretch, in order."""
    for batch in batches:
        offsets = long_column(batch, "offset")
        sizes, arrivals = sizes_and_arrivals(batch, rule)
        for (slice_id,), i, j in key_runs(batch, ["slice_id"]):
            yield divmod(slice_id, SLICES), offsets[i:j], sizes[i:j], part_of(arrivals, i, j)


# --- step 1: summaries -------------------------------------------------------

SUMMARY_SCHEMA = (
    "hot_id int, slice long, total long, clock long, "
    "exit_start long, exit_size long, exit_commit long"
)
SUMMARY_ARROW = pa.schema(
    [("hot_id", pa.int32())]
    + [
        (name, pa.int64())
        for name in ("slice", "total", "clock", "exit_start", "exit_size", "exit_commit")
    ]
)
TIMER_ROW = -1
# Messages that are folded at a time, or as many as there are candidates if that is
# more. Every fold looks at all candidates, so this keeps the work in proportion.
FOLDED_AT_ONCE = 1 << 18


class SliceSummary:
    """Folds a slice for all messages at which its first chunk may close.

    Arrays hold one entry per candidate: where it closed (`total` bytes into
    the slice, at `clock`), and the open chunk it has led to so far: `base`,
    the bytes of the slice before it, `start` and `commit`. The first entry is
    for the timer running undisturbed since the start of the run.
    """

    def __init__(self, stats: SliceStats, rule: ChunkRule, anchor: int | None = None):
        """anchor: summarise only for the timer, running from this commit time."""
        # Without a size limit no chunk is closed by a message of its own.
        self.timer_only = anchor is not None or rule.max_bytes is None
        self.limit = FAR if rule.max_bytes is None else min(rule.max_bytes, FAR)
        self.interval = FAR if rule.interval_ms is None else rule.interval_ms
        tick = rule.run_start_ms if anchor is None else anchor
        if stats.previous_clock > tick:
            tick = ticks_before(stats.previous_clock, tick, self.interval)
        self.total = np.array([TIMER_ROW])
        self.clock = np.array([tick])
        self.base = np.array([FAR])
        self.start = np.array([stats.previous_offset])
        self.commit = np.array([tick])
        self.seen = 0
        self.last_clock = stats.previous_clock
        self.last_offset = stats.previous_offset
        self.waiting: list[tuple] = []
        self.waiting_rows = 0

    def feed(self, offsets, sizes, arrivals) -> None:
        """Take messages in order; they are folded when enough have come together."""
        self.waiting.append((offsets, sizes, arrivals))
        self.waiting_rows += len(offsets)
        if self.waiting_rows >= max(FOLDED_AT_ONCE, len(self.total)):
            self.fold()

    def fold(self) -> None:
        """Fold what is waiting. To be called before any array is looked at."""
        if not self.waiting_rows:
            return
        offsets, sizes, arrivals = (
            None if parts[0] is None else np.concatenate(parts)
            for parts in zip(*self.waiting, strict=True)
        )
        self.waiting, self.waiting_rows = [], 0
        self._fold(offsets, sizes, arrivals)

    def _fold(self, offsets, sizes, arrivals) -> None:
        total = self.seen + np.cumsum(sizes, dtype=np.int64)
        clock = running_clock(arrivals, len(total), self.last_clock)
        if self.seen <= self.limit and not self.timer_only:
            new = np.flatnonzero((sizes > 0) & (total - sizes <= self.limit))
            self.total = np.concatenate([self.total, total[new]])
            self.clock = np.concatenate([self.clock, clock[new]])
            self.base = np.concatenate([self.base, total[new]])
            self.start = np.concatenate([self.start, offsets[new]])
            self.commit = np.concatenate([self.commit, clock[new]])
        self._advance(offsets, total, clock)
        self.seen = int(total[-1])
        self.last_clock = int(clock[-1])
        self.last_offset = int(offsets[-1])

    def _advance(self, offsets, total, clock) -> None:
        n = len(total)
        moving = np.flatnonzero(
            (self.base + self.limit < total[-1]) | (self.commit + self.interval < clock[-1])
        )
        while len(moving):
            over = np.searchsorted(total, self.base[moving] + self.limit, side="right")
            timer = np.searchsorted(clock, self.commit[moving] + self.interval, side="right")
            here = np.minimum(over, timer) < n
            moving, over, timer = moving[here], over[here], timer[here]
            by_timer = timer <= over

            full, at = moving[~by_timer], over[~by_timer]
            self.base[full] = total[at]
            self.start[full] = offsets[at]
            self.commit[full] = clock[at]

            late, at = moving[by_timer], timer[by_timer]
            before = np.maximum(at - 1, 0)
            self.base[late] = np.where(at > 0, total[before], self.seen)
            self.start[late] = np.where(at > 0, offsets[before], self.last_offset)
            self.commit[late] = ticks_before(clock[at], self.commit[late], self.interval)

    def rows(self, key) -> pa.RecordBatch:
        self.fold()
        n = len(self.total)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, key[0], dtype=np.int32)),
                pa.array(np.full(n, key[1], dtype=np.int64)),
                pa.array(self.total),
                pa.array(self.clock),
                pa.array(self.start),
                pa.array(self.seen - self.base),
                pa.array(self.commit),
            ],
            schema=SUMMARY_ARROW,
        )


def _summarise(
    stats: dict[tuple[int, int], SliceStats],
    rule: ChunkRule,
    anchors: dict[tuple[int, int], int] | None = None,
):
    anchors = anchors or {}

    def run(batches):
        key, summary = None, None
        for run_key, offsets, sizes, arrivals in _slice_runs(batches, rule):
            if run_key != key:
                if summary is not None:
                    yield summary.rows(key)
                key, summary = run_key, SliceSummary(stats[run_key], rule, anchors.get(run_key))
            summary.feed(offsets, sizes, arrivals)
        if summary is not None:
            yield summary.rows(key)

    return run


# --- steps 2 and 3: follow the real state ------------------------------------
#
# A line is a run of units that are passed one after the other: the groups of a
# hot partition, or the slices of a group. Both are summarised in the same
# form, keyed by (hot_id, line, unit).

UNIT_KEY = ["hot_id", "line", "unit"]
STATE_COLUMNS = ["start", "end", "size", "last_commit", "clock"]
STATE_SCHEMA = "hot_id int, line long, unit long, " + ", ".join(
    f"{c} long" for c in STATE_COLUMNS
)
STATE_ARROW = pa.schema(
    [("hot_id", pa.int32())] + [(c, pa.int64()) for c in ["line", "unit", *STATE_COLUMNS]]
)
UNIT_SUMMARY_SCHEMA = SUMMARY_SCHEMA.replace("slice long", "line long, unit long")
UNIT_SUMMARY_ARROW = pa.schema(
    [("hot_id", pa.int32()), ("line", pa.int64()), ("unit", pa.int64()), *list(SUMMARY_ARROW)[2:]]
)
# In a group's summary: not known. As a unit: behind the last one.
UNKNOWN = -1
LINE_END = -1

Line = tuple[int, int]
Unit = tuple[int, int, int]


def _state_row(unit: Unit, c: OpenChunk) -> tuple:
    return (*unit, c.start, c.end, c.size, c.last_commit, c.clock)


def _state_of(row) -> OpenChunk:
    return OpenChunk(row.start, row.end, 0, row.size, row.last_commit, row.clock)


def pass_unit(start, size, commit, stats: SliceStats, summary, rule: ChunkRule):
    """Open chunks after a unit, for arrays of open chunks before it.

    summary: the unit's summary rows as arrays, sorted by `total`. The last
    result tells which of the others are known.
    """
    limit = FAR if rule.max_bytes is None else min(rule.max_bytes, FAR)
    deadline = commit + (FAR if rule.interval_ms is None else rule.interval_ms)
    total, clock = summary["total"], summary["clock"]
    at = np.searchsorted(total, limit - size, side="right")
    listed = at < len(total)
    at = np.where(listed, at, 0)
    in_time = np.where(listed, clock[at], stats.first_clock) <= deadline
    at = np.where(in_time, at, 0)
    none_closed = in_time & ~listed
    by_timer = np.zeros(len(commit), dtype=bool)
    for row in range(int(np.searchsorted(total, 0))):
        same = ~in_time & ~by_timer & (clock[row] == commit)
        at = np.where(same, row, at)
        by_timer |= same
    known = (by_timer | (in_time & listed)) & (summary["exit_size"][at] >= 0)
    if stats.bytes is not None:
        known |= none_closed
    return (
        np.where(none_closed, start, summary["exit_start"][at]),
        np.where(none_closed, size + (stats.bytes or 0), summary["exit_size"][at]),
        np.where(none_closed, commit, summary["exit_commit"][at]),
        known,
    )


def _unit_summaries(batches: Iterator[pa.RecordBatch]):
    """(hot_id, line, unit) and the summary columns of each unit, in order."""
    key, parts = None, []

    def columns():
        table = pa.Table.from_batches(parts)
        return {c: table.column(c).to_numpy() for c in SUMMARY_ARROW.names[2:]}

    for batch in batches:
        for run_key, i, j in key_runs(batch, UNIT_KEY):
            if run_key != key:
                if parts:
                    yield key, columns()
                key, parts = run_key, []
            parts.append(batch.slice(i, j - i))
    if parts:
        yield key, columns()


def _by_line(summaries: DataFrame) -> DataFrame:
    return summaries.repartition("hot_id", "line").sortWithinPartitions(*UNIT_KEY, "total")


def _combine(stats: dict[Unit, SliceStats], rule: ChunkRule):
    """Summary of each line as a whole: a unit of the line above."""

    def batch_of(line: Line, first, state) -> pa.RecordBatch:
        start, size, commit, known = state
        n = len(size)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, line[0], dtype=np.int32)),
                pa.array(np.zeros(n, dtype=np.int64)),
                pa.array(np.full(n, line[1], dtype=np.int64)),
                pa.array(first["total"]),
                pa.array(first["clock"]),
                pa.array(start),
                pa.array(np.where(known, size, UNKNOWN)),
                pa.array(commit),
            ],
            schema=UNIT_SUMMARY_ARROW,
        )

    def run(batches):
        line = first = state = None
        for unit, summary in _unit_summaries(batches):
            if unit[:2] != line:
                if line is not None:
                    yield batch_of(line, first, state)
                line, first = unit[:2], summary
                size = summary["exit_size"]
                state = (summary["exit_start"], size, summary["exit_commit"], size >= 0)
            else:
                *passed, known = pass_unit(*state[:3], stats[unit], summary, rule)
                settled = state[3]
                if rule.max_bytes is None and rule.interval_ms is not None:
                    # The timer fires here whatever is open, so what it leaves is known.
                    settled = settled | (stats[unit].first_clock > state[2] + rule.interval_ms)
                state = (*passed, known & settled)
        if line is not None:
            yield batch_of(line, first, state)

    return run


def _follow(behind: dict[Line, tuple[int, OpenChunk]], stats: dict[Unit, SliceStats], rule):
    """Emit the entry state of each unit behind the given ones, up to one that
    cannot be passed; or else the state behind the line's last unit."""

    def run(batches):
        line, chunk = None, None
        for unit, summary in _unit_summaries(batches):
            if unit[:2] != line:
                if chunk is not None:
                    yield arrow_rows([_state_row((*line, LINE_END), chunk)], STATE_ARROW)
                line = unit[:2]
                chunk = behind[line][1] if line in behind else None
            if chunk is None or unit[2] <= behind[line][0]:
                continue
            yield arrow_rows([_state_row(unit, chunk)], STATE_ARROW)
            start, size, commit, known = (
                x[0]
                for x in pass_unit(
                    *(np.array([x]) for x in (chunk.start, chunk.size, chunk.last_commit)),
                    stats[unit],
                    summary,
                    rule,
                )
            )
            chunk = (
                OpenChunk(
                    int(start), stats[unit].last_offset, 0, int(size), int(commit),
                    stats[unit].last_clock,
                )
                if known
                else None
            )
        if chunk is not None:
            yield arrow_rows([_state_row((*line, LINE_END), chunk)], STATE_ARROW)

    return run


def _follow_lines(summaries: DataFrame, behind, stats, rule: ChunkRule):
    if not behind:
        return {}
    rows = (
        _by_line(
            summaries.filter(
                F.col("hot_id").isin(sorted({line[0] for line in behind}))
                & F.col("line").isin(sorted({line[1] for line in behind}))
                & (F.col("unit") > min(unit for unit, _ in behind.values()))
            )
        )
        .mapInArrow(_follow(behind, stats, rule), STATE_SCHEMA)
        .collect()
    )
    return {(r.hot_id, r.line, r.unit): _state_of(r) for r in rows}


def walk_lines(units: dict[Line, list[int]], states: dict[Line, OpenChunk], exact, follow):
    """Entry state of every unit, and the state behind every line.

    states: entry state of each line. exact: entry states of some units -> the
    states behind them. follow: states behind some units, and the lines that
    needed two such units in a row -> entry states of the units after them, as
    far as the summaries tell.
    """
    entries, exits, folded = {}, {}, {}
    pending = {(*line, units[line][0]): state for line, state in states.items()}
    while pending:
        entries.update(pending)
        behind, slow = {}, set()
        for (*line, unit), state in exact(pending).items():
            line = tuple(line)
            if unit == units[line][-1]:
                exits[line] = state
                continue
            behind[line] = (unit, state)
            place = units[line].index(unit)
            if place > 0 and folded.get(line) == units[line][place - 1]:
                slow.add(line)
            folded[line] = unit
        reached: dict[Line, dict[int, OpenChunk]] = defaultdict(dict)
        for (*line, unit), state in follow(behind, slow).items():
            reached[tuple(line)][unit] = state
        pending = {}
        for line, got in reached.items():
            if LINE_END in got:
                exits[line] = got.pop(LINE_END)
            else:
                last = max(got)
                pending[(*line, last)] = got[last]
            entries.update({(*line, u): s for u, s in got.items()})
    return entries, exits


def _fold_exact(entries: dict[tuple[int, int], OpenChunk], rule: ChunkRule):
    """Emit the exit state of slices whose entry state is given."""

    def run(batches):
        key, chunk = None, None
        for run_key, offsets, sizes, arrivals in _slice_runs(batches, rule):
            if run_key != key:
                if chunk is not None:
                    yield arrow_rows([_state_row((key[0], 0, key[1]), chunk)], STATE_ARROW)
                key, chunk = run_key, replace(entries[run_key])
            feed(chunk, offsets, sizes, arrivals, rule)
        if chunk is not None:
            yield arrow_rows([_state_row((key[0], 0, key[1]), chunk)], STATE_ARROW)

    return run


def fold_slices(slices: DataFrame, pending: dict[Unit, OpenChunk], rule: ChunkRule):
    """States behind single slices, by reading just these."""
    wanted = {(hot_id, slice_no): c for (hot_id, _, slice_no), c in pending.items()}
    rows = (
        _per_slice(
            slices.filter(F.col("slice_id").isin([h * SLICES + s for h, s in sorted(wanted)]))
        )
        .mapInArrow(_fold_exact(wanted, rule), STATE_SCHEMA)
        .collect()
    )
    lines = {(h, s): line for h, line, s in pending}
    return {(r.hot_id, lines[(r.hot_id, r.unit)], r.unit): _state_of(r) for r in rows}


def resolve_entries(
    slices: DataFrame,
    summaries: DataFrame,
    hot: dict[int, HotPartition],
    stats: dict[int, list[SliceStats]],
    rule: ChunkRule,
    group_slices: int,
    path: str,
) -> dict[tuple[int, int], OpenChunk]:
    """Entry state of every slice."""
    members: dict[Line, list[SliceStats]] = defaultdict(list)
    for hot_id, parts in stats.items():
        for s in parts:
            members[(hot_id, s.slice // group_slices)].append(s)
    units = {line: [s.slice for s in parts] for line, parts in members.items()}
    slice_stats = {(*line, s.slice): s for line, parts in members.items() for s in parts}
    by_slice = {(h, s.slice): s for h, parts in stats.items() for s in parts}

    def in_lines(table: DataFrame) -> DataFrame:
        return table.select(
            "hot_id",
            F.expr(f"slice div {group_slices}").alias("line"),
            F.col("slice").alias("unit"),
            *SUMMARY_ARROW.names[2:],
        )

    lined = in_lines(summaries)

    def follow_slices(behind: dict[Line, tuple[int, OpenChunk]], slow: set[Line]):
        """Where only the timer closes chunks, summarise once more for its ticks."""
        anchors = {
            (line[0], unit): behind[line][1].last_commit
            for line in slow
            for unit in units[line]
            if unit > behind[line][0]
        }
        table = lined
        if anchors:
            ids = [h * SLICES + unit for h, unit in sorted(anchors)]
            again = _per_slice(slices.filter(F.col("slice_id").isin(ids)))
            ticks = again.mapInArrow(_summarise(by_slice, rule, anchors), SUMMARY_SCHEMA)
            table = lined.unionByName(in_lines(ticks))
        return _follow_lines(table, behind, slice_stats, rule)

    def within_groups(states: dict[Line, OpenChunk]):
        return walk_lines(
            units,
            states,
            lambda pending: fold_slices(slices, pending, rule),
            follow_slices,
        )

    groups: dict[Line, list[int]] = defaultdict(list)
    for hot_id, group in sorted(members):
        groups[(hot_id, 0)].append(group)
    begins = {line: OpenChunk.at(hot[line[0]].start_offset, rule) for line in groups}
    if all(len(g) == 1 for g in groups.values()):
        entries, _ = within_groups({(h, groups[(h, z)][0]): c for (h, z), c in begins.items()})
    else:
        # Where only the timer closes chunks, a group in which it does not fire adds its
        # bytes to the open chunk, however many groups the chunk spans.
        timer_only = rule.max_bytes is None
        group_stats = {
            (hot_id, 0, group): replace(
                parts[0],
                bytes=sum(p.bytes for p in parts) if timer_only else None,
                first_clock=parts[-1].last_clock if timer_only else parts[0].first_clock,
                last_offset=parts[-1].last_offset,
                last_clock=parts[-1].last_clock,
            )
            for (hot_id, group), parts in members.items()
        }
        (
            _by_line(lined)
            .mapInArrow(_combine(slice_stats, rule), UNIT_SUMMARY_SCHEMA)
            .write.parquet(f"{path}/group-summaries")
        )
        combined = slices.sparkSession.read.schema(UNIT_SUMMARY_SCHEMA).parquet(
            f"{path}/group-summaries"
        )

        def whole_groups(pending: dict[Unit, OpenChunk]):
            _, exits = within_groups({(h, g): c for (h, _, g), c in pending.items()})
            return {(h, 0, g): c for (h, g), c in exits.items()}

        group_entries, _ = walk_lines(
            groups,
            begins,
            whole_groups,
            lambda behind, slow: _follow_lines(combined, behind, group_stats, rule),
        )
        entries, _ = within_groups({(h, g): c for (h, _, g), c in group_entries.items()})
    return {(h, s): chunk for (h, _, s), chunk in entries.items()}


# --- step 4: chunks ----------------------------------------------------------

PIECE_SCHEMA = f"id int, {CLOSED_SQL}"
PIECE_ARROW = pa.schema([("id", pa.int32()), *CLOSED_ARROW])


def _pieces(entries: dict[tuple[int, int], OpenChunk], last: dict[int, int], rule: ChunkRule):
    """Each slice's share of its chunks. last: last slice of each partition."""

    def run(batches):
        key, chunk, carried = None, None, 0

        def share(rows):
            nonlocal carried
            out = []
            for start, end, count, size, reason in rows:
                out.append((key[0], start, end, count, size - carried, reason))
                carried = 0
            return out

        def leave():
            if key[1] == last[key[0]]:
                return share(finish(chunk, rule))
            return share([chunk.close(None)]) if chunk.count else []

        for run_key, offsets, sizes, arrivals in _slice_runs(batches, rule):
            rows = []
            if run_key != key:
                if key is not None:
                    rows = leave()
                key, chunk = run_key, replace(entries[run_key])
                carried = chunk.size
            rows += share(feed(chunk, offsets, sizes, arrivals, rule))
            if rows:
                yield arrow_rows(rows, PIECE_ARROW)
        if key is not None:
            yield arrow_rows(leave(), PIECE_ARROW)

    return run


def plan_hot_chunks(
    sizes: DataFrame,
    counts: dict[int, int],
    starts: dict[int, int],
    rule: ChunkRule,
    slicing: Slicing,
) -> DataFrame:
    """Chunks of hot partitions, planned slice by slice.

    sizes: numbered by `id`. counts, starts: messages and start offset of each.
    """
    spark = sizes.sparkSession
    path = shared_dir(spark, "chunk-plan")
    hot = measure_hot_partitions(sizes, counts, starts, rule, slicing)
    slices = _write_slices(sizes, hot, rule, f"{path}/slices")
    stats = _slice_stats(slices, hot, rule)
    by_slice = {(h, s.slice): s for h, parts in stats.items() for s in parts}
    (
        _per_slice(slices)
        .mapInArrow(_summarise(by_slice, rule), SUMMARY_SCHEMA)
        .write.parquet(f"{path}/summaries")
    )
    summaries = spark.read.schema(SUMMARY_SCHEMA).parquet(f"{path}/summaries")
    entries = resolve_entries(slices, summaries, hot, stats, rule, slicing.group, path)
    last = {h: parts[-1].slice for h, parts in stats.items()}
    return (
        _per_slice(slices)
        .mapInArrow(_pieces(entries, last, rule), PIECE_SCHEMA)
        .groupBy("id", "start_offset")
        .agg(
            F.max("end_offset").alias("end_offset"),
            F.sum("message_count").alias("message_count"),
            F.sum("message_bytes").alias("message_bytes"),
            F.max("close_reason").alias("close_reason"),
        )
    )
