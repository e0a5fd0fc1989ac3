"""Folding in batches and slice summaries against brute force, without Spark."""

import time

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import chunks_of
from logstow.model import ChunkRule
from logstow.operators.open_chunk import OpenChunk, feed, finish
from logstow.operators.slices import SliceStats, SliceSummary, pass_unit

messages = st.lists(
    st.tuples(st.integers(1, 5), st.integers(0, 12), st.integers(-3, 40)), min_size=1, max_size=60
)
rules = st.builds(
    ChunkRule,
    st.one_of(st.none(), st.integers(0, 60)),
    st.one_of(st.none(), st.integers(1, 60)),
    st.just(100),
    st.one_of(st.none(), st.integers(100, 3000)),
)


def placed(steps, start=7):
    out, offset, now = [], start, 90
    for gap, size, wait in steps:
        offset += gap
        now += wait
        out.append((offset, size, now))
    return out


def arrays(rows):
    return [np.array(c, dtype=np.int64) for c in zip(*rows)]


@settings(max_examples=400, deadline=None)
@given(messages, rules, st.integers(1, 9))
def test_batches_do_not_matter(steps, rule, width):
    rows = placed(steps)
    chunk, got = OpenChunk.at(7, rule), []
    for i in range(0, len(rows), width):
        got += feed(chunk, *arrays(rows[i : i + width]), rule)
    got += finish(chunk, rule)
    assert got == chunks_of(rows, rule, 7)


@settings(max_examples=600, deadline=None)
@given(messages, messages, rules, st.integers(1, 9))
def test_summary_tells_the_state_behind_a_slice(before, inside, rule, width):
    rows = placed(before + inside)
    cut = len(before)
    chunk = OpenChunk.at(7, rule)
    feed(chunk, *arrays(rows[:cut]), rule)
    offsets, sizes, arrivals = arrays(rows[cut:])
    latest = max(int(arrivals.max()), chunk.clock)
    stats = SliceStats(
        1, int(sizes.sum()), int(offsets[-1]), latest, latest, chunk.end, chunk.clock
    )
    summary = SliceSummary(stats, rule)
    for i in range(0, len(offsets), width):
        j = i + width
        summary.feed(offsets[i:j], sizes[i:j], arrivals[i:j])
    batch = summary.rows((0, 1)).to_pandas()
    columns = {c: batch[c].to_numpy() for c in batch.columns[2:]}
    entry = [np.array([x]) for x in (chunk.start, chunk.size, chunk.last_commit)]
    *state, known = (x[0] for x in pass_unit(*entry, stats, columns, rule))
    feed(chunk, offsets, sizes, arrivals, rule)
    if known:
        assert state == [chunk.start, chunk.size, chunk.last_commit]
    else:
        assert rule.interval_ms is not None and rule.max_bytes is not None


@settings(max_examples=400, deadline=None)
@given(messages, messages, rules, st.integers(1, 9))
def test_second_summary_knows_the_timer(before, inside, rule, width):
    rows = placed(before + inside)
    cut = len(before)
    chunk = OpenChunk.at(7, rule)
    feed(chunk, *arrays(rows[:cut]), rule)
    offsets, sizes, arrivals = arrays(rows[cut:])
    latest = max(int(arrivals.max()), chunk.clock)
    stats = SliceStats(
        1, int(sizes.sum()), int(offsets[-1]), latest, latest, chunk.end, chunk.clock
    )
    both = [SliceSummary(stats, rule), SliceSummary(stats, rule, chunk.last_commit)]
    for summary in both:
        for i in range(0, len(offsets), width):
            summary.feed(*(x[i : i + width] for x in (offsets, sizes, arrivals)))
    batch = pd.concat([x.rows((0, 1)).to_pandas() for x in both]).sort_values(
        "total", kind="stable"
    )
    columns = {c: batch[c].to_numpy() for c in batch.columns[2:]}
    entry = [np.array([x]) for x in (chunk.start, chunk.size, chunk.last_commit)]
    *state, known = (x[0] for x in pass_unit(*entry, stats, columns, rule))
    feed(chunk, offsets, sizes, arrivals, rule)
    assert known
    assert state == [chunk.start, chunk.size, chunk.last_commit]


def test_summaries_stay_in_proportion():
    def seconds(rows, rule):
        stats = SliceStats(1, 10 * rows, rows, rows, rows, 0, 0)
        summary, begin = SliceSummary(stats, rule), time.process_time()
        for at in range(0, rows, 10_000):
            offsets = np.arange(at + 1, at + 10_001)
            summary.feed(offsets, np.full(10_000, 10), offsets)
        return len(summary.rows((0, 1))), time.process_time() - begin

    n, _ = seconds(200_000, ChunkRule(None, 10**9))
    assert n == 1
    n, short = seconds(1_000_000, ChunkRule(1 << 28, None))
    m, long = seconds(2_000_000, ChunkRule(1 << 28, None))
    assert (n, m) == (1_000_001, 2_000_001)
    assert long < 4 * short + 0.5
