import random

import pytest
from pyspark.sql import functions as F

from brute import chunks_of
from logstow.model import ChunkRule, Slicing
from logstow.operators.chunking import chain_chunks, closed_chunks, open_tails, plan_chunks
from logstow.operators import slices
from logstow.operators.slices import measure_hot_partitions

SIZES = "topic string, broker_id int, partition_id int, offset long, size long, arrival_ms long, start_offset long"


def make_log(seed, partitions=3, n=400, max_size=30, max_wait=20, burst=0.0):
    rnd = random.Random(seed)
    rows = []
    for p in range(partitions):
        start = rnd.choice([0, 500])
        offset, now = start, 1000
        for _ in range(rnd.randint(n // 2, n)):
            size = rnd.choice([0, rnd.randint(0, max_size)])
            offset += size + rnd.randint(1, 10)
            if rnd.random() >= burst:
                now += rnd.randint(0, max_wait)
            if rnd.random() < 0.01:
                now += max_wait * 40
            late = rnd.choice([0, 0, 0, rnd.randint(0, 15)])
            rows.append((f"t:{p}_x", 3, p, offset, size, now - late, start))
    rnd.shuffle(rows)
    return rows


def expected(rows, rule):
    keys = sorted({r[:3] for r in rows})
    out = []
    for k in keys:
        own = sorted(r for r in rows if r[:3] == k)
        found = chunks_of([(r[3], r[4], r[5]) for r in own], rule, own[0][6])
        out += [(*k, *c) for c in found]
    return sorted(out)


RULES = [
    ChunkRule(100, None, 1000),
    ChunkRule(None, 50, 1000),
    ChunkRule(100, 50, 1000),
    ChunkRule(60, 200, 900),
    ChunkRule(100, 7, 1000, now_ms=10**7),
    ChunkRule(0, 5, 1000),
    ChunkRule(10**9, 10**9, 0),
]


MANY = 10**9


def planned(spark, rows, rule, slice_rows, group_slices=64, mapped=1000):
    df = spark.createDataFrame(rows, SIZES)
    chunks = plan_chunks(df, rule, Slicing(slice_rows, 0, group_slices), mapped)
    return sorted(tuple(r) for r in chunks.collect())


@pytest.mark.parametrize("rule", RULES, ids=str)
def test_one_task_per_partition(spark, rule):
    rows = make_log(1)
    assert planned(spark, rows, rule, MANY) == expected(rows, rule)


@pytest.mark.parametrize("rule", RULES, ids=str)
def test_slices_give_the_same_chunks(spark, rule):
    rows = make_log(2)
    assert planned(spark, rows, rule, 40) == expected(rows, rule)


@pytest.mark.parametrize("rule", RULES, ids=str)
def test_groups_of_slices_give_the_same_chunks(spark, rule):
    rows = make_log(3)
    assert planned(spark, rows, rule, 25, 3) == expected(rows, rule)


@pytest.mark.parametrize("seed", [11, 12])
def test_only_hot_partitions_are_sliced(spark, seed):
    rows = make_log(seed, partitions=4, n=300, burst=0.8)
    rule = ChunkRule(150, 60, 1000)
    assert planned(spark, rows, rule, 220) == expected(rows, rule)


@pytest.mark.parametrize("slice_rows", [MANY, 250])
def test_more_partitions_than_are_mapped(spark, slice_rows):
    rows = make_log(13, partitions=5)
    rule = ChunkRule(150, 60, 1000)
    assert planned(spark, rows, rule, slice_rows, 2, mapped=3) == expected(rows, rule)


def test_timer_alone_does_not_cost_a_job_per_slice(spark, monkeypatch):
    # One burst moves the timer off the ticks of the run's start; from then on
    # only the timer closes chunks.
    rows, now = [], 1000
    for i in range(1, 1200):
        now += 0 if 30 < i < 60 else 5
        rows.append(("t", 0, 0, i * 3, 10, now, 0))
    rule, jobs = ChunkRule(150, 53, 1000), []
    fold = slices.fold_slices

    def counted(*args):
        jobs.append(args)
        return fold(*args)

    monkeypatch.setattr(slices, "fold_slices", counted)
    assert planned(spark, rows, rule, 40) == expected(rows, rule)
    assert len(jobs) <= 4
    jobs.clear()
    assert planned(spark, rows, rule, 40, 8) == expected(rows, rule)
    assert len(jobs) <= 4 * 3 + 2


@pytest.mark.parametrize("interval", [700, 53, 5])
def test_chunk_of_the_timer_may_span_groups(spark, monkeypatch, interval):
    # With 700 a chunk has several groups of slices; none of them is folded on its own.
    rows = [("t", 0, p, i * 3, i % 4, 1000 + 5 * i, 0) for p in (0, 1) for i in range(1, 1200)]
    rule, jobs, fold = ChunkRule(None, interval, 1000), [], slices.fold_slices

    def counted(*args):
        jobs.append(args)
        return fold(*args)

    monkeypatch.setattr(slices, "fold_slices", counted)
    assert planned(spark, rows, rule, 20, 2) == expected(rows, rule)
    assert len(jobs) <= 2


def test_slices_hold_whole_chunks(spark):
    rows = [("t", 0, 0, i, 10, 1000, 0) for i in range(1, 900)]
    sizes = spark.createDataFrame([(0, r[3], r[4]) for r in rows], "id int, offset long, size int")
    rule = ChunkRule(500, None, 1000)
    hot = measure_hot_partitions(sizes, {0: 899}, {0: 0}, rule, Slicing(20, 4, 64))
    assert hot[0].slice_width == 200
    df = spark.createDataFrame(rows, SIZES)
    chunks = plan_chunks(df, rule, Slicing(20, 4, 2)).collect()
    assert sorted(map(tuple, chunks)) == expected(rows, rule)


def test_equal_sizes_never_fall_into_step(spark):
    rows = [("t", 0, 0, i, 7, 1000 + i // 4, 0) for i in range(1, 900)]
    rule = ChunkRule(100, 5000, 1000)
    assert planned(spark, rows, rule, 90, 3) == expected(rows, rule)


def test_crossing_and_equality(spark):
    rule = ChunkRule(10, None)
    rows = [("t", 0, 0, o, s, 0, 0) for o, s in [(1, 10), (2, 0), (3, 1), (4, 50), (5, 10)]]
    assert [r[3:] for r in planned(spark, rows, rule, MANY)] == [
        (0, 3, 3, 11, "size"),
        (3, 4, 1, 50, "size"),
        (4, 5, 1, 10, "open"),
    ]


def test_a_chunk_started_at_42(spark):
    rows = [("topic.test", 3, 2, 72, b"message_1"), ("topic.test", 3, 2, 102, b"message_2")]
    df = spark.createDataFrame(
        rows, "topic string, broker_id int, partition_id int, offset long, value binary"
    ).withColumn("start_offset", F.lit(42))
    rule = ChunkRule(1000, None)
    one = plan_chunks(df.filter("offset = 72"), rule).collect()
    assert [tuple(r)[3:] for r in one] == [(42, 72, 1, 9, "open")]
    assert [tuple(r)[3:] for r in plan_chunks(df, rule).collect()] == [(42, 102, 2, 18, "open")]


@pytest.mark.parametrize("slice_rows", [MANY, 2])
def test_repeated_offset_fails(spark, slice_rows):
    rows = [("t", 0, 0, o, 1, 0, 0) for o in (1, 2, 2, 3, 9)]
    with pytest.raises(Exception, match="offsets must be unique"):
        planned(spark, rows, ChunkRule(10, None), slice_rows)


def test_long_idle_time_gives_one_chunk(spark):
    rows = [("t", 0, 0, 1, 1, 5, 0), ("t", 0, 0, 2, 1, 1000, 0), ("t", 0, 0, 3, 1, 1001, 0)]
    rule = ChunkRule(None, 10, 0)
    assert [r[3:] for r in planned(spark, rows, rule, MANY)] == [
        (0, 1, 1, 1, "interval"),
        (1, 2, 1, 1, "interval"),
        (2, 3, 1, 1, "open"),
    ]


def test_chunk_properties(spark):
    rows = make_log(5, partitions=2, n=600)
    chunks = planned(spark, rows, ChunkRule(100, None), 70)
    sizes = {(*r[:3], r[3]): r[4] for r in rows}
    for a, b in zip(chunks, chunks[1:]):
        if a[:3] == b[:3]:
            assert a[4] == b[3]
    assert sum(c[5] for c in chunks) == len(rows)
    for c in chunks:
        if c[7] == "size":
            assert c[6] > 100 >= c[6] - sizes[(*c[:3], c[4])]


def test_closed_open_and_chained(spark):
    rows = make_log(6, partitions=2)
    chunks = plan_chunks(spark.createDataFrame(rows, SIZES), ChunkRule(100, None)).cache()
    assert closed_chunks(chunks).filter("close_reason = 'open'").count() == 0
    tails = [c for c in expected(rows, ChunkRule(100, None)) if c[7] == "open"]
    assert sorted(map(tuple, open_tails(chunks).collect())) == tails
    starts = chunks.groupBy("topic", "broker_id", "partition_id").agg(
        F.min("start_offset").alias("start_offset")
    )
    again = chain_chunks(chunks.drop("start_offset"), starts)
    cols = ["topic", "partition_id", "start_offset", "end_offset"]
    assert sorted(map(tuple, again.select(cols).collect())) == sorted(
        map(tuple, chunks.select(cols).collect())
    )
