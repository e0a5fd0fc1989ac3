import time

import numpy as np
import pandas as pd
import pytest

from logstow.hadoop import Folder
from logstow.model import ChunkRule
from logstow.operators.chunking import closed_chunks, plan_chunks
from logstow.operators.open_chunk import OpenChunk
from logstow.operators.integrity import chunk_gaps
from logstow.plans.archive_run import current_starts
from logstow.sources.archive import read_catalog
from logstow.plans.daemon import Supervisor
from logstow.sources.tables import file_range_reader, message_stream
from logstow.streaming import archive_stream
from logstow.streaming.archive_stream import (
    STATE_STORE, closing_chunks, fire_timer, in_order, listen, start_archive,
)
from logstow.streaming.counters import stream_counters
from logstow.streaming.starts import grow_starts, stored_starts
from test_archive import everything, messages_of, object_names, parts_for, partitions_of, sample_log

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ranges(spark, base, topics):
    rows = read_catalog(spark, base, topics).collect()
    return sorted((r.topic, r.partition_id, r.start_offset, r.end_offset) for r in rows)


def wait_for(condition, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


def test_stream_publishes_the_chunks_of_the_batch_job(spark, tmp_path, timers):
    log, base, state = (str(tmp_path / d) for d in ("log", "base", "state"))
    rows, rule = sample_log(40), ChunkRule(60, None)
    listener = listen(spark)

    def run_over(part):
        messages_of(spark, part).coalesce(1).write.mode("append").parquet(log)
        query = start_archive(
            message_stream(spark, log),
            file_range_reader(spark, log),
            current_starts(parts_for(spark), base),
            base,
            rule,
            state,
            trigger={"availableNow": True},
            timers=timers,
            in_tasks=timers,
        )
        assert query.awaitTermination(240)
        assert query.exception() is None

    run_over([r for r in rows if r[3] <= 300])
    run_over([r for r in rows if r[3] > 300])
    planned = closed_chunks(plan_chunks(messages_of(spark, rows), rule)).collect()
    got = ranges(spark, base, ["a.b_c", "_hidden"])
    assert got == sorted((c.topic, c.partition_id, c.start_offset, c.end_offset) for c in planned)
    assert len(everything(spark, base)) == sum(c.message_count for c in planned)
    assert wait_for(lambda: listener.committed["chunks"] == len(planned), 20)
    assert listener.committed["bytes"] == sum(c.message_bytes for c in planned)
    assert listener.failures == 0
    spark.streams.removeListener(listener)


@pytest.fixture(params=[False, True], ids=["timeout", "timers"])
def timers(request, spark):
    """Both forms of the stateful operator; the second needs another state store."""
    if request.param:
        spark.conf.set(STATE_STORE, ROCKSDB)
    yield request.param
    spark.conf.unset(STATE_STORE)


def test_timer_closes_a_chunk_without_new_messages(spark, tmp_path, timers):
    log, base, state = (str(tmp_path / d) for d in ("log", "base", "state"))
    messages_of(spark, [("t", 3, 0, 20, b"message_1", 0)]).coalesce(1).write.parquet(log)
    query = start_archive(
        message_stream(spark, log),
        file_range_reader(spark, log),
        current_starts(partitions_of(spark, ("t", 3, 0, 0, False)), base),
        base,
        ChunkRule(10**6, 3000),
        state,
        trigger={"processingTime": "500 milliseconds"},
        timers=timers,
    )
    try:
        assert wait_for(lambda: query.exception() or (tmp_path / "base" / "t").exists())
        assert query.exception() is None
    finally:
        query.stop()
    assert object_names(base) == ["t/3_0_0000000000000000000_0000000000000000020"]


def test_timers_want_their_state_store(spark, tmp_path):
    messages_of(spark, [("t", 3, 0, 20, b"x", 0)]).write.parquet(str(tmp_path / "log"))
    starts = grow_starts(
        spark,
        current_starts(partitions_of(spark, ("t", 3, 0, 0, False)), str(tmp_path / "base")),
        str(tmp_path / "state"),
    )
    with pytest.raises(ValueError, match="RocksDB"):
        closing_chunks(
            message_stream(spark, str(tmp_path / "log")), starts, ChunkRule(10, 10), timers=True
        )


def test_failed_runs_are_counted(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [("t", 3, 0, 20, b"x", 0), ("t", 3, 0, 20, b"y", 0)]
    messages_of(spark, rows).coalesce(1).write.parquet(log)
    listener = listen(spark)
    query = start_archive(
        message_stream(spark, log),
        file_range_reader(spark, log),
        current_starts(partitions_of(spark, ("t", 3, 0, 0, False)), str(tmp_path / "base")),
        str(tmp_path / "base"),
        ChunkRule(10, None),
        str(tmp_path / "state"),
        trigger={"availableNow": True},
    )
    with pytest.raises(Exception, match="offsets must be unique"):
        query.awaitTermination(240)
    assert wait_for(lambda: listener.failures == 1, 20)
    spark.streams.removeListener(listener)


def test_timer_of_an_empty_chunk_moves_on():
    chunk = OpenChunk(5, 5, 0, 0, 1000, 1000)
    assert fire_timer(chunk, 1010, 10) == []
    assert chunk.last_commit == 1000
    assert fire_timer(chunk, 1035, 10) == []
    assert chunk.last_commit == 1030
    chunk.end, chunk.count, chunk.size = 9, 1, 4
    assert fire_timer(chunk, 1041, 10) == [(5, 9, 1, 4, "interval")]
    assert (chunk.start, chunk.last_commit) == (9, 1040)


def test_topics_that_ignore_gaps_start_at_the_first_message(spark, tmp_path):
    log, base = str(tmp_path / "log"), str(tmp_path / "base")
    rows = [("t", 3, 0, o, b"message_1", 0) for o in (501, 502, 503)]
    messages_of(spark, rows).coalesce(1).write.parquet(log)
    query = start_archive(
        message_stream(spark, log),
        file_range_reader(spark, log),
        current_starts(partitions_of(spark, ("t", 3, 0, 0, True)), base),
        base,
        ChunkRule(17, None),
        str(tmp_path / "state"),
        trigger={"availableNow": True},
        jump_to_first=True,
    )
    assert query.awaitTermination(240)
    assert object_names(base) == ["t/3_0_0000000000000000500_0000000000000000502"]


def run_stream(spark, paths, rule):
    """Through the order of the daemon: complete, list, start."""
    log, base, state = paths
    query = start_archive(
        message_stream(spark, log),
        file_range_reader(spark, log),
        lambda: current_starts(parts_for(spark), base),
        base,
        rule,
        state,
        trigger={"availableNow": True},
    )
    query.awaitTermination(240)


@pytest.mark.parametrize("batch, survivors", [(1, 0), (1, 1), (2, 1), (2, 2)])
def test_a_crash_while_publishing_changes_nothing(spark, tmp_path, monkeypatch, batch, survivors):
    rows, rule = sample_log(30), ChunkRule(60, None)
    halves = [[r for r in rows if r[3] <= 300], [r for r in rows if r[3] > 300]]
    paths = [str(tmp_path / d) for d in ("log", "base", "state")]
    quiet = [str(tmp_path / d) for d in ("log", "quiet", "quiet-state")]
    real, done = Folder.rename, []

    def failing(folder, source, target):
        if len(done) >= survivors:
            raise OSError("lost")
        done.append(target)
        return real(folder, source, target)

    for no, part in enumerate(halves, 1):
        messages_of(spark, part).coalesce(1).write.mode("append").parquet(paths[0])
        run_stream(spark, quiet, rule)
        if no == batch:
            monkeypatch.setattr(Folder, "rename", failing)
            with pytest.raises(Exception, match="lost"):
                run_stream(spark, paths, rule)
            monkeypatch.setattr(Folder, "rename", real)
            done.sort()
            # No hole in any partition: what is there chains up.
            assert chunk_gaps(read_catalog(spark, paths[1], ["a.b_c", "_hidden"])).count() == 0
        run_stream(spark, paths, rule)
    assert object_names(paths[1]) == object_names(quiet[1]) != []
    assert everything(spark, paths[1]) == everything(spark, quiet[1])


def test_files_that_come_after_the_start_are_archived(spark, tmp_path):
    log, base, state = (str(tmp_path / d) for d in ("log", "base", "state"))
    rows, rule = sample_log(30), ChunkRule(60, None)
    messages_of(spark, rows[:0]).coalesce(1).write.parquet(log)
    query = start_archive(
        message_stream(spark, log),
        file_range_reader(spark, log),
        current_starts(parts_for(spark), base),
        base,
        rule,
        state,
        trigger={"processingTime": "500 milliseconds"},
    )
    planned = closed_chunks(plan_chunks(messages_of(spark, rows), rule)).count()
    try:
        for half in ([r for r in rows if r[3] <= 300], [r for r in rows if r[3] > 300]):
            messages_of(spark, half).coalesce(1).write.mode("append").parquet(log)
            query.processAllAvailable()
        assert wait_for(lambda: query.exception() or len(object_names(base)) == planned)
        assert query.exception() is None
    finally:
        query.stop()
    with pytest.raises(TypeError):
        start_archive(message_stream(spark, log), messages_of(spark, rows), None, base, rule, state)


def test_frames_of_a_group_are_put_in_order():
    def frame(offsets):
        return pd.DataFrame({"topic": "t", "start_offset": 3, "offset": offsets, "size": offsets})

    start, offsets, sizes = in_order([frame([9, 7]), frame([]), frame([4, 5])])
    assert start == 3 and offsets.tolist() == sizes.tolist() == [4, 5, 7, 9]
    assert offsets.dtype == sizes.dtype == np.int64


class FakeQuery:
    def __init__(self, failure, active=False):
        self.failure, self.isActive = failure, active

    def exception(self):
        return self.failure


def test_only_the_failed_query_is_started_again():
    begun = []

    def starter(name, *queries):
        rest = list(queries)

        def start():
            begun.append(name)
            return rest.pop(0)

        return start

    broken, well = FakeQuery(OSError("x")), FakeQuery(None, active=True)
    s = Supervisor(
        {"a": starter("a", broken, broken, FakeQuery(None)), "b": starter("b", well)}, most=2
    )
    assert s.look() and s.look() and s.look()
    assert s.restarts == {"a": 2, "b": 0} and begun == ["a", "b", "a", "a"]
    assert list(s.running) == ["b"]
    well.isActive = False
    assert not s.look()
    with pytest.raises(OSError):
        Supervisor({"a": starter("a", broken)}, most=0).look()


def stream_over(spark, paths, listed, rule, topics=None):
    """One run until all files are read; `listed` are the partitions that are configured."""
    log, base, state = paths
    messages = message_stream(spark, log)
    if topics is not None:
        messages = messages.filter(messages.topic.isin(topics))
    query = start_archive(
        messages,
        file_range_reader(spark, log),
        lambda: current_starts(partitions_of(spark, *listed), base),
        base,
        rule,
        state,
        owner=state.rsplit("/", 1)[-1],
        trigger={"availableNow": True},
    )
    query.awaitTermination(240)


def archived(spark, base, *topics):
    return [r[:4] for r in everything(spark, base, topics)]


def test_partitions_and_topics_that_appear_later(spark, tmp_path):
    paths = [str(tmp_path / d) for d in ("log", "base", "state")]
    rows, rule = sample_log(12), ChunkRule(30, None)
    keys = [("a.b_c", 3, 1, 0, False), ("a.b_c", 3, 11, 0, False), ("_hidden", 3, 0, 0, False)]
    for n, (topic, broker, partition, *_) in enumerate(keys, 1):
        own = [r for r in rows if r[:3] == (topic, broker, partition)]
        messages_of(spark, own).coalesce(1).write.mode("append").parquet(paths[0])
        stream_over(spark, paths, keys[:n], rule)
    planned = closed_chunks(plan_chunks(messages_of(spark, rows), rule)).collect()
    assert ranges(spark, paths[1], ["a.b_c", "_hidden"]) == sorted(
        (c.topic, c.partition_id, c.start_offset, c.end_offset) for c in planned
    )
    stored = stored_starts(spark, paths[2]).collect()
    assert [r.since_batch for r in sorted(stored, key=lambda r: r.since_batch)] == [0, 1, 2]
    assert all(r.active and r.generation == 0 for r in stored)
    counted = {r.topic: 0 for r in planned}
    for r in stream_counters(spark, paths[2]).collect():
        counted[r.topic] += r.committed_count
    assert sum(counted.values()) == sum(c.message_count for c in planned)


def test_a_message_without_a_start_fails_and_is_kept_for_the_next_run(spark, tmp_path):
    paths = [str(tmp_path / d) for d in ("log", "base", "state")]
    rows, rule = sample_log(6), ChunkRule(0, None)
    known = [("a.b_c", 3, 1, 0, False)]
    messages_of(spark, rows).coalesce(1).write.parquet(paths[0])
    with pytest.raises(Exception, match="without a start position"):
        stream_over(spark, paths, known, rule)
    stream_over(spark, paths, [*known, ("a.b_c", 3, 11, 0, False), ("_hidden", 3, 0, 0, False)], rule)
    planned = closed_chunks(plan_chunks(messages_of(spark, rows), rule)).collect()
    got = archived(spark, paths[1], "a.b_c", "_hidden")
    assert len(got) == sum(c.message_count for c in planned) > 0


def test_a_topic_that_moves_to_another_query_and_back(spark, tmp_path):
    log, base = str(tmp_path / "log"), str(tmp_path / "base")
    states = [str(tmp_path / "strict"), str(tmp_path / "ignoring")]
    rule, fixed, moving = ChunkRule(4, None), ("_hidden", 3, 0, 0, False), ("a.b_c", 3, 1, 0, False)

    def write(low, high):
        rows = [(t, 3, p, o, b"12345", 0) for t, p in (("_hidden", 0), ("a.b_c", 1)) for o in range(low, high)]
        messages_of(spark, rows).coalesce(1).write.mode("append").parquet(log)

    for turn, owner in enumerate((0, 1, 0)):
        write(10 * turn + 1, 10 * turn + 11)
        for query, state in enumerate(states):
            listed = [fixed] * (query == 0) + [moving] * (query == owner)
            if listed:
                stream_over(spark, (log, base, state), listed, rule, [k[0] for k in listed])
    everywhere = [("_hidden", 3, 0, o) for o in range(1, 31)] + [("a.b_c", 3, 1, o) for o in range(1, 31)]
    assert archived(spark, base, "_hidden", "a.b_c") == everywhere
    assert chunk_gaps(read_catalog(spark, base, ["_hidden", "a.b_c"])).count() == 0
    back = {r.generation: r for r in stored_starts(spark, states[0]).filter("topic = 'a.b_c'").collect()}
    assert [back[0].active, back[1].active] == [False, True] and back[1].start_offset == 20


def test_starts_are_kept_and_versions_are_whole(spark, tmp_path):
    state = str(tmp_path / "state")

    def listed(*rows):
        return spark.createDataFrame(rows, "topic string, broker_id int, partition_id int, start_offset long")

    def got(rows):
        return sorted((r.topic, r.generation, r.start_offset) for r in rows.collect())

    assert got(grow_starts(spark, listed(("a", 1, 0, 5)), state)) == [("a", 0, 5)]
    # A known partition stays where it began; nothing changes, so nothing is written.
    assert got(grow_starts(spark, lambda: listed(("a", 1, 0, 9)), state)) == [("a", 0, 5)]
    assert Folder(spark, f"{state}/starts").names() == ["v00000000"]
    # A version without its mark is dropped.
    Folder(spark, f"{state}/starts").make("v00000001")
    assert got(grow_starts(spark, listed(("b", 1, 0, 7)), state)) == [("b", 0, 7)]
    assert got(grow_starts(spark, listed(("a", 1, 0, 9), ("b", 1, 0, 8)), state)) == [("a", 1, 9), ("b", 0, 7)]
    with pytest.raises(ValueError, match="more than once"):
        grow_starts(spark, listed(("a", 1, 0, 9), ("a", 1, 0, 8)), state)


def test_a_replayed_batch_is_counted_once(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / d) for d in ("log", "base", "state")]
    rows, rule = sample_log(12), ChunkRule(30, None)
    keys = [("a.b_c", 3, 1, 0, False), ("a.b_c", 3, 11, 0, False), ("_hidden", 3, 0, 0, False)]
    real = Folder.delete

    def failing(folder, name=""):
        if name.startswith("closed-chunks"):
            raise OSError("lost")
        real(folder, name)

    for part in ([r for r in rows if r[3] <= 120], [r for r in rows if r[3] > 120]):
        messages_of(spark, part).coalesce(1).write.mode("append").parquet(paths[0])
        monkeypatch.setattr(Folder, "delete", failing)
        with pytest.raises(Exception, match="lost"):
            stream_over(spark, paths, keys, rule)
        monkeypatch.setattr(Folder, "delete", real)
        stream_over(spark, paths, keys, rule)
    planned = closed_chunks(plan_chunks(messages_of(spark, rows), rule)).collect()
    total = stream_counters(spark, paths[2]).selectExpr(
        "sum(committed_chunks)", "sum(committed_count)", "sum(committed_bytes)"
    ).first()
    assert tuple(total) == (
        len(planned), sum(c.message_count for c in planned), sum(c.message_bytes for c in planned)
    )


def test_closed_chunks_are_walked_in_the_callers_session(spark, tmp_path, monkeypatch):
    """A micro-batch's own session plans without adaptive execution: sorted chunks would
    be fetched by a job for every shuffle partition."""
    seen, real = [], archive_stream.write_chunks

    def watched(log, chunks, *rest, **named):
        seen.append(chunks.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return real(log, chunks, *rest, **named)

    monkeypatch.setattr(archive_stream, "write_chunks", watched)
    paths = [str(tmp_path / d) for d in ("log", "base", "state")]
    messages_of(spark, sample_log(30)).coalesce(1).write.parquet(paths[0])
    run_stream(spark, paths, ChunkRule(60, None))
    assert object_names(paths[1]) != []
    assert set(seen) == {spark.conf.get("spark.sql.adaptive.enabled")} == {"true"}
