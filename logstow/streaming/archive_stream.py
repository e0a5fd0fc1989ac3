"""Continuous archiving.

The stateful operator sees offsets and sizes only and keeps one small row per
topic partition: the open chunk and its commit timer. Payloads stay in the
log; when a chunk closes, its offset range is read again from there and
written like a planned chunk of the batch job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logstow.functions.names import payload_size
from logstow.hadoop import Folder
from logstow.model import CHUNK_SCHEMA, PARTITION_KEY, ChunkRule
from logstow.operators.open_chunk import OpenChunk, feed, ticks_before
from logstow.sinks.sequence_files import (
    CHUNKS_PER_JOB,
    Range,
    assign_chunks,
    recover,
    write_chunks,
)
from logstow.sources.archive import read_catalog
from logstow.streaming.counters import add_batch
from logstow.streaming.starts import grow_starts, stored_starts, with_start

STATE_SCHEMA = (
    "start long, end long, count long, size long, last_commit long, clock long"
)
# The state of a partition is that of one generation of its start position.
STATE_KEY = [*PARTITION_KEY, "generation"]
CLOSED_SCHEMA = T.StructType(
    [
        *CHUNK_SCHEMA.fields[: len(PARTITION_KEY)],
        T.StructField("generation", T.IntegerType()),
        *CHUNK_SCHEMA.fields[len(PARTITION_KEY) :],
    ]
)
CLOSED_COLUMNS = [f.name for f in CLOSED_SCHEMA]
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def _state_row(chunk: OpenChunk) -> tuple:
    return (
        chunk.start, chunk.end, chunk.count, chunk.size, chunk.last_commit, chunk.clock
    )


def fire_timer(chunk: OpenChunk, now: int, interval: int):
    """Let the timer catch up with `now`; an empty chunk is not committed."""
    if now - chunk.last_commit <= interval:
        return []
    chunk.last_commit = ticks_before(now, chunk.last_commit, interval)
    chunk.clock = max(chunk.clock, now)
    return [] if chunk.is_empty() else [chunk.close("interval")]


def in_order(batches: Iterable[pd.DataFrame]) -> tuple[int, np.ndarray, np.ndarray]:
    """Start position, and offsets and sizes in offset order.

    Of each frame only its two numbers per message are kept, not its key columns.
    """
    start, offsets, sizes = 0, [], []
    for frame in batches:
        if len(frame):
            start = int(frame["start_offset"].iloc[0])
            offsets.append(frame["offset"].to_numpy(np.int64))
            sizes.append(frame["size"].to_numpy(np.int64))
    offsets, sizes = np.concatenate(offsets), np.concatenate(sizes)
    if np.any(offsets[1:] < offsets[:-1]):
        order = np.argsort(offsets, kind="stable")
        offsets, sizes = offsets[order], sizes[order]
    return start, offsets, sizes


def _take(chunk: OpenChunk | None, batches, now: int, rule: ChunkRule, jump_to_first: bool):
    """Append a micro-batch's messages; the open chunk and the rows it closed."""
    start, offsets, sizes = in_order(batches)
    if chunk is None:
        if jump_to_first:
            start = max(start, int(offsets[0]) - 1)
        chunk = OpenChunk(start, start, 0, 0, now, now)
    return chunk, feed(chunk, offsets, sizes, np.full(len(offsets), now, dtype=np.int64), rule)


def _closed_frame(key: tuple, closed: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(*key, *row) for row in closed], columns=CLOSED_COLUMNS)


def _advance(rule: ChunkRule, jump_to_first: bool):
    def advance(key, batches, state: GroupState):
        now = state.getCurrentProcessingTimeMs()
        chunk = OpenChunk(*state.get) if state.exists else None
        if state.hasTimedOut:
            closed = fire_timer(chunk, now, rule.interval_ms)
        else:
            chunk, closed = _take(chunk, batches, now, rule, jump_to_first)
        state.update(_state_row(chunk))
        if rule.interval_ms is not None:
            state.setTimeoutDuration(max(1, chunk.last_commit + rule.interval_ms + 1 - now))
        yield _closed_frame(key, closed)

    return advance


class OpenChunks(StatefulProcessor):
    """The open chunk as a state variable, and the commit timer as a timer of its own.

    The timer stands in the state store at the very time it is due, so a micro-batch
    looks at the partitions that are due or have messages, not at all of them.
    """

    def __init__(self, rule: ChunkRule, jump_to_first: bool):
        self.rule, self.jump_to_first = rule, jump_to_first

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE_SCHEMA)

    def _keep(self, chunk: OpenChunk, now: int) -> None:
        self.open.update(_state_row(chunk))
        if self.rule.interval_ms is None:
            return
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        self.handle.registerTimer(max(now, chunk.last_commit + self.rule.interval_ms) + 1)

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        chunk = OpenChunk(*self.open.get()) if self.open.exists() else None
        chunk, closed = _take(chunk, rows, now, self.rule, self.jump_to_first)
        self._keep(chunk, now)
        yield _closed_frame(key, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentProcessingTimeInMs()
        chunk = OpenChunk(*self.open.get())
        closed = fire_timer(chunk, now, self.rule.interval_ms)
        self._keep(chunk, now)
        yield _closed_frame(key, closed)

    def close(self) -> None:
        pass


def closing_chunks(
    messages: DataFrame,
    starts: DataFrame,
    rule: ChunkRule,
    jump_to_first: bool = False,
    timers: bool = False,
) -> DataFrame:
    """Stream of chunks as they close, by size or by the processing-time timer.

    starts: generation and start position of each partition, as `grow_starts` has
        them. A message of any other partition fails the query.
    jump_to_first: for topics that ignore gaps, where offsets count messages
        and the log's beginning is not in `starts`: a partition starts right
        before the first message that is still there.
    timers: state variables and timers (`transformWithState`) instead of one state
        with a timeout. The session's state store must be RocksDB, and a checkpoint
        belongs to the form it was begun with.
    """
    sizes = messages.select(*PARTITION_KEY, "offset", payload_size().alias("size"))
    timeout = (
        GroupStateTimeout.NoTimeout
        if rule.interval_ms is None
        else GroupStateTimeout.ProcessingTimeTimeout
    )
    keyed = with_start(sizes, starts).groupBy(*STATE_KEY)
    if timers:
        if "RocksDB" not in messages.sparkSession.conf.get(STATE_STORE):
            raise ValueError(f"timers need RocksDB as {STATE_STORE}")
        mode = "None" if rule.interval_ms is None else "ProcessingTime"
        processor = OpenChunks(rule, jump_to_first)
        return keyed.transformWithStateInPandas(processor, CLOSED_SCHEMA, "append", mode)
    return keyed.applyInPandasWithState(
        _advance(rule, jump_to_first), CLOSED_SCHEMA, STATE_SCHEMA, "append", timeout
    )


def not_archived(spark: SparkSession, chunks: DataFrame, base: str) -> DataFrame:
    """Chunks whose objects are not there yet.

    Told by where they end: an earlier attempt may have cut their beginning elsewhere.
    """
    topics = [r.topic for r in chunks.select("topic").distinct().collect()]
    if not topics:
        return chunks
    there = read_catalog(spark, base, topics).select(*PARTITION_KEY, "end_offset")
    return chunks.join(there, [*PARTITION_KEY, "end_offset"], "left_anti").select(*chunks.columns)


def cut_to_log(
    chunks: DataFrame, log_start: DataFrame, log: Callable[[list[Range]], DataFrame]
) -> DataFrame:
    """Chunks without what the log has lost since their messages were seen.

    A chunk that lies before the log's beginning is gone. One that the beginning
    falls into starts there, and its messages are counted anew: at most one chunk of
    each partition, so their number on the driver is that of the partitions.
    """
    begins = log_start.select(*PARTITION_KEY, "log_start")
    marked = chunks.join(begins, PARTITION_KEY, "left")
    first = F.coalesce("log_start", F.lit(0))
    whole = marked.filter(first <= F.col("start_offset")).select(*chunks.columns)
    cut = [
        tuple(r)
        for r in marked.filter((first > F.col("start_offset")) & (first < F.col("end_offset")))
        .select(*PARTITION_KEY, "log_start", "end_offset", "close_reason")
        .collect()
    ]
    if not cut:
        return whole
    counted = (
        assign_chunks(log([c[:5] for c in cut]), cut, few=len(cut) <= CHUNKS_PER_JOB)
        .groupBy("chunk_no")
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.sum(payload_size()).alias("message_bytes"),
        )
    )
    again = chunks.sparkSession.createDataFrame(
        [(*c, i) for i, c in enumerate(cut)],
        "topic string, broker_id int, partition_id int, start_offset long, end_offset long, "
        "close_reason string, chunk_no int",
    )
    return whole.unionByName(again.join(counted, "chunk_no").select(*chunks.columns))


def start_archive(
    messages: DataFrame,
    log: Callable[[list[Range]], DataFrame],
    starts: DataFrame | Callable[[], DataFrame],
    base: str,
    rule: ChunkRule,
    checkpoint: str,
    owner: str = "stream",
    trigger: dict | None = None,
    chunks_per_job: int = CHUNKS_PER_JOB,
    jump_to_first: bool = False,
    log_start: Callable[[], DataFrame] | None = None,
    timers: bool = False,
    in_tasks: bool = False,
) -> StreamingQuery:
    """Start the archive job, or go on with one that ended or died.

    messages: the stream. log: reads given offset ranges of the same messages, as
        `file_range_reader` or Kafka's `range_reader` do; closed chunks must still be
        in it. A DataFrame will not do, as its files are fixed when it is made.
    starts: where each partition begins, or a function for it that is called after
        what a dead run left has been completed. Every start looks at it for
        partitions that are new; those that are known go on where they are.
    checkpoint: folder of the query's progress and state. Chunks that a batch
        closed are kept there by batch number until the next batch, so a replayed
        batch publishes what the first attempt meant to, and nothing twice.
    trigger: arguments of `DataStreamWriter.trigger`.
    log_start: for topics that ignore gaps, where each partition's log begins now.
        Closed chunks are then published without messages that were lost meanwhile;
        without it, or if the log is cut while a chunk is written, the query fails,
        and in the latter case succeeds when it is started again.
    timers: as `closing_chunks` has it.
    in_tasks: rename objects in Spark tasks, as `write_chunks` has it.
    """
    if not callable(log):
        raise TypeError("log must be a function that reads offset ranges")
    spark = messages.sparkSession
    # First of all: a half-published window is no state to take positions from.
    recover(spark, base, owner, in_tasks=in_tasks)
    starts = grow_starts(spark, starts, checkpoint)
    folder = Folder(spark, checkpoint)

    def publish(closed: DataFrame, batch_id: int) -> None:
        table = f"closed-chunks/batch={batch_id}"
        replayed = folder.exists(f"{table}/_SUCCESS")
        if replayed:
            # The states still have to be computed and stored.
            closed.write.format("noop").mode("overwrite").save()
        else:
            closed.write.mode("overwrite").parquet(f"{checkpoint}/{table}")
        # From here on in the caller's session: the batch's own plans without adaptive
        # execution, and walks through sorted chunks with a job per shuffle partition.
        stored = spark.read.schema(CLOSED_SCHEMA).parquet(f"{checkpoint}/{table}")
        # The timer may still close a chunk of a partition that is another query's now.
        mine = stored_starts(spark, checkpoint).filter("active").select(*STATE_KEY)
        chunks = stored.join(mine, STATE_KEY, "left_semi").drop("generation")
        if log_start is not None:
            held = f"held-chunks/batch={batch_id}"
            cut_to_log(chunks, log_start(), log).write.mode("overwrite").parquet(
                f"{checkpoint}/{held}"
            )
            chunks = spark.read.schema(CHUNK_SCHEMA).parquet(f"{checkpoint}/{held}")
        unpublished = not_archived(spark, chunks, base) if replayed else chunks
        write_chunks(log, unpublished, base, owner, chunks_per_job, in_tasks=in_tasks)
        add_batch(spark, checkpoint, chunks, batch_id)
        for past in ("closed-chunks", "held-chunks"):
            folder.delete(f"{past}/batch={batch_id - 1}")

    closed = closing_chunks(messages, starts, rule, jump_to_first, timers).observe(
        "committed",
        F.count(F.lit(1)).alias("chunks"),
        F.coalesce(F.sum("message_count"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum("message_bytes"), F.lit(0)).alias("bytes"),
    )
    return (
        closed.writeStream.outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/query")
        .foreachBatch(publish)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


class ArchiveListener(StreamingQueryListener):
    """Failed runs, and committed chunks, messages and bytes over all runs."""

    def __init__(self):
        self.starts = 0
        self.failures = 0
        self.committed = {"chunks": 0, "messages": 0, "bytes": 0}

    @property
    def restarts(self) -> int:
        return max(0, min(self.failures, self.starts - 1))

    def onQueryStarted(self, event):
        self.starts += 1

    def onQueryProgress(self, event):
        seen = event.progress.observedMetrics.get("committed")
        if seen is not None:
            for name in self.committed:
                self.committed[name] += seen[name]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception is not None:
            self.failures += 1


def listen(spark: SparkSession) -> ArchiveListener:
    listener = ArchiveListener()
    spark.streams.addListener(listener)
    return listener
