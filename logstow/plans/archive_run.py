"""The incremental archive job.

The only state is the archive itself: the job lists it, reads what lies behind
the last committed offsets, and publishes the chunks that have closed. Running
it again after any failure goes on where the archive ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from logstow.model import PARTITION_KEY, ChunkRule, Slicing
from logstow.operators.chunking import (
    closed_chunks,
    message_sizes,
    open_tails,
    plan_chunks,
)
from logstow.operators.integrity import require_no_chunk_gaps, require_no_lost_data
from logstow.operators.positions import resume_scan, start_positions
from logstow.shared_dir import shared_dir
from logstow.sinks.sequence_files import (
    CHUNKS_PER_JOB,
    Messages,
    range_filter,
    recover,
    write_chunks,
)
from logstow.sources.archive import read_catalog


@dataclass(frozen=True)
class ArchiveRun:
    """What a run started from, planned and published."""

    starts: DataFrame
    chunks: DataFrame
    published: int

    @property
    def open_tails(self) -> DataFrame:
        return open_tails(self.chunks)


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def current_starts(partitions: DataFrame, base: str, check: bool = True) -> DataFrame:
    """Start positions by the archive's present listing, as a fixed table.

    check: fail on missing offsets between chunks, and on messages lost from
        topics that do not ignore gaps.
    """
    spark = partitions.sparkSession
    topics = [r.topic for r in partitions.select("topic").distinct().collect()]
    path = shared_dir(spark, "starts")
    catalog = written(read_catalog(spark, base, topics), f"{path}/catalog")
    starts = written(start_positions(partitions, catalog), f"{path}/starts")
    if check:
        require_no_lost_data(starts)
        # Topics that ignore gaps may have skipped lost messages before.
        strict = partitions.filter("NOT ignore_gaps").select("topic").distinct()
        require_no_chunk_gaps(catalog.join(strict, "topic", "left_semi"))
    return starts


def unread_messages(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Resume scan; every partition's start position is pushed into the scan."""
    positions = starts.select(*PARTITION_KEY, "start_offset").collect()
    ranges = [(*r, None) for r in positions]
    return resume_scan(messages.filter(range_filter(ranges)), starts)


def run_archive(
    messages: DataFrame,
    partitions: DataFrame,
    base: str,
    rule: ChunkRule,
    owner: str = "default",
    slicing: Slicing = Slicing(),
    chunks_per_job: int = CHUNKS_PER_JOB,
    check: bool = True,
    log: Messages | None = None,
    land_sizes: bool = False,
    in_tasks: bool = False,
) -> ArchiveRun:
    """Archive all chunks that have closed.

    partitions: one row per topic partition with `log_start` and `ignore_gaps`.
    log: how to read payloads when chunks are written, if not from `messages`.
    land_sizes: write the messages' sizes to a table first and plan from it;
        for sources that cannot read single columns, such as Kafka.
    in_tasks: rename objects in Spark tasks, as `write_chunks` has it.
    """
    spark = messages.sparkSession
    recover(spark, base, owner, in_tasks=in_tasks)
    starts = current_starts(partitions, base, check)
    unread = unread_messages(messages, starts)
    path = shared_dir(spark, "run")
    if land_sizes:
        unread = written(message_sizes(unread, rule), f"{path}/sizes")
    chunks = written(plan_chunks(unread, rule, slicing), f"{path}/chunks")
    published = write_chunks(
        log or messages, closed_chunks(chunks), base, owner, chunks_per_job, in_tasks=in_tasks
    )
    return ArchiveRun(starts, chunks, published)
