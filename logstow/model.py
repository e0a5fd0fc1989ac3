"""Schemas and the chunk closing rule.

`offset` is the position *after* a message, so a chunk covers the half-open
range (start_offset, end_offset] and reading resumes at `offset > committed`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PARTITION_KEY = ["topic", "broker_id", "partition_id"]

_KEY_FIELDS = [
    T.StructField("topic", T.StringType()),
    T.StructField("broker_id", T.IntegerType()),
    T.StructField("partition_id", T.IntegerType()),
]

MESSAGE_SCHEMA = T.StructType(
    _KEY_FIELDS
    + [
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("arrival_ms", T.LongType()),
    ]
)

PARTITION_SCHEMA = T.StructType(
    _KEY_FIELDS
    + [
        T.StructField("log_start", T.LongType()),
        T.StructField("ignore_gaps", T.BooleanType()),
    ]
)

CHUNK_SCHEMA = T.StructType(
    _KEY_FIELDS
    + [
        T.StructField("start_offset", T.LongType()),
        T.StructField("end_offset", T.LongType()),
        T.StructField("message_count", T.LongType()),
        T.StructField("message_bytes", T.LongType()),
        T.StructField("close_reason", T.StringType()),
    ]
)

CATALOG_SCHEMA = T.StructType(
    _KEY_FIELDS
    + [
        T.StructField("start_offset", T.LongType()),
        T.StructField("end_offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)

RECORD_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]
)

# Record classes of the archive's files.
KEY_CLASS = "org.apache.hadoop.io.Text"
VALUE_CLASS = "org.apache.hadoop.io.BytesWritable"


@dataclass(frozen=True)
class ChunkRule:
    """When an open chunk closes.

    max_bytes: a chunk closes once its payload total exceeds this; the message
        that crosses the limit still belongs to it. None switches the rule off.
    interval_ms: the commit timer. It fires once more than this much time has
        passed since the last commit, whether or not a message arrives, and it
        advances the commit time even if the chunk is empty. None switches it
        off.
    run_start_ms: the commit time a run starts with.
    now_ms: if given, the timer is also evaluated at this time after the last
        message of each partition.
    """

    max_bytes: int | None = 268435456
    interval_ms: int | None = 86400000
    run_start_ms: int = 0
    now_ms: int | None = None


@dataclass(frozen=True)
class Slicing:
    """How topic partitions too long for one task are cut.

    rows: partitions with more messages are cut into slices of about so many.
    chunks: but a slice holds at least so many full chunks, since its summary
        is as long as the messages of one.
    group: slices that are followed one after the other in a task.
    """

    rows: int = 64_000_000
    chunks: int = 16
    group: int = 64
