"""Counters and gauges as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstow.model import PARTITION_KEY


def partition_counters(chunks: DataFrame) -> DataFrame:
    """Committed and open messages and bytes, and the open chunk's range.

    Without an open chunk the range is empty: both ends are where the last
    committed chunk ends.
    """
    is_open = F.col("close_reason") == "open"
    committed_end = F.max(F.when(~is_open, F.col("end_offset")))

    def total(condition, column):
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return chunks.groupBy(*PARTITION_KEY).agg(
        total(~is_open, "message_count").alias("committed_count"),
        total(~is_open, "message_bytes").alias("committed_bytes"),
        total(is_open, "message_count").alias("uncommitted_count"),
        total(is_open, "message_bytes").alias("uncommitted_bytes"),
        F.coalesce(F.max(F.when(is_open, F.col("start_offset"))), committed_end).alias(
            "start_offset"
        ),
        F.coalesce(F.max(F.when(is_open, F.col("end_offset"))), committed_end).alias(
            "end_offset"
        ),
    )


def archive_gauges(partitions: DataFrame) -> DataFrame:
    """Partitions per archived topic, and their total in the row without topic."""
    return partitions.rollup("topic").agg(F.count(F.lit(1)).alias("total_partitions"))
