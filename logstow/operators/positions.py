"""Committed offsets, start positions and the resume scan.

The archive's object names are the only durable record of progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstow.model import PARTITION_KEY


def last_committed(partitions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Highest archived end offset per partition, 0 where nothing is archived."""
    ends = catalog.groupBy(*PARTITION_KEY).agg(F.max("end_offset").alias("archived_end"))
    return (
        partitions.join(ends, PARTITION_KEY, "left")
        .withColumn(
            "last_committed", F.greatest(F.coalesce("archived_end", F.lit(0)), F.lit(0))
        )
        .drop("archived_end")
    )


def start_positions(partitions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Where each partition goes on reading.

    Topics that ignore gaps may jump forward to the earliest offset the log
    still holds; all others go on exactly where the archive ends.
    """
    floor = F.when(F.col("ignore_gaps"), F.col("log_start")).otherwise(F.lit(0))
    return last_committed(partitions, catalog).withColumn(
        "start_offset", F.greatest(floor, F.col("last_committed"))
    )


def resume_scan(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Unread messages of the given partitions, each with its `start_offset`.

    `starts` has one row per topic partition. It is left to the optimizer to
    broadcast it where its size allows, and to AQE to split a hot partition
    where it does not.
    """
    positions = starts.select(*PARTITION_KEY, "start_offset")
    return messages.join(positions, PARTITION_KEY).filter(
        F.col("offset") > F.col("start_offset")
    )
