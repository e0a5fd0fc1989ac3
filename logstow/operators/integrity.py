"""Offset gap checks on the archive and on the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logstow.model import PARTITION_KEY


class GapError(RuntimeError):
    """A strict check found missing offsets."""


def chunk_gaps(catalog: DataFrame) -> DataFrame:
    """Chunks that do not start where the one before them ends.

    `gap` is positive for missing offsets and negative for an overlap. The
    first chunk of a partition has nothing to be compared with. The window
    runs over one row per archived object, not over messages.
    """
    w = Window.partitionBy(*PARTITION_KEY).orderBy("start_offset", "end_offset")
    return (
        catalog.withColumn("previous_end", F.lag("end_offset").over(w))
        .filter(F.col("previous_end") != F.col("start_offset"))
        .select(
            *PARTITION_KEY,
            "previous_end",
            "start_offset",
            "end_offset",
            (F.col("start_offset") - F.col("previous_end")).alias("gap"),
        )
    )


def lost_data_gaps(starts: DataFrame) -> DataFrame:
    """Partitions whose log no longer holds the offset the archive ends at.

    `action` tells what a run does: `skip` jumps to `log_start`, `fail` stops.
    """
    return starts.filter(F.col("log_start") > F.col("last_committed")).select(
        *PARTITION_KEY,
        "last_committed",
        "log_start",
        (F.col("log_start") - F.col("last_committed")).alias("lost"),
        F.when(F.col("ignore_gaps"), "skip").otherwise("fail").alias("action"),
    )


def require_no_chunk_gaps(catalog: DataFrame) -> None:
    first = chunk_gaps(catalog).first()
    if first is not None:
        raise GapError(f"Gap between chunks detected: {first.asDict()}")


def require_no_lost_data(starts: DataFrame) -> None:
    first = lost_data_gaps(starts).filter("action = 'fail'").first()
    if first is not None:
        raise GapError(f"Messages lost before they were archived: {first.asDict()}")
