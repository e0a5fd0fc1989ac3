"""Start positions of a stream, as a table that grows with its partitions.

A replayed batch must drop what its first attempt dropped, although the archive has
grown since; so the position a partition began with is stored once and kept. Each
start of the stream lists the partitions anew: those that are new get a row, those
that are gone are retired. One that comes back gets a row of a new generation, which
begins where the archive ends then; what the stream remembers of the generation
before no longer counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.hadoop import Folder
from logstow.model import PARTITION_KEY

SCHEMA = (
    "topic string, broker_id int, partition_id int, generation int, start_offset long, "
    "since_batch long, active boolean"
)
# Versions of the table; each is complete, and one row per partition and generation.
FOLDER = "starts"


def _next_batch(folder: Folder) -> int:
    """The batch a query on this checkpoint would go on with."""
    done = [int(name) for name in Folder(folder.spark, f"{folder.path}/query/commits").names() if name.isdigit()]
    return max(done, default=-1) + 1


def _versions(folder: Folder) -> list[int]:
    """Versions that were written to their end, oldest first."""
    names = Folder(folder.spark, f"{folder.path}/{FOLDER}").names()
    found = [int(n.removeprefix("v")) for n in names if n.startswith("v")]
    return [v for v in sorted(found) if folder.exists(f"{FOLDER}/v{v:08d}/_SUCCESS")]


def stored_starts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All rows of the newest version; none before the first start."""
    folder = Folder(spark, checkpoint)
    versions = _versions(folder)
    if not versions:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{checkpoint}/{FOLDER}/v{versions[-1]:08d}")


def _merged(stored: DataFrame, listed: DataFrame, batch: int) -> DataFrame:
    """Stored rows, retired where no longer listed, and rows of what is listed anew."""
    key = listed.select(*PARTITION_KEY).withColumn("listed", F.lit(True))
    kept = (
        stored.join(key, PARTITION_KEY, "left")
        .withColumn("active", F.col("active") & F.coalesce("listed", F.lit(False)))
        .drop("listed")
    )
    past = stored.groupBy(*PARTITION_KEY).agg(
        F.max("generation").alias("last"), F.max(F.col("active").cast("int")).alias("running")
    )
    new = (
        listed.select(*PARTITION_KEY, "start_offset")
        .join(past, PARTITION_KEY, "left")
        .filter(F.coalesce("running", F.lit(0)) == 0)
        .select(
            *PARTITION_KEY,
            (F.coalesce("last", F.lit(-1)) + 1).alias("generation"),
            F.col("start_offset").cast("long").alias("start_offset"),
            F.lit(batch).cast("long").alias("since_batch"),
            F.lit(True).alias("active"),
        )
    )
    return kept.select(*new.columns).unionByName(new)


def grow_starts(
    spark: SparkSession, starts: DataFrame | Callable[[], DataFrame], checkpoint: str
) -> DataFrame:
    """The active rows, after the partitions of `starts` have been merged into the table.

    starts: one row per partition with `start_offset`, or a function for it. Its
        positions count for partitions without an active row only. A new version is
        written if anything changes; the older ones stay, and one that was not
        written to its end is as if it had never been.
    """
    folder = Folder(spark, checkpoint)
    listed = starts() if callable(starts) else starts
    twice = listed.groupBy(*PARTITION_KEY).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"partition listed more than once: {tuple(twice)[:3]}")
    stored = stored_starts(spark, checkpoint)
    merged = _merged(stored, listed, _next_batch(folder))
    changed = not _versions(folder) or merged.exceptAll(stored).first() is not None
    if changed:
        version = max(_versions(folder), default=-1) + 1
        merged.write.mode("overwrite").parquet(f"{checkpoint}/{FOLDER}/v{version:08d}")
    return stored_starts(spark, checkpoint).filter("active")


def with_start(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Unread messages with `generation` and `start_offset`; one of a partition that no
    start is known for fails the job, since leaving it out would lose it."""
    positions = starts.select(*PARTITION_KEY, "generation", "start_offset")
    message = F.concat_ws(
        ":", F.lit("message of a partition without a start position"), *PARTITION_KEY
    )
    known = F.coalesce(F.col("start_offset"), F.raise_error(message).cast("long"))
    return messages.join(positions, PARTITION_KEY, "left").filter(F.col("offset") > known)
