"""What a stream has committed over its whole life, batch by batch.

The totals of all batches up to one are a table named by that batch. A batch that is
replayed adds itself to the totals before it once more and replaces its own table, so
nothing is counted twice, and a process that starts again goes on counting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.hadoop import Folder
from logstow.model import PARTITION_KEY

SCHEMA = (
    "topic string, broker_id int, partition_id int, "
    "committed_chunks long, committed_count long, committed_bytes long"
)
COUNTERS = ["committed_chunks", "committed_count", "committed_bytes"]
FOLDER = "counters"


def _batches(folder: Folder) -> list[int]:
    names = Folder(folder.spark, f"{folder.path}/{FOLDER}").names()
    found = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
    return [b for b in sorted(found) if folder.exists(f"{FOLDER}/batch={b}/_SUCCESS")]


def _totals(spark: SparkSession, checkpoint: str, batches: list[int]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{checkpoint}/{FOLDER}/batch={batches[-1]}")


def add_batch(spark: SparkSession, checkpoint: str, chunks: DataFrame, batch_id: int) -> None:
    """Count the chunks that a batch has committed; the same batch counts once."""
    folder = Folder(spark, checkpoint)
    earlier = [b for b in _batches(folder) if b < batch_id]
    added = chunks.groupBy(*PARTITION_KEY).agg(
        F.count(F.lit(1)).alias("committed_chunks"),
        F.sum("message_count").alias("committed_count"),
        F.sum("message_bytes").alias("committed_bytes"),
    )
    (
        _totals(spark, checkpoint, earlier)
        .unionByName(added)
        .groupBy(*PARTITION_KEY)
        .agg(*[F.sum(c).alias(c) for c in COUNTERS])
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{checkpoint}/{FOLDER}/batch={batch_id}")
    )
    # A replay of this batch needs the totals just before it, of no other.
    for old in earlier[:-1]:
        folder.delete(f"{FOLDER}/batch={old}")


def stream_counters(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Committed chunks, messages and bytes of every topic partition since the first start."""
    return _totals(spark, checkpoint, _batches(Folder(spark, checkpoint)))
