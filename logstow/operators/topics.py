"""Topic selection, partition enumeration and the per-topic gap policy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.config import ArchiveConfig


def select_topics(messages: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Keep configured topics; a plain IN filter, so it reaches the scan."""
    return messages.filter(F.col("topic").isin(sorted(topics)))


def enumerate_partitions(
    topics: DataFrame, overrides: DataFrame, default_count: int, broker_id: int
) -> DataFrame:
    """One row per topic partition.

    topics: (topic). overrides: (topic, partition_count), one row per topic.
    A topic with a count of zero or less has no partitions.
    """
    counts = topics.select("topic").distinct().join(overrides, "topic", "left")
    n = F.coalesce(F.col("partition_count").cast("int"), F.lit(default_count))
    return counts.withColumn("n", n).filter("n > 0").select(
        "topic",
        F.lit(broker_id).cast("int").alias("broker_id"),
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("partition_id"),
    )


def with_gap_policy(partitions: DataFrame, ignore_gaps_topics: Iterable[str]) -> DataFrame:
    """Add `ignore_gaps`: the settings list the topics that may skip lost data."""
    return partitions.withColumn(
        "ignore_gaps", F.col("topic").isin(sorted(ignore_gaps_topics))
    )


def configured_partitions(spark: SparkSession, config: ArchiveConfig) -> DataFrame:
    """Partitions and gap policy as the settings have them."""
    topics = spark.createDataFrame([(t,) for t in sorted(config.topics)], "topic string")
    overrides = spark.createDataFrame(
        sorted(config.partition_counts.items()), "topic string, partition_count int"
    )
    partitions = enumerate_partitions(
        topics, overrides, config.default_partitions, config.broker_id
    )
    return with_gap_policy(partitions, config.ignore_gaps_topics)
