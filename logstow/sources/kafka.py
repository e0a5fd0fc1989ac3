"""Kafka topics as messages, through Spark's own connector.

Kafka numbers a message by the position *of* it; here `offset` is the position
after it, hence the one that is added.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.config import ArchiveConfig
from logstow.sinks.sequence_files import Range

# Offsets a trigger takes while the size of messages is not known.
FIRST_OFFSETS = 10_000_000


def offsets_json(positions: list[tuple[str, int, int]]) -> str:
    """(topic, partition, offset) list as the connector's offset option.

    A message position after offset n is Kafka's next offset n, so committed
    positions can be passed on unchanged.
    """
    out: dict[str, dict[str, int]] = {}
    for topic, partition, offset in sorted(positions):
        out.setdefault(topic, {})[str(partition)] = int(offset)
    return json.dumps(out, sort_keys=True)


def assign_json(partitions: list[tuple[str, int]]) -> str:
    """(topic, partition) list as the connector's option for exact partitions."""
    out: dict[str, list[int]] = {}
    for topic, partition in sorted(set(partitions)):
        out.setdefault(topic, []).append(int(partition))
    return json.dumps(out, sort_keys=True)


def log_starts(rows: list[tuple[str, int, int]], earliest: dict[tuple[str, int], int]):
    """(topic, broker, partition) rows with the earliest offset the log still holds.

    Kafka's first position is that of a message, which is the offset before it. A
    partition that Kafka does not know starts at 0.
    """
    return [(t, b, p, int(earliest.get((t, p), 0))) for t, b, p in rows]


def earliest_offsets(
    spark: SparkSession, config: ArchiveConfig, partitions: list[tuple[str, int]]
) -> dict[tuple[str, int], int]:
    """First position of each partition, asked from the brokers by the client that
    comes with Spark's connector."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    decoder = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
    properties.put("bootstrap.servers", config.bootstrap_servers)
    properties.put("key.deserializer", decoder)
    properties.put("value.deserializer", decoder)
    wanted = jvm.java.util.ArrayList()
    for topic, partition in partitions:
        wanted.add(jvm.org.apache.kafka.common.TopicPartition(topic, partition))
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(properties)
    try:
        found = consumer.beginningOffsets(wanted)
        return {(e.getKey().topic(), e.getKey().partition()): e.getValue() for e in found.entrySet()}
    finally:
        consumer.close()


def reader_options(
    config: ArchiveConfig,
    starting: str = "earliest",
    ending: str | None = None,
    max_offsets_per_trigger: int | None = None,
    partitions: list[tuple[str, int]] | None = None,
) -> dict[str, str]:
    """Connector options for the configured topics, or for given partitions of them.

    Start positions by partition go with given partitions: for subscribed topics the
    connector wants one for every partition a topic has, configured or not.

    Spark's option holds for the whole query: it fails on lost data unless
    every configured topic ignores gaps. `by_gap_policy` splits mixed settings.
    """
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": ",".join(sorted(config.topics)),
        "startingOffsets": starting,
        "kafka.max.partition.fetch.bytes": str(config.max_message_bytes),
        "failOnDataLoss": str(not config.topics <= config.ignore_gaps_topics).lower(),
    }
    if partitions is not None:
        del options["subscribe"]
        options["assign"] = assign_json(partitions)
    if ending is not None:
        options["endingOffsets"] = ending
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def as_messages(records: DataFrame, broker_id: int) -> DataFrame:
    """The connector's rows in message form."""
    return records.select(
        "topic",
        F.lit(broker_id).cast("int").alias("broker_id"),
        F.col("partition").cast("int").alias("partition_id"),
        (F.col("offset") + 1).alias("offset"),
        F.coalesce("value", F.lit(b"")).alias("value"),
        F.unix_millis("timestamp").alias("arrival_ms"),
    )


def read_messages(spark: SparkSession, config: ArchiveConfig, **options) -> DataFrame:
    reader = spark.read.format("kafka").options(**reader_options(config, **options))
    return as_messages(reader.load(), config.broker_id)


def stream_messages(
    spark: SparkSession,
    config: ArchiveConfig,
    max_offsets_per_trigger: int = FIRST_OFFSETS,
    **options,
) -> DataFrame:
    options["max_offsets_per_trigger"] = max_offsets_per_trigger
    reader = spark.readStream.format("kafka").options(**reader_options(config, **options))
    return as_messages(reader.load(), config.broker_id)


def by_gap_policy(config: ArchiveConfig) -> list[ArchiveConfig]:
    """The settings split so that each part can use one lost-data option.

    With it off, the connector itself moves a start position that the log no
    longer holds to the earliest one it does hold.
    """
    ignoring = config.topics & config.ignore_gaps_topics
    parts = [ignoring, config.topics - ignoring]
    return [replace(config, topics=topics) for topics in parts if topics]


def range_reader(spark: SparkSession, config: ArchiveConfig):
    """Reads exact offset ranges, for writing chunks that are already planned."""

    def read(ranges: list[tuple[str, int, int, int, int]]) -> DataFrame:
        options = reader_options(
            replace(config, topics=frozenset(r[0] for r in ranges)),
            starting=offsets_json([(t, p, low) for t, _, p, low, _ in ranges]),
            ending=offsets_json([(t, p, high) for t, _, p, _, high in ranges]),
            partitions=[(t, p) for t, _, p, _, _ in ranges],
        )
        records = spark.read.format("kafka").options(**options).load()
        return as_messages(records, config.broker_id)

    return read


def admitted_offsets(messages: int, payload_bytes: int, max_bytes: int) -> int:
    """Offsets of a trigger that stay within a number of bytes, by the mean size so far.

    The connector bounds triggers by offsets only. At least one is admitted.
    """
    if messages <= 0 or payload_bytes <= 0:
        return FIRST_OFFSETS
    return max(1, max_bytes * messages // payload_bytes)


class Broker(Protocol):
    """What archiving asks of a message log, which may be cut at its beginning."""

    def earliest(self, partitions: list[tuple[str, int]]) -> dict[tuple[str, int], int]:
        """First position of each (topic, partition) that the log still holds."""

    def stream(self, positions: list[tuple[str, int, int]], max_offsets: int) -> DataFrame:
        """Messages behind the (topic, partition, offset) positions, so many a trigger."""

    def log(self, ranges: list[Range]) -> DataFrame:
        """Messages of exact ranges."""


@dataclass(frozen=True)
class KafkaBroker:
    """Kafka, through Spark's connector and the client that comes with it."""

    spark: SparkSession
    config: ArchiveConfig

    def earliest(self, partitions: list[tuple[str, int]]) -> dict[tuple[str, int], int]:
        return earliest_offsets(self.spark, self.config, partitions)

    def stream(self, positions: list[tuple[str, int, int]], max_offsets: int) -> DataFrame:
        return stream_messages(
            self.spark,
            self.config,
            max_offsets_per_trigger=max_offsets,
            starting=offsets_json(positions),
            partitions=[(t, p) for t, p, _ in positions],
        )

    def log(self, ranges: list[Range]) -> DataFrame:
        return range_reader(self.spark, self.config)(ranges)
