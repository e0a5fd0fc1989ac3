"""Archive settings, read from a properties file."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from logstow.model import ChunkRule

INT_MAX = 2**31 - 1
LONG_MAX = 2**63 - 1


class ConfigError(ValueError):
    """A required setting is missing or a value is not valid."""


def split_list(text: str) -> frozenset[str]:
    """Comma list as a set: entries are not trimmed, trailing empty ones vanish."""
    if text == "":
        return frozenset([""])
    parts = text.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return frozenset(parts)


def drop_trailing_slash(prefix: str) -> str:
    """Remove one trailing slash, and only one."""
    return prefix[:-1] if prefix.endswith("/") else prefix


def _required(props: dict[str, str], name: str) -> str:
    value = props.get(name)
    if not value:
        raise ConfigError(f"Invalid property {name}")
    return value


def _number(props: dict[str, str], name: str, default: int, largest: int) -> int:
    text = props.get(name)
    if not text:
        return default
    if not re.fullmatch(r"[+-]?[0-9]+", text) or not -largest - 1 <= int(text) <= largest:
        raise ConfigError(f"Invalid property {name}: {text!r}")
    return int(text)


@dataclass(frozen=True)
class ArchiveConfig:
    """Settings of one archive.

    Object store credentials are not kept here: the session's Hadoop
    configuration (`fs.s3a.*`) holds them.
    """

    topics: frozenset[str]
    bucket: str
    prefix: str
    ignore_gaps_topics: frozenset[str] = frozenset()
    max_message_bytes: int = 65536
    min_chunk_bytes: int = 268435456
    max_commit_interval_ms: int = 86400000
    broker_id: int = 0
    host: str = "localhost"
    port: int = 9092
    default_partitions: int = 1
    partition_counts: dict[str, int] = field(default_factory=dict)
    scheme: str = "s3a"

    @classmethod
    def from_properties(
        cls, archive: dict[str, str], broker: dict[str, str] | None = None
    ) -> ArchiveConfig:
        """Build from the archive properties and the broker's own properties.

        The access and secret key must be present, as the settings require
        them, but their values are handed to Hadoop by `apply_credentials`.
        """
        broker = broker or {}
        _required(archive, "s3.accesskey")
        _required(archive, "s3.secretkey")
        counts = {}
        for item in filter(None, broker.get("topic.partition.count.map", "").split(",")):
            topic, _, count = item.partition(":")
            counts[topic] = int(count)
        ignore = archive.get("kafka.ignoregaps")
        return cls(
            topics=split_list(_required(archive, "kafka.topics")),
            bucket=_required(archive, "s3.bucket"),
            prefix=drop_trailing_slash(_required(archive, "s3.prefix")),
            ignore_gaps_topics=frozenset() if ignore is None else split_list(ignore),
            max_message_bytes=_number(archive, "kafka.maxmessagesize", 65536, INT_MAX),
            min_chunk_bytes=_number(
                archive, "s3.mintotalmessagesizeperchunk", 268435456, LONG_MAX
            ),
            max_commit_interval_ms=_number(
                archive, "s3.maxcommitinterval", 86400000, INT_MAX
            ),
            broker_id=_number(broker, "brokerid", 0, INT_MAX),
            host=broker.get("hostname") or "localhost",
            port=_number(broker, "port", 9092, INT_MAX) or 9092,
            default_partitions=_number(broker, "num.partitions", 1, INT_MAX),
            partition_counts=counts,
        )

    @classmethod
    def load(
        cls, spark: SparkSession, archive_path: str, broker_path: str | None = None
    ) -> ArchiveConfig:
        """Read properties files from any path Spark can open."""
        archive = read_properties(spark, archive_path)
        broker = read_properties(spark, broker_path) if broker_path else None
        return cls.from_properties(archive, broker)

    @property
    def base_uri(self) -> str:
        return f"{self.scheme}://{self.bucket}/{self.prefix}"

    @property
    def bootstrap_servers(self) -> str:
        return f"{self.host}:{self.port}"

    def chunk_rule(self, run_start_ms: int, now_ms: int | None = None) -> ChunkRule:
        return ChunkRule(
            self.min_chunk_bytes, self.max_commit_interval_ms, run_start_ms, now_ms
        )


def read_properties(spark: SparkSession, path: str) -> dict[str, str]:
    """Properties file as a dict; the JVM's own reader handles the syntax."""
    text = spark.read.text(path, wholetext=True).first()[0]
    props = spark._jvm.java.util.Properties()
    props.load(spark._jvm.java.io.StringReader(text))
    return {name: props.getProperty(name) for name in props.stringPropertyNames()}


def apply_credentials(spark: SparkSession, archive: dict[str, str]) -> None:
    """Hand the two keys to the session's object store client."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.s3a.access.key", _required(archive, "s3.accesskey"))
    hadoop.set("fs.s3a.secret.key", _required(archive, "s3.secretkey"))
