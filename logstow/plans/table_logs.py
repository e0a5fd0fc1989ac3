"""The given tables as message logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.sources.tables import table_messages

HOUR_MS = 3_600_000
# Rows per offset bucket of a table ordered by a unique id.
BUCKET_IDS = 65_536


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_time_ms():
    return F.unix_millis(F.col("ts").cast("timestamp"))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic per event type, two partitions by user."""
    return table_messages(
        load(spark, sf_dir, "events"),
        topic=F.col("event_type"),
        partition_id=F.col("user_id") % 2,
        payload=F.col("props"),
        bucket=F.expr(f"unix_millis(cast(ts as timestamp)) div {HOUR_MS}"),
        order=["ts", "event_id"],
        arrival_ms=event_time_ms(),
    )


def documents_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic per language, four partitions. Documents carry no time."""
    return table_messages(
        load(spark, sf_dir, "documents"),
        topic=F.col("lang"),
        partition_id=F.col("doc_id") % 4,
        payload=F.col("text"),
        bucket=F.expr(f"doc_id div {BUCKET_IDS}"),
        order=["doc_id"],
        arrival_ms=F.lit(0),
    )


def conversations_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic per role, two partitions by conversation."""
    return table_messages(
        load(spark, sf_dir, "conversations"),
        topic=F.col("role"),
        partition_id=F.col("conv_id") % 2,
        payload=F.col("text"),
        bucket=F.expr(f"conv_id div {BUCKET_IDS}"),
        order=["conv_id", "turn"],
        arrival_ms=F.lit(0),
    )
