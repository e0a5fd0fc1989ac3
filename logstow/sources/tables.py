"""Tables and file streams as message logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstow.model import MESSAGE_SCHEMA, PARTITION_KEY
from logstow.sinks.sequence_files import Range, range_filter


def message_stream(
    spark: SparkSession, path: str, max_bytes_per_trigger: int = 8 << 30
) -> DataFrame:
    """Messages arriving as parquet files, as a stream.

    A micro-batch is bounded, and with it what one partition's state operator
    sorts at a time. `run_archive` is the better way through a long backlog.
    """
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .parquet(path)
    )


def file_range_reader(spark: SparkSession, path: str):
    """Reads offset ranges of messages kept as parquet files.

    The folder is listed anew for every read, so files that came after the start of
    a stream are seen.
    """

    def read(ranges: list[Range]) -> DataFrame:
        return spark.read.schema(MESSAGE_SCHEMA).parquet(path).filter(range_filter(ranges))

    return read


def running_total(
    df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Running sum of `value` per key, without sending a whole key to one task.

    `bucket` is a column that grows with the order. Bucket totals are summed
    up first, which is a small table, and the sum within a bucket is added.
    """
    fine = [*keys, bucket]
    totals = df.groupBy(*fine).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *fine, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy(*fine).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(bases, fine)
        .withColumn(name, F.col("_base") + F.sum(value).over(within))
        .drop("_base")
    )


def table_messages(
    table: DataFrame,
    topic: Column,
    partition_id: Column,
    payload: Column,
    bucket: Column,
    order: list[str],
    arrival_ms: Column,
    broker_id: int = 3,
    header_bytes: int = 10,
) -> DataFrame:
    """A table's rows as messages.

    The offset is the byte position after the message, each message taking
    `header_bytes` more than its payload, as in a log file. Carries `size`
    next to `value`, so that planning can leave the payload alone.
    """
    size = F.octet_length(payload).cast("long")
    rows = table.select(
        topic.alias("topic"),
        F.lit(broker_id).cast("int").alias("broker_id"),
        partition_id.cast("int").alias("partition_id"),
        payload.cast("binary").alias("value"),
        size.alias("size"),
        (size + header_bytes).alias("_step"),
        bucket.alias("_bucket"),
        arrival_ms.cast("long").alias("arrival_ms"),
        *order,
    )
    placed = running_total(rows, PARTITION_KEY, "_bucket", order, "_step", "offset")
    return placed.select(*PARTITION_KEY, "offset", "value", "size", "arrival_ms")
