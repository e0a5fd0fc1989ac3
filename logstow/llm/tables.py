"""Shared helpers: reading tables, written intermediate tables, word pattern."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstow.shared_dir import shared_dir

#: A word is a run of characters other than space and the five ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch of documents.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to a size fit for rows that hold texts.

    The default of 10,000 rows makes batches of tens of megabytes, which the
    executor and its Python workers hold several times outside the heap.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished jobs now.

    It does so once the driver's collector finds their plans unused, which on a
    driver with much memory may be long after the disk is needed.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut small, so that a worker holds few texts as Python objects at a time.

    At the end, memory that is free goes back to the system; workers live on.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def least_of_each(df: DataFrame, group: str, order: list[str], k: int, salts: int = 64) -> DataFrame:
    """The k first rows of every group, with their `rank`, by a total order of columns.

    Every task keeps k of a group, then every salted part of it, then the group; so a
    group of very many rows meets in one task only as `salts` times k rows.
    """
    salt = F.pmod(F.xxhash64(F.lit(salts), *order), F.lit(salts))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("rank", F.row_number().over(part))
        .filter(F.col("rank") <= k)
        .drop("_salt")
        .withColumn("rank", F.row_number().over(whole))
        .filter(F.col("rank") <= k)
    )


def text_of(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id written in decimal, modulo; a null id counts as empty text."""
    as_text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % modulus
