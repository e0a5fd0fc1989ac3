"""The archive as a source: its objects as a catalog, its records as rows."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.functions.names import object_name_fields, record_key_fields
from logstow.hadoop import Folder
from logstow.model import CATALOG_SCHEMA, KEY_CLASS, RECORD_SCHEMA, VALUE_CLASS

# A listing opens no object, so it needs few tasks however many objects there are.
LISTING_TASKS = 256
# Paths joined into one input specification.
PATHS_PER_READ = 4096
# Compressed bytes a read task takes on.
TASK_BYTES = 128 << 20


def list_objects(spark: SparkSession, base: str, topics: Iterable[str]) -> DataFrame:
    """Every object directly below the topics' folders: topic, name, length, path.

    Only names and lengths are read, no object is opened. A topic that has not
    been archived yet has no folder.
    """
    archive = Folder(spark, base)
    folders = [f"{archive.path}/{t}" for t in sorted(topics) if archive.exists(t)]
    if not folders:
        return spark.createDataFrame([], "topic string, name string, length long, path string")
    parts = F.split("path", "/")
    return (
        spark.read.format("binaryFile")
        .load(folders)
        .select("path", "length")
        .coalesce(LISTING_TASKS)
        .select(
            F.element_at(parts, -2).alias("topic"),
            F.element_at(parts, -1).alias("name"),
            "length",
            "path",
        )
    )


def parse_objects(objects: DataFrame) -> DataFrame:
    """Add the fields of each object's name; they are null for foreign names."""
    return objects.select("*", *[c.alias(n) for n, c in object_name_fields(F.col("name")).items()])


def rejected_objects(objects: DataFrame) -> DataFrame:
    """Objects whose name does not tell an offset range."""
    return parse_objects(objects).filter("end_offset IS NULL").select(
        "topic", "name", "length", "path"
    )


def archive_catalog(objects: DataFrame, strict: bool = True) -> DataFrame:
    """Catalog rows of the archive's objects.

    strict: an object below a partition's name prefix that carries no end
        offset fails the job, since the restart position would be a guess.
        Otherwise it is left out; `rejected_objects` lists it. Objects outside
        any partition's prefix are never part of the catalog.
    """
    parsed = parse_objects(objects).filter("broker_id IS NOT NULL AND partition_id IS NOT NULL")
    if strict:
        message = F.concat(F.lit("not an archive object: "), F.col("path"))
        parsed = parsed.withColumn(
            "end_offset", F.coalesce("end_offset", F.raise_error(message).cast("long"))
        )
    else:
        parsed = parsed.filter("end_offset IS NOT NULL")
    return parsed.select(*[f.name for f in CATALOG_SCHEMA])


def read_catalog(
    spark: SparkSession, base: str, topics: Iterable[str], strict: bool = True
) -> DataFrame:
    return archive_catalog(list_objects(spark, base, topics), strict)


def objects_between(catalog: DataFrame, low: int | None = None, high: int | None = None):
    """Objects that hold any offset in (low, high]: chosen by name, unopened."""
    if low is not None:
        catalog = catalog.filter(F.col("end_offset") > low)
    if high is not None:
        catalog = catalog.filter(F.col("start_offset") < high)
    return catalog


def read_objects(
    spark: SparkSession, paths: Iterable[str], tasks: int | None = None
) -> DataFrame:
    """Records of the given objects: key and value, byte for byte.

    tasks: read with no more tasks than this.
    """
    sc = spark.sparkContext
    rest = iter(paths)
    parts = []
    while some := list(islice(rest, PATHS_PER_READ)):
        parts.append(sc.sequenceFile(",".join(some), KEY_CLASS, VALUE_CLASS))
    if not parts:
        return spark.createDataFrame([], RECORD_SCHEMA)
    records = parts[0] if len(parts) == 1 else sc.union(parts)
    if tasks is not None and records.getNumPartitions() > tasks:
        records = records.coalesce(tasks)
    return spark.createDataFrame(records, RECORD_SCHEMA, verifySchema=False)


def read_topics(spark: SparkSession, base: str, topics: Iterable[str]) -> DataFrame:
    """All records of some topics, by one path pattern per topic."""
    archive = Folder(spark, base)
    found = [t for t in sorted(topics) if archive.exists(t)]
    return read_objects(spark, [f"{archive.path}/{t}/[0-9]*_*" for t in found])


def read_catalog_objects(catalog: DataFrame) -> DataFrame:
    """Records of all objects in a catalog; small objects share tasks."""
    spark = catalog.sparkSession
    named = catalog.select("path", "length").collect()
    bytes_total = sum(r.length for r in named)
    tasks = max(4 * spark.sparkContext.defaultParallelism, bytes_total // TASK_BYTES)
    return read_objects(spark, [r.path for r in named], tasks)


def archived_messages(records: DataFrame) -> DataFrame:
    """Records with their key split into topic, broker, partition and offset."""
    fields = record_key_fields(F.col("key"))
    return records.select(*[c.alias(n) for n, c in fields.items()], "value")
